"""Full-text extraction and cleaning for large document collections on Spark."""
