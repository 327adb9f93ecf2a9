"""Schemas of the records that move through the engine. A missing key is null; '' is a value."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, StringType, StructType

LINKS = "bibcode string, ft_source string, provider string"
PAYLOAD = LINKS + ", update_reason string, meta_path string, index_date string, file_format string"
CONTENT = "fulltext string, acknowledgements string, dataset array<string>, facility array<string>, error string"
META = "bibcode string, ft_source string, provider string, UPDATE string, meta_path string, index_date string, file_format string, acknowledgements string, dataset array<string>, facility array<string>"
FORMATS = ("xml", "teixml", "html", "txt", "ocr", "http", "pdf", "pdf-grobid")
STATS = "path string, exists boolean, size long, mtime long"

CONTENT_TYPE = StructType().add("fulltext", StringType()).add("acknowledgements", StringType()).add("dataset", ArrayType(StringType())).add("facility", ArrayType(StringType())).add("error", StringType())
