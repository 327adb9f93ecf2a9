"""Whole plans: ingest, extraction, entity recognition, and the registered queries."""
