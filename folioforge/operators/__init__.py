"""Operators on records and documents: decisions, trees, extraction, assembly."""
