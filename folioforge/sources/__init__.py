"""Readers and writers of links, files, stored results and remote services."""
