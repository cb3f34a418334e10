"""Readers of raw tables, archives and documents, and the table sinks."""
