"""Readers for files and external databases, and the table sinks."""
