"""Readers and writers: relational tables, landed files, feeds, layer tables."""
