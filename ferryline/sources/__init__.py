"""Readers: files, archives, in-memory rows, tables and SQL over connections."""
