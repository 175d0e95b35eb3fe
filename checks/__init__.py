"""Queries over the shared synthetic tables, and the SQL they are compared with."""
