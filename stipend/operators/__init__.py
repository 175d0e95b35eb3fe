"""Relational operators of the jobs."""
