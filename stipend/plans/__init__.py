"""The jobs a user runs."""
