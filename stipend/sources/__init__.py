"""Where the jobs read from."""
