"""Where the jobs write to."""
