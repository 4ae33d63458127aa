"""Sources of the emissions library."""
