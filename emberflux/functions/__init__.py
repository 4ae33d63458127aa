"""Functions of the emissions library."""
