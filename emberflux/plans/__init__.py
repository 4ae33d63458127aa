"""Plans of the emissions library."""
