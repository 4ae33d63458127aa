"""Operators of the emissions library."""
