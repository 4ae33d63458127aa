"""Streaming of the emissions library."""
