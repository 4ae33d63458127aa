"""Emissions analytics and corpus operators as Spark jobs."""
