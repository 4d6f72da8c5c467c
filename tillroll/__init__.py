"""Retail sales cleaning, star schema and analytics as Spark jobs."""
