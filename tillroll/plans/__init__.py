"""Cleaning, star schema, quality checks and analytics, built from DataFrames."""
