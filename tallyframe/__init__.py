"""Governed ingestion and variance analytics of pivot reports on Spark DataFrames."""
