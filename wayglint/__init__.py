"""Geospatial imagery and road analytics on PySpark."""
