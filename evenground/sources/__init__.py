"""Readers and writers: delimited files, GeoJSON, nested JSON, reference tables."""
