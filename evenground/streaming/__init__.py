"""Counting mode for points that keep arriving."""
