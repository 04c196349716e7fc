"""Queries over the given tables, with SQL that checks them."""
