"""Column functions: margins of error, geometry, names and identifiers."""
