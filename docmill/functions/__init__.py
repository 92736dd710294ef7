"""Column functions: casts, mappings and calculated columns."""
