"""Operators on DataFrames of documents and of mapped rows."""
