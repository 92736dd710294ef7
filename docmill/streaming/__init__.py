"""Incremental runs over new documents."""
