"""Where documents, logs and run metrics come from."""
