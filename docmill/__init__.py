"""Document shredding, mapping, reconciliation and audit as Spark jobs."""
