"""From a mapping contract to schemas, columns and tables."""
