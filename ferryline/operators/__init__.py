"""DataFrame -> DataFrame operators: shaping, schema changes, merges, inference."""
