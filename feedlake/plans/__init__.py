"""Jobs composed from the operators, and the query catalogue over the given tables."""
