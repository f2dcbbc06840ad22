"""Jobs put together from the operators, and the query catalogue over the supplied tables."""
