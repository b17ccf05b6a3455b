"""Plans: the silver/gold call graph and the registered driver queries."""
