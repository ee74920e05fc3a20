"""Plans: the full inventory run, and the registered queries with their SQL oracles."""
