"""Plans: the medallion pipeline, registered queries and their SQL oracles."""
