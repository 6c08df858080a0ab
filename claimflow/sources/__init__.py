"""Sources: landing files, star tables, config seeds, rendered fixtures."""
