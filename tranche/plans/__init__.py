"""Plans: fitted feature plans, the end-to-end run, and the query catalog."""
