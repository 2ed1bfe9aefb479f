"""Plans: layer runners, fixture trip views and the query catalogue."""
