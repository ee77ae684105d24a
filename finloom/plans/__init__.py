"""Plans: the layers put together, lazily over raw tables or as stored tables."""
