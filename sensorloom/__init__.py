"""Analytics of building-sensor series and their point names, as Spark jobs."""
