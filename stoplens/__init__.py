"""stoplens: analytics over public-transport passage feeds, as Spark jobs."""
