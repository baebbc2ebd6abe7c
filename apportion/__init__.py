"""Electoral-geography analytics as Spark plans."""
