"""Public-transport punctuality analytics as Spark jobs."""
