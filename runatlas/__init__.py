"""runatlas: Spark jobs for machine-learning run records and model monitoring."""
