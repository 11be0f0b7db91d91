"""Aircraft telemetry analytics as Spark DataFrame transformations."""
