"""Equipment-telemetry analytics as plain functions over Spark DataFrames."""
