"""plantlake: manufacturing telemetry analytics on Spark DataFrames and streams."""
