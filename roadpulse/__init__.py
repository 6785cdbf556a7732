"""Connected-vehicle telemetry analytics, written as Spark jobs."""
