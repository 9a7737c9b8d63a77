"""Rule monitoring of sensor telemetry, written as Spark DataFrame jobs."""
