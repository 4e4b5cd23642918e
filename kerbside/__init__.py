"""Vehicle-telemetry analytics as plain DataFrame -> DataFrame functions on Spark."""
