"""Telemetry features, fleet risk scoring and model evaluation as Spark DataFrame operators."""
