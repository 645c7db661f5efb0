"""Geo-telemetry and routing-event analytics as Spark plans."""
