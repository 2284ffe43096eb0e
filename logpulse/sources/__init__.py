"""Scans: broker topics, stored tables, databases, the engine's own telemetry."""
