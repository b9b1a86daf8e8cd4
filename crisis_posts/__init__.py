"""Spark jobs and queries over social posts written around a crisis event."""
