"""Structured Streaming triggers for table refresh."""
