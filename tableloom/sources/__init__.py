"""Scans: catalog tables, event-time ranges, CSV seeds, typed loads."""
