"""Scans, row checks and sinks."""
