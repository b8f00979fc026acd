"""Scans, sinks and publishing."""
