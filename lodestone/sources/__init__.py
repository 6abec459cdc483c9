"""Scans, sinks and files on the driver."""
