"""Scans, file manifests, name parsing and sinks."""
