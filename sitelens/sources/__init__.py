"""Scans, specification files and result sinks."""
