"""Scans, snapshots, cell tables and sinks."""
