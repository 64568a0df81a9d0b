"""Incremental intake of landed page snapshots."""
