"""Snapshot store, page archive and export files."""
