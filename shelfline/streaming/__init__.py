"""Incremental runs over arriving page snapshots."""
