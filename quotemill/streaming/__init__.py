"""Incremental (file-source, availableNow) form of the daily extraction."""
