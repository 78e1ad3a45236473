"""Readers (A1-A8)."""
