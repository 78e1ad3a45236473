"""Test scaffolding: base tables rendered as market pages."""
