"""Column functions: text (D), html (C), maps (E)."""
