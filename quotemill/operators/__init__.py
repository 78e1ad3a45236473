"""DataFrame -> DataFrame operators: links (B), extract (F1/F2), validate (F), audit, consumer (X)."""
