"""Writers (G1-G9)."""
