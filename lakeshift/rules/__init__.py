"""Rule tables."""
