"""citypulse.functions."""
