"""citypulse.operators."""
