"""citypulse.plans."""
