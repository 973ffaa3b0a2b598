"""citypulse.sources."""
