"""streaming package."""
