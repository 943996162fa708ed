"""streaming of the bulletin engine."""
