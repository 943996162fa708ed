"""sources of the bulletin engine."""
