"""operators of the bulletin engine."""
