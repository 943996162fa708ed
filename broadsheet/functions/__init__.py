"""functions of the bulletin engine."""
