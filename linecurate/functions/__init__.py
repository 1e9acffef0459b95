"""Column builders and the few text functions that need Python."""
