"""Batch resumption and its streaming form."""
