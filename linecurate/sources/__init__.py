"""Readers and writers. Schemas are always given, never inferred."""
