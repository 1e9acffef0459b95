"""Whole passes over a corpus, made of operators."""
