"""Curation and auditing of large corpora of short text lines, as Spark DataFrame operators."""
