"""Registered queries: each a thin application of operators to the test tables, with its SQL."""
