"""Registered queries, their inputs derived from the given tables, and the SQL they are checked with."""
