"""Spark table jobs for building, searching and auditing a grounded question-answering corpus."""

__version__ = "0.1.0"
