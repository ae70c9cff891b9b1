"""Readers, writers and the versioned index store."""
