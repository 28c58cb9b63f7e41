"""Readers, writers and the vector collection."""
