"""Readers, writers and the retail mapping of the star-schema tables."""
