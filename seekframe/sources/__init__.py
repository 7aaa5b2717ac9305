"""Indices, mappings (schema + conform) and versioned document tables."""
