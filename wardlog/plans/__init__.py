"""Whole jobs composed from the transforms, and the query registry."""
