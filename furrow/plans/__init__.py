"""Whole flows: the layered pipeline, and the registered queries with their SQL checks."""
