"""Inventory queries and the extracts composed from the operators."""
