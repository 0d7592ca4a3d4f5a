"""Reusable steps between the sources and the extracts."""
