"""Writers of the extracts."""
