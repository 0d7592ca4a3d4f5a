"""Readers: Parquet reading tables, relational inventory, encoded cells."""
