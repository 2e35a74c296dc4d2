"""Readers: raw files of the order model and the driver's parquet tables."""
