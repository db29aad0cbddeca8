"""Delimited files in, versioned Parquet tables out."""
