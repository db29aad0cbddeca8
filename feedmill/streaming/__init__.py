"""Incremental ingestion of drop folders."""
