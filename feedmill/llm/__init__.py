"""Operators for preparing text corpora to train language models."""
