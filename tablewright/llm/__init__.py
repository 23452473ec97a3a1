"""Corpus operators for training data: filters, scans, deduplication, mixing and token output."""
