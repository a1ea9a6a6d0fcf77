"""Readers and writers for timed-text corpora."""
