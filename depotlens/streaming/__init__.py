"""Incremental form of the batch load."""
