"""Incremental form of the daily run."""
