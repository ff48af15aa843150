"""Continuous application of change batches."""
