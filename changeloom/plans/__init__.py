"""Whole requests: a batch of change files, or a migration, applied to a published table."""
