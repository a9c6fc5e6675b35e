"""Schemas, contracts, readers and writers."""
