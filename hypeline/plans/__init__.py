"""Composite models, the end-to-end run and the driver query registry."""
