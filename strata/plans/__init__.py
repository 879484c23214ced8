"""Composite pipelines and the test-table adapter."""
