"""Readers and writers."""

from strata.sources import readers, sinks  # noqa: F401
