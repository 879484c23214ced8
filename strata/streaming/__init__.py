"""Structured Streaming: keyed JSON events, status monitor, publisher."""
