"""Structured Streaming over a drop folder of harvested records."""
