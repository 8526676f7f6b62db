"""Whole pipelines: readers, operators and tables put together."""
