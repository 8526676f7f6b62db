"""Readers, writers and dataset checks."""
