"""Binds the supplied test tables to telemetry and pairs every query with its SQL check.

Used by the checks, the tests and the benchmark; the library does not depend on it.
"""
