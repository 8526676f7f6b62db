"""Distributed-tracing and resource telemetry analytics on Spark DataFrames.

Operators are functions from DataFrames (and plain parameters) to a DataFrame.
They hold no session, log no counts and, unless their docstring says so, run no
job: the caller decides when and where the plan executes.
"""
