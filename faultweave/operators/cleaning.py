"""Deduplication and validity rules for the five canonical tables.

Validity filters come before deduplication. Which copy of a duplicated key
survives is a free choice, so choosing among the valid copies is allowed, lets
the filters reach the scan, and keeps invalid rows out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest in `order`, then in the other columns (NULL first).

    An aggregate rather than a ``row_number`` window: each map task keeps a single
    row per key, so a key with very many copies costs its reducer one row per map
    task, and the outcome does not depend on partitioning.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = list(order or [])
    payload = order + [c for c in rest if c not in order]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*payload)).alias("_kept"))
    return kept.select(*[c if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def clean_trace_service(df: DataFrame, keep_roots: bool = False) -> DataFrame:
    """Identified spans with a service. A span without a parent is dropped unless kept on request."""
    valid = df.filter(F.col("span_id").isNotNull() & F.col("service_name").isNotNull())
    if not keep_roots:
        valid = valid.filter(F.col("parent_span_id") != "")
    return dedup(valid, ["span_id"])


def clean_response_times(df: DataFrame) -> DataFrame:
    valid = df.filter(
        F.col("span_id").isNotNull()
        & (F.col("response_time_ms") >= 0)
        & (F.col("processing_time_ms").isNull() | (F.col("processing_time_ms") >= 0))
    )
    return dedup(valid, ["span_id"])


def clean_request_times(df: DataFrame) -> DataFrame:
    """Adds parsed start and end; the start has to parse, the end need not.

    Parsed after deduplication: the texts decide which copy is kept, and the parsed
    times stay out of its shuffle and sorts.
    """
    valid = df.filter(
        F.col("span_id").isNotNull() & F.try_to_timestamp("start_time").isNotNull()
    )
    return dedup(valid, ["span_id"]).withColumns(
        {
            "start_time_ts": F.try_to_timestamp("start_time"),
            "end_time_ts": F.try_to_timestamp("end_time"),
        }
    )


def clean_resource_usage(df: DataFrame) -> DataFrame:
    """Adds the parsed sample time; an unparsed time is kept, a NULL or negative cpu is not."""
    valid = df.filter(F.col("cpu_usage_mcores") >= 0)
    return dedup(valid, ["pod_id", "timestamp"]).withColumn(
        "ts", F.try_to_timestamp("timestamp")
    )


def clean_status_codes(df: DataFrame) -> DataFrame:
    return dedup(df.filter(F.col("span_id").isNotNull()), ["span_id"])


def clean_all(tables: dict[str, DataFrame], keep_roots: bool = False) -> dict[str, DataFrame]:
    return {
        "trace_service_name": clean_trace_service(tables["trace_service_name"], keep_roots),
        "trace_response_times": clean_response_times(tables["trace_response_times"]),
        "trace_request_times": clean_request_times(tables["trace_request_times"]),
        "resource_usage": clean_resource_usage(tables["resource_usage"]),
        "status_codes": clean_status_codes(tables["status_codes"]),
    }


def null_shares(df: DataFrame) -> DataFrame:
    """One row: the share of NULLs in every column, from a single pass."""
    return df.agg(
        *[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns]
    )


def drop_sparse_columns(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Drop the columns whose NULL share exceeds `threshold`.

    Runs one job: the output schema depends on the data. Only the one-row
    aggregate reaches the driver.
    """
    shares = null_shares(df).first()
    sparse = [c for c in df.columns if shares[c] is not None and shares[c] > threshold]
    return df.drop(*sparse)
