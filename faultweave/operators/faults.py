"""Spans inside the windows after injected faults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_fault_window(telemetry: DataFrame, ground_truth: DataFrame, window_sec: int = 300) -> DataFrame:
    """A row per injection and second of its window in which its service had spans.

    Columns: inject_service, inject_type, inject_timestamp, span_epoch, spans, failures; a
    span inside overlapping windows, or under repeated labels, counts for each. An
    injection without spans has one row with NULLs.

    Spans are reduced to one row per service and second, labels to one row per second, then
    matched on (service, slot): a slot is as long as a window, so a window covers two of
    them and a busy service is spread over its slots.
    """
    slot = lambda second: F.floor(second / F.lit(window_sec))
    start = F.col("inject_timestamp")
    faults = (
        ground_truth.groupBy("inject_service", "inject_type", "inject_timestamp")
        .agg(F.count("*").alias("labels"))
        .withColumn("slots", F.array_distinct(F.array(slot(start), slot(start + window_sec))))
    )
    seconds = (
        telemetry.filter(F.col("start_time_ts").isNotNull())
        .groupBy(F.col("service_name"), F.unix_timestamp("start_time_ts").alias("span_epoch"))
        .agg(F.count("*").alias("n"), F.sum("is_failure").alias("failed"))
        .withColumn("span_slot", slot(F.col("span_epoch")))
    )
    met = faults.withColumn("slot", F.explode("slots")).join(
        seconds,
        (F.col("inject_service") == F.col("service_name"))
        & (F.col("slot") == F.col("span_slot"))
        & F.col("span_epoch").between(start, start + window_sec),
    )
    key = ["inject_service", "inject_type", "inject_timestamp"]
    found = met.select(
        *key, "span_epoch", (F.col("labels") * F.col("n")).alias("spans"), (F.col("labels") * F.col("failed")).alias("failures")
    )
    # Injections without spans, once each.
    hit = found.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
    same = F.lit(True)
    for c in key:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    missed = faults.join(hit, same, "left_anti").select(
        *key, *[F.lit(None).cast("bigint").alias(c) for c in ("span_epoch", "spans", "failures")]
    )
    return found.unionByName(missed)
