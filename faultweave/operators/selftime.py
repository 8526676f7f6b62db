"""Exclusive span time and the fault-free ceiling it is judged against."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.functions import features
from faultweave.operators.quantiles import bucket_counts, exact_percentile, grouped_percentiles
from faultweave.sources.workspace import materialise


def child_time(traces: DataFrame) -> DataFrame:
    """Total duration of the direct children, per parent span."""
    return traces.groupBy("parent_span_id").agg(F.sum("duration_ms").alias("child_duration_ms"))


def join_child_time(traces: DataFrame) -> DataFrame:
    """Every span with its child_duration_ms, NULL for a leaf."""
    children = child_time(traces.filter(F.col("parent_span_id").isNotNull())).withColumnRenamed(
        "parent_span_id", "_parent"
    )
    return traces.join(children, F.col("span_id") == F.col("_parent"), "left").drop("_parent")


def add_self_time(traces: DataFrame) -> DataFrame:
    """Duration minus the children's, never below zero.

    Judging spans by inclusive duration would make every slow child degrade its
    whole ancestry.
    """
    children = F.coalesce(F.col("child_duration_ms"), F.lit(0.0))
    return (
        join_child_time(traces)
        .withColumn("self_time_ms", F.greatest(F.col("duration_ms") - children, F.lit(0.0)))
        .drop("child_duration_ms")
    )


def baseline_self_time(timed: DataFrame) -> DataFrame:
    """The columns ceilings are learned from, of fault-free spans only."""
    return timed.filter(F.col("capture_root") == "baseline").select(
        "endpoint", "capture_root", "self_time_ms"
    )


def self_time_counts(traces: DataFrame, by_date: bool = False) -> DataFrame:
    """Fault-free spans per endpoint and bucket of self time, from which ceilings are learned.

    With `by_date` also per capture date: stored with `parts=["capture_date"]`, a new date
    adds its own counts and the others stay as they are.
    """
    baseline = traces.filter(F.col("capture_root") == "baseline")
    return bucket_counts(baseline, ["endpoint"], "self_time_ms", ["capture_date"] if by_date else [])


def latency_ceiling(
    traces: DataFrame, percentile: float = 0.99, min_samples: int = 30, counts: DataFrame | None = None
) -> DataFrame:
    """Fault-free percentile of self time per endpoint.

    Exact at any size. Endpoints with fewer than `min_samples` baseline spans take the
    percentile over all endpoints. Three passes over the baseline: the counts, which are
    written to the shared folder unless stored ones are handed in, and the buckets that hold
    the endpoints' ranks and the common one. Where `traces` is costly, hand in
    `baseline_self_time` as a written table.
    """
    baseline = traces.filter(F.col("capture_root") == "baseline")
    if counts is None:
        counts = materialise(self_time_counts(traces), "self-time-counts")
    samples = counts.groupBy("endpoint").agg(F.sum("n").alias("baseline_samples"))
    own = grouped_percentiles(baseline, ["endpoint"], "self_time_ms", {"own": percentile}, counts)
    profile = samples.join(
        own.withColumnRenamed("endpoint", "_endpoint"), F.col("endpoint").eqNullSafe(F.col("_endpoint")), "left"
    )
    trusted = (F.col("baseline_samples") >= min_samples) & F.col("own").isNotNull()
    overall = exact_percentile(baseline, "self_time_ms", percentile, counts)
    return profile.select(
        "endpoint",
        F.when(trusted, F.col("own")).otherwise(overall).alias("baseline_p99_ms"),
        "baseline_samples",
    )


def join_latency_ceiling(traces: DataFrame, ceilings: DataFrame) -> DataFrame:
    """Attach each span's ceiling; NULL for an endpoint never seen in the baseline.

    Hand in `ceilings` as a written table: then Spark knows its size and decides between
    sending it everywhere and a shuffled join, whose hot endpoints it splits.
    """
    return traces.join(ceilings, "endpoint", "left")


def flag_degraded(traces: DataFrame) -> DataFrame:
    return traces.withColumn(
        "is_degraded", features.is_degraded(F.col("self_time_ms"), F.col("baseline_p99_ms"))
    )
