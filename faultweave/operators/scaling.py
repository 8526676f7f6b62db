"""Metrics over benchmark runs.

A run is a row of ``faultweave.schemas.RUNS``. The baseline is read through a
scalar subquery, so no window pulls all runs into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultweave.functions import features

OPERATIONS = ("groupby_agg_sec", "window_fn_sec", "join_sec", "shuffle_sec")


def _baseline(rows: DataFrame, value: str, *order: str) -> Column:
    return rows.agg(F.min_by(value, F.struct(*order))).scalar()


def scalability_runs(raw: DataFrame) -> DataFrame:
    """Throughput and speed-up per run, against the first repetition of the smallest size."""
    total = F.col("total_sec")
    base = _baseline(raw, "total_sec", "data_size", "repetition")
    size = _baseline(raw, "data_size", "data_size", "repetition")
    throughput = F.when(total > 0, F.round(F.col("input_rows") / total, 1)).otherwise(F.lit(0.0))
    speedup = F.round(F.col("baseline_time_sec") / F.greatest(total, F.lit(0.001)), 3)
    timed = F.col("baseline_time_sec") > 0
    return (
        raw.withColumns(
            {
                "throughput_rows_per_sec": throughput,
                "baseline_time_sec": base,
                "baseline_size": size,
            }
        )
        .withColumns(
            {
                "speedup_vs_baseline": F.when(timed, speedup),
                "baseline_size": F.when(timed, F.col("baseline_size")),
            }
        )
        .withColumn("baseline_time_sec", F.when(timed, F.col("baseline_time_sec")))
    )


def scalability_metrics(runs: DataFrame) -> DataFrame:
    """Means per size with speed-up and speed-up per data ratio.

    The class of every size is given; the reported one is that of the largest size.
    """
    means = runs.groupBy("data_size").agg(
        F.avg("total_sec").alias("_total"),
        F.avg("throughput_rows_per_sec").alias("_throughput"),
        F.count("*").alias("repetitions"),
    )
    base_total = _baseline(means, "_total", "data_size")
    ratio = F.col("data_size") / _baseline(means, "data_size", "data_size")
    speedup = F.when(F.col("_total") > 0, base_total / F.col("_total")).otherwise(F.lit(0.0))
    efficiency = F.round(F.col("_speedup") / F.col("_ratio"), 3)
    return (
        means.withColumns({"_ratio": ratio, "_speedup": speedup})
        .select(
            "data_size",
            "repetitions",
            F.round("_total", 3).alias("avg_total_time_sec"),
            F.round("_throughput", 1).alias("avg_throughput_rows_per_sec"),
            F.round("_ratio", 2).alias("data_ratio"),
            F.round("_speedup", 3).alias("speedup"),
            efficiency.alias("scalability_efficiency"),
            features.scaling_class(efficiency).alias("scaling_characteristic"),
        )
        .orderBy("data_size")
    )


def mart_scaling_by_size(runs: DataFrame) -> DataFrame:
    """Mean of every timing per size, the spread of the total, and the repetitions."""
    return (
        runs.groupBy("data_size")
        .agg(
            F.avg("total_sec").alias("total_sec"),
            F.stddev_samp("total_sec").alias("std_total_sec"),
            *[F.avg(c).alias(c) for c in OPERATIONS],
            F.avg("throughput_rows_per_sec").alias("throughput"),
            F.count("*").alias("repetitions"),
        )
        .orderBy("data_size")
    )


def mart_scaling_raw(runs: DataFrame) -> DataFrame:
    return runs.select(
        "label", "data_size", "repetition", *OPERATIONS, "total_sec", "throughput_rows_per_sec"
    ).orderBy("data_size", "repetition")


def mart_scaling_efficiency(by_size: DataFrame) -> DataFrame:
    """Size ratio over time ratio (1 is linear), with the runtime linear scaling would give."""
    base_time = _baseline(by_size, "total_sec", "data_size")
    base_size = _baseline(by_size, "data_size", "data_size")
    efficiency = F.try_divide(F.col("size_ratio"), F.col("time_ratio"))
    return (
        by_size.withColumns({"_time": base_time, "_size": base_size})
        .select(
            "data_size",
            "total_sec",
            (F.col("data_size") / F.col("_size")).alias("size_ratio"),
            F.try_divide(F.col("total_sec"), F.col("_time")).alias("time_ratio"),
            (F.col("data_size") / F.col("_size") * F.col("_time")).alias("linear_total_sec"),
        )
        .withColumn("efficiency", efficiency)
        .withColumns(
            {
                "efficiency_status": features.efficiency_status(F.col("efficiency")),
                "efficiency_note": features.efficiency_note(F.col("efficiency")),
            }
        )
        .orderBy("data_size")
    )


def mart_report_efficiency(runs: DataFrame) -> DataFrame:
    """Rounded means per size with speed-up and speed-up per data ratio, as printed.

    ``speedup`` compares the mean times, ``mean_speedup`` averages the runs' own.
    """
    means = runs.groupBy("data_size").agg(
        F.round(F.avg("total_sec"), 2).alias("avg_time"),
        F.round(F.avg("throughput_rows_per_sec"), 0).alias("throughput"),
        F.round(F.avg("speedup_vs_baseline"), 3).alias("mean_speedup"),
    )
    base_time = _baseline(means, "avg_time", "data_size")
    base_size = _baseline(means, "data_size", "data_size")
    speedup = F.when(F.col("avg_time") > 0, base_time / F.col("avg_time")).otherwise(F.lit(0.0))
    return (
        means.withColumns({"ratio": F.col("data_size") / base_size, "speedup": speedup})
        .withColumns(
            {
                "efficiency": F.col("speedup") / F.col("ratio"),
                "mean_efficiency": F.col("mean_speedup") / F.col("ratio"),
            }
        )
        .orderBy("data_size")
    )


def mart_report_ops(runs: DataFrame, sizes: int | None = None) -> DataFrame:
    """Mean of each operation per size, by default for all, and the speed-up at the largest."""
    at_largest = (
        runs.groupBy("data_size")
        .agg(F.round(F.avg("speedup_vs_baseline"), 3).alias("s"))
        .agg(F.max_by("s", "data_size"))
        .scalar()
    )
    means = runs.groupBy("data_size").agg(*[F.round(F.avg(c), 2).alias(c) for c in OPERATIONS])
    ordered = means.orderBy("data_size")
    shown = ordered if sizes is None else ordered.limit(sizes)
    return shown.withColumn("speedup_at_max_size", at_largest)
