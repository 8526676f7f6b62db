"""Timing the workload at several sizes."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.operators import scaling, workload
from faultweave.schemas import RUNS
from faultweave.sources.tables import TableStore
from faultweave.sources.workspace import materialise


def time_ops(ops: dict[str, DataFrame]) -> dict[str, float]:
    """Wall-clock seconds to run each operation to the end; results are discarded."""
    seconds = {}
    for name, df in ops.items():
        started = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        seconds[f"{name}_sec"] = round(time.perf_counter() - started, 3)
    return seconds


def run_benchmark(df: DataFrame, label: str, size: int, repetition: int, when: str) -> dict:
    seconds = time_ops(workload.bench_ops(df, when))
    return {
        "label": label,
        "input_rows": df.count(),
        "data_size": size,
        "repetition": repetition,
        **seconds,
        "total_sec": round(sum(seconds.values()), 3),
    }


def bench_run(df: DataFrame, label: str, time_column: str = "start_time") -> DataFrame:
    """One timed run as a row of the runs table."""
    spark = df.sparkSession
    run = run_benchmark(df, label, 0, 1, time_column)
    run["data_size"] = run["input_rows"]
    return spark.createDataFrame([run], RUNS)


def run_suite(
    spark: SparkSession, sizes: Sequence[int], repetitions: int = 3, seed: int = 42
) -> DataFrame:
    """Generate and write each size once, time every repetition on the written table."""
    runs = []
    for size in sizes:
        spans = materialise(workload.gen_spans(spark, size, seed), f"spans-{size}")
        for repetition in range(1, repetitions + 1):
            label = f"{size:,}_r{repetition}"
            runs.append(run_benchmark(spans, label, size, repetition, "start_time"))
    return spark.createDataFrame(runs, RUNS)


def scalability(raw: DataFrame) -> dict[str, DataFrame]:
    runs = scaling.scalability_runs(raw)
    return {"scalability_metrics": runs, "summary": scaling.scalability_metrics(runs)}


def scaling_characteristic(summary: DataFrame) -> DataFrame:
    """One row: the class of the largest size."""
    return summary.agg(
        F.max_by("scaling_characteristic", "data_size").alias("scaling_characteristic")
    )


def run_scalability(
    spark: SparkSession, store: TableStore, sizes: Sequence[int], repetitions: int = 3
) -> DataFrame:
    """Run the suite, store its runs, and return the summary per size."""
    store.write(
        scaling.scalability_runs(run_suite(spark, sizes, repetitions)), "scalability_metrics"
    )
    return scaling.scalability_metrics(store.read("scalability_metrics"))
