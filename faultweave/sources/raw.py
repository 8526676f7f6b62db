"""Trace, metric and log files as captured."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.config import FAULT_ROOT, ROOTS
from faultweave.functions import names, numbers
from faultweave.sources import listing, manifest
from faultweave.sources.workspace import materialise

TRACE_FILES = "*/trace/*.csv"
METRIC_FILES = "*/metric/*_metric.csv"

# The columns that are read of each kind.
TRACE_COLUMNS = (
    "TraceID", "SpanID", "ParentID", "PodName", "OperationName", "StartTimeUnixNano", "EndTimeUnixNano", "Duration",
)
METRIC_COLUMNS = (
    "PodName", "TimeStamp", "CpuUsage(m)", "MemoryUsage(Mi)", "NetworkReceiveBytes", "NetworkTransmitBytes",
)


def source_globs(path: str, roots: Sequence[str], pattern: str) -> list[str]:
    """Paths for Spark to expand, on any file system.

    One alternation covers all roots, so a root without files is fine and a path
    without any is Spark's own path-not-found error.
    """
    head = roots[0] if len(roots) == 1 else "{" + ",".join(roots) + "}"
    return [f"{path.rstrip('/')}/{head}/{pattern}"]


def _read_text_csv(
    spark: SparkSession, path: str, roots: Sequence[str], pattern: str, columns: Sequence[str]
) -> DataFrame:
    """The wanted columns as strings, named by each file's own header, plus the path of the file.

    Files whose headers agree are read as they are. Where headers differ, every file's rows
    are read by position and named by its header, which the listing of the files gives. A
    file without a wanted column is an error, never a column taken for another; where the
    files can't be listed in tasks, so is a file with another order of columns.
    """
    paths = source_globs(path, roots, pattern)
    reader = spark.read.option("header", True).option("inferSchema", False)
    schema = reader.csv(paths).schema
    layouts = _layouts(spark, path, roots, pattern)
    if layouts is not None and layouts.select("header").distinct().limit(2).count() > 1:
        return _by_header(spark, path, paths, layouts, columns)
    rows = reader.schema(schema).option("enforceSchema", False).csv(paths)
    return rows.withColumn("source_path", F.col("_metadata.file_path"))


def _layouts(spark: SparkSession, path: str, roots: Sequence[str], pattern: str) -> DataFrame | None:
    """relative_path, header and its columns of the files of a pattern, where tasks can list them."""
    if not listing.can_list(path) or re.search(r"[\[\]{}\\?]", pattern):
        return None
    below = "[^/]*".join(map(re.escape, pattern.split("*")))
    files = listing.capture_files(spark, path, roots)
    # An empty file has no header and no rows.
    wanted = files.filter(F.col("relative_path").rlike(f"^[^/]+/{below}$") & F.col("header").isNotNull())
    return wanted.select("relative_path", "header", manifest.columns_of(F.col("header")).alias("columns"))


def _by_header(
    spark: SparkSession, path: str, paths: list[str], layouts: DataFrame, columns: Sequence[str]
) -> DataFrame:
    layouts = materialise(layouts, "layouts")
    wanted = F.array(*map(F.lit, columns))
    lacking = layouts.filter(F.size(F.array_except(wanted, "columns")) > 0).first()
    if lacking:
        raise ValueError(f"{lacking['relative_path']} lacks a column of {list(columns)}: {lacking['header']!r}")
    width = layouts.agg(F.max(F.size("columns"))).first()[0]
    places = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in places)
    rows = spark.read.option("header", True).schema(schema).csv(paths)
    rows = rows.select(
        F.array(*places).alias("values"), F.col("_metadata.file_path").alias("source_path"),
        manifest.below(F.col("_metadata.file_path"), path).alias("relative_path"),
    )
    # One row per file on the other side, so adaptive execution can split a large file's rows.
    named = rows.join(layouts.select("relative_path", "columns"), "relative_path")
    place = {c: F.array_position("columns", c).cast("int") - 1 for c in columns}
    return named.select(*[F.get("values", at).alias(c) for c, at in place.items()], "source_path")


def read_traces(
    spark: SparkSession, path: str, roots: Sequence[str] = ROOTS, fault_root: str = FAULT_ROOT
) -> DataFrame:
    """Typed spans; rows without a span id or a non-negative duration are dropped."""
    rows = _read_text_csv(spark, path, roots, TRACE_FILES, TRACE_COLUMNS)
    micros = numbers.to_double(F.col("Duration"))
    return rows.select(
        F.col("TraceID").alias("trace_id"),
        F.col("SpanID").alias("span_id"),
        F.col("ParentID").alias("parent_span_id"),
        F.col("PodName").alias("pod_id"),
        names.service_from_pod(F.col("PodName")).alias("service_name"),
        F.col("OperationName").alias("endpoint"),
        numbers.to_bigint(F.col("StartTimeUnixNano")).alias("start_ns"),
        numbers.to_bigint(F.col("EndTimeUnixNano")).alias("end_ns"),
        (micros / 1000.0).alias("duration_ms"),
        names.capture_date(F.col("source_path")).alias("capture_date"),
        names.capture_root(F.col("source_path"), fault_root).alias("capture_root"),
    ).filter(F.col("span_id").isNotNull() & (F.col("duration_ms") >= 0))


def read_metrics(
    spark: SparkSession,
    path: str,
    roots: Sequence[str] = ROOTS,
    pattern: str = METRIC_FILES,
) -> DataFrame:
    """Typed pod samples; rows without pod, time or a non-negative cpu are dropped."""
    rows = _read_text_csv(spark, path, roots, pattern, METRIC_COLUMNS)
    return rows.select(
        F.col("PodName").alias("pod_id"),
        numbers.to_bigint(F.col("TimeStamp")).alias("epoch_sec"),
        numbers.to_double(F.col("`CpuUsage(m)`")).alias("cpu_usage_mcores"),
        numbers.to_double(F.col("`MemoryUsage(Mi)`")).alias("memory_usage_mb"),
        numbers.to_double(F.col("NetworkReceiveBytes")).alias("network_rx_bytes"),
        numbers.to_double(F.col("NetworkTransmitBytes")).alias("network_tx_bytes"),
    ).filter(
        F.col("pod_id").isNotNull()
        & F.col("epoch_sec").isNotNull()
        & (F.col("cpu_usage_mcores") >= 0)
    )


def file_lineage(spark: SparkSession, path: str, roots: Sequence[str] = ROOTS) -> DataFrame:
    """Trace rows per capture date and root, both taken from the path of each row's file."""
    rows = _read_text_csv(spark, path, roots, TRACE_FILES, TRACE_COLUMNS)
    return rows.groupBy(
        names.capture_date(F.col("source_path")).alias("capture_date"),
        names.capture_root(F.col("source_path"), FAULT_ROOT).alias("capture_root"),
    ).agg(F.count("*").alias("rows"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with a number that follows the order of reading."""
    return spark.read.text(path).select(
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line")
    )
