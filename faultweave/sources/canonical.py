"""The five canonical tables as files, and plain Parquet in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultweave.schemas import CANONICAL

FILE_ROWS = 1_000_000


def _location(path: str, name: str, fmt: str) -> str:
    return f"{path.rstrip('/')}/{name}.{fmt}"


def read_canonical(spark: SparkSession, path: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """All five tables under their declared schemas; a malformed number reads as NULL."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return {
        name: reader.schema(schema).format(fmt).load(_location(path, name, fmt))
        for name, schema in CANONICAL.items()
    }


def write_canonical(
    tables: dict[str, DataFrame], path: str, fmt: str = "csv", compression: str | None = None
) -> dict[str, int]:
    """Write every table and return its row count, counted during the write itself.

    A compressed CSV file is read by one task, so files then end after FILE_ROWS rows.
    """
    counts = {}
    for name, df in tables.items():
        seen = Observation(name)
        writer = df.observe(seen, F.count("*").alias("rows")).write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        if compression:
            writer = writer.option("compression", compression).option("maxRecordsPerFile", FILE_ROWS)
        writer.format(fmt).save(_location(path, name, fmt))
        counts[name] = seen.get["rows"]
    return counts


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Overwrite `path`; long-lived telemetry is worth partitioning by capture or date."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path
