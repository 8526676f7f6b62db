"""Named result tables, in files or behind JDBC, with one interface."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.config import STAGES
from faultweave.functions import names

log = logging.getLogger(__name__)

# Conditions under which a table is absent rather than broken.
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")
SAFE_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def sample_rows(df: DataFrame, key: str, modulus: int = 10) -> DataFrame:
    """About one row in `modulus`, chosen by a hash of `key`: the same rows on every run."""
    return df.filter(names.hashed_one_in(F.col(key).cast("string"), modulus))


class TableStore:
    """Result tables as Parquet folders under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        if not SAFE_NAME.match(name):
            raise ValueError(f"not a table name: {name!r}")
        return f"{self.root}/{name}"

    def _files(self, path: str):
        """Spark's file system for a path, and the path in its form."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def _load(self, name: str) -> DataFrame:
        path = self._path(name)
        files, target = self._files(path)
        if not files.exists(target):
            # A switch that was cut short left the version before it beside the table.
            kept = files.globStatus(self._files(f"{self.root}/_old-{name}-*")[1])
            if kept:
                files.rename(kept[0].getPath(), target)
        return self.spark.read.parquet(path)

    def _save(self, df: DataFrame, name: str, mode: str, parts: Sequence[str] = ()) -> None:
        """Writes beside the table and switches when all is written.

        A write that fails leaves the table as it was, and `df` may read the table it replaces.
        With `parts`, only the parts that `df` has rows of are replaced.
        """
        path = self._path(name)
        if parts:
            writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(*parts).parquet(path)
            return
        if mode != "overwrite":
            df.write.mode(mode).parquet(path)
            return
        mark = uuid.uuid4().hex
        files, target = self._files(path)
        beside = self._files(f"{self.root}/_new-{name}-{mark}")[1]
        old = self._files(f"{self.root}/_old-{name}-{mark}")[1]
        try:
            df.write.parquet(beside.toString())
        except BaseException:
            files.delete(beside, True)
            raise
        replaced = files.exists(target)
        if replaced and not files.rename(target, old):
            raise OSError(f"{path} can't be moved aside")
        if not files.rename(beside, target):
            files.rename(old, target)
            raise OSError(f"{path} can't be replaced")
        if replaced:
            files.delete(old, True)

    def read(self, name: str) -> DataFrame | None:
        """The table, or None where there is none. A table that can't be read is an error."""
        if not SAFE_NAME.match(name):
            return None
        try:
            return self._load(name)
        except AnalysisException as error:
            if error.getCondition() in MISSING:
                return None
            raise

    def read_optional(self, name: str) -> DataFrame | None:
        """The same, for a table whose absence or failure may not stop the caller.

        What went wrong is logged.
        """
        try:
            return self.read(name)
        except Exception as error:
            log.warning("%s is not available: %s", name, str(error).splitlines()[0])
            return None

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "overwrite",
        sample_key: str | None = None,
        sample_mod: int | None = None,
        parts: Sequence[str] = (),
    ) -> None:
        """Save `df`; with `sample_mod`, only a hash sample of it for quick serving queries.

        With `parts`, the table lies in folders by these columns, such as the capture date, and
        only the folders that `df` has rows of are replaced.
        """
        if sample_mod:
            df = sample_rows(df, sample_key or df.columns[0], sample_mod)
        self._save(df, name, mode, parts)


def ranges(column: str, low: int, high: int, parts: int) -> list[str]:
    """Disjoint SQL conditions that together take every row, nulls and rows outside the bounds too."""
    if not SAFE_NAME.match(column):
        raise ValueError(f"not a column name: {column!r}")
    width = high - low + 1
    cuts = sorted({low + width * i // parts for i in range(1, parts)} - {low})
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


class JdbcStore(TableStore):
    """The same interface over a database the caller runs.

    `splits` names a whole-number column per table that is to be read in `parts` tasks;
    other tables are read in one. Bounds are read first; rows that come later fall into the
    outer ranges. Tests start no database: they cover the conditions, not the read itself.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: dict[str, str] | None = None,
        splits: dict[str, str] | None = None,
        parts: int = 32,
    ):
        super().__init__(spark, "")
        self.url = url
        self.properties = {"batchsize": "10000", **(properties or {})}
        self.splits, self.parts = splits or {}, parts

    def _load(self, name: str) -> DataFrame:
        self._path(name)
        column = self.splits.get(name)
        conditions = self._conditions(name, column) if column else None
        if conditions is None:
            return self.spark.read.jdbc(self.url, name, properties=self.properties)
        return self.spark.read.jdbc(self.url, name, predicates=conditions, properties=self.properties)

    def _conditions(self, name: str, column: str) -> list[str] | None:
        if not SAFE_NAME.match(column):
            raise ValueError(f"not a column name: {column!r}")
        asked = f"(SELECT min({column}) AS low, max({column}) AS high FROM {name}) bounds"
        bounds = self.spark.read.jdbc(self.url, asked, properties=self.properties).first()
        if bounds[0] is None:
            return None
        return ranges(column, int(bounds[0]), int(bounds[1]), self.parts)

    def _save(self, df: DataFrame, name: str, mode: str, parts: Sequence[str] = ()) -> None:
        self._path(name)
        if parts:
            raise ValueError("a database table has no parts to replace")
        df.write.jdbc(self.url, name, mode=mode, properties=self.properties)


def table_inventory(store: TableStore, tables: Sequence[str]) -> DataFrame:
    """Row count per table name, 0 for a table that is missing or has an unsafe name."""
    counts = None
    for name in tables:
        df = store.read(name)
        label = F.lit(name).alias("table_name")
        if df is None:
            one = store.spark.range(1).select(label, F.lit(0).cast("bigint").alias("row_count"))
        else:
            one = df.agg(F.count("*").alias("row_count")).select(label, "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def inventory_total(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count("*").alias("tables"), F.sum("row_count").alias("total_rows")
    )


def stage_status(
    inventory: DataFrame, stages: Sequence[tuple[str, str]] = STAGES
) -> DataFrame:
    """Whether each stage has output, and how many of them do."""
    expected = inventory.sparkSession.createDataFrame(
        list(stages), "stage string, output_table string"
    )
    rows = F.coalesce(F.col("row_count"), F.lit(0))
    status = expected.join(
        inventory, expected.output_table == inventory.table_name, "left"
    ).select(
        "stage", "output_table",
        F.when(rows > 0, "complete").otherwise("not run").alias("status"),
        rows.alias("rows"),
    )
    done = status.agg(F.count_if(F.col("status") == "complete").alias("n"))
    return status.withColumn("stages_complete", done.scalar())
