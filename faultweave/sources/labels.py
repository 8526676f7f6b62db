"""Injected faults, kept for evaluating detections."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.config import FAULT_ROOT
from faultweave.functions import names, numbers
from faultweave.schemas import INJECTIONS

FAULT_FILES = "*/*-fault_list.json"


def explode_fault_lists(files: DataFrame) -> DataFrame:
    """One row per injection from (file_path, value) rows, one row per JSON document.

    A document is an object of lists, or one bare list; anything else in it, and a
    document that does not parse, yields nothing. The capture date is the name of
    the folder holding the file; a missing timestamp becomes 0.
    """
    by_key = F.map_values(F.from_json("value", "map<string, string>"))
    groups = files.select(
        F.element_at(F.split("file_path", "/"), -2).alias("capture_date"),
        F.explode(F.coalesce(by_key, F.array("value"))).alias("group"),
    ).filter(F.ltrim("group").startswith("["))
    return (
        groups.select(
            "capture_date", F.explode(F.from_json("group", INJECTIONS)).alias("i")
        )
        .filter(F.col("i").isNotNull())
        .select(
            "capture_date",
            F.col("i.inject_time").alias("inject_time"),
            F.coalesce(numbers.to_bigint(F.col("i.inject_timestamp")), F.lit(0)).alias(
                "inject_timestamp"
            ),
            F.col("i.inject_pod").alias("inject_pod"),
            F.col("i.inject_type").alias("inject_type"),
        )
    )


def read_fault_labels(
    spark: SparkSession, path: str, root: str = FAULT_ROOT, pattern: str = FAULT_FILES
) -> DataFrame:
    """Injections of every fault list; none where a capture has no list.

    A list is read as one row, so it must fit one: lists hold a day's injections.
    """
    try:
        files = spark.read.text(f"{path.rstrip('/')}/{root}/{pattern}", wholetext=True)
        files = files.select(F.col("_metadata.file_path"), "value")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "file_path string, value string")
    return explode_fault_lists(files)


def ground_truth(labels: DataFrame) -> DataFrame:
    """Labels with the service of the injected pod; same columns when there are none."""
    return labels.select(
        "capture_date", "inject_time", "inject_timestamp", "inject_pod", "inject_type",
        names.service_from_pod(F.col("inject_pod")).alias("inject_service"),
    )
