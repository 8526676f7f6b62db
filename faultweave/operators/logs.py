"""Filtering of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.functions import names


def parse_log(
    df: DataFrame,
    min_level: str = "INFO",
    search: str = "",
    tail: int | None = None,
    order: str = "line_no",
) -> DataFrame:
    """Lines at or above a level that contain `search`, whatever its case.

    Of (`order`, line) rows only the last `tail` are considered. A line that does
    not parse (banner, traceback) is kept while the threshold is at most INFO.
    """
    lines = df.orderBy(F.col(order).desc(), F.col("line").desc()).limit(tail) if tail else df
    if search:
        lines = lines.filter(F.contains(F.lower("line"), F.lit(search.lower())))
    threshold = names.LEVELS.index(min_level)
    parsed = lines.select(
        order,
        "line",
        F.nullif(F.regexp_extract("line", names.LOG_LINE, 1), F.lit("")).alias("ts"),
        names.log_level(F.col("line")).alias("level"),
        F.regexp_extract("line", names.LOG_LINE, 3).alias("_text"),
    )
    loud = names.level_rank(F.col("level")) >= threshold
    kept = loud | F.col("level").isNull() if threshold <= names.LEVELS.index("INFO") else loud
    return parsed.filter(kept).select(
        order, "ts", "level",
        F.when(F.col("level").isNull(), F.col("line")).otherwise(F.col("_text")).alias("message"),
    )
