"""Places of rows in a total order, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.sources.workspace import materialise

# Rows of one partition have ids from one multiple of this number.
PARTITION_ROWS = 1 << 33


def numbered(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Adds the place of each row in `order` within `group`, counted from 0.

    With `total`, a column of that name holds the number of rows of the group.

    The table is range-partitioned by group and order and written with each row's number
    in its partition. A stretch is what a partition holds of a group; the rows of the
    stretches before it, summed, are where it starts. So only one row per partition and
    group is ever put in order in a window, and a group of any size lies in many tasks.

    Defined results: a null group is a group; rows equal in `order` get consecutive
    places in no fixed order and stand together in one task, so end `order` with a column
    that tells rows apart where many may be equal; an empty table gives no rows. Writes
    two tables to the shared folder.
    """
    columns = df.columns
    keys = [F.col(c).asc() for c in group] + list(order)
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = materialise(
        sorted_rows.withColumns(
            {
                "_part": F.spark_partition_id(),
                "_row": F.monotonically_increasing_id() % PARTITION_ROWS,
            }
        ),
        "placed",
    )
    stretches = placed.groupBy("_part", *group).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_rows")
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(
        F.col("_part").alias("_in"),
        *[F.col(c).alias(f"_group_{i}") for i, c in enumerate(group)],
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("_total"),
    )
    # Written, so that its size is known: Spark broadcasts it only where it is small.
    starts = materialise(starts, "starts")
    same = F.col("_part") == F.col("_in")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_group_{i}"))
    place = (F.col("_start") + F.col("_row")).alias(name)
    totals = [F.col("_total").alias(total)] if total else []
    return placed.join(starts, same).select(*columns, place, *totals)
