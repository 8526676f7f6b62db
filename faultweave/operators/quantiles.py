"""Exact percentiles per group, without gathering a group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per unit of log(1 + |value|): a bucket is a hundredth wide.
RESOLUTION = 1e2


def bucket_of(value: Column) -> Column:
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * RESOLUTION)


def bucket_counts(df: DataFrame, groups: Sequence[str], value: str, parts: Sequence[str] = ()) -> DataFrame:
    """Rows per part, group and logarithmic bucket: `bucket`, null for a null value, and `n`.

    Counts of parts add up, so a table by capture date takes a new date's counts beside those
    it holds, and counts of finer groups serve coarser ones. A group has a few thousand buckets
    at most, whatever its rows.
    """
    return df.groupBy(*parts, *groups, bucket_of(F.col(value)).alias("bucket")).agg(F.count("*").alias("n"))


def grouped_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    counts: DataFrame | None = None,
) -> DataFrame:
    """Per group, the smallest value with at least each share of the values up to it.

    Exact at any size, in two passes. The first, `bucket_counts`, finds the bucket that each
    rank falls into; hand in `counts` where they are stored, of the same rows by the same or
    finer groups. The second counts the distinct values inside the buckets that are hit. Both
    are partial counts before their shuffle, and the running sums see counts, never rows.
    Groups without a value are left out; a NULL group is a group.
    """
    names = [f"_g{i}" for i in range(len(groups))]
    rows = df.select(*[F.col(g).alias(n) for g, n in zip(groups, names)], F.col(value).alias("_v"))
    rows = rows.filter(F.col("_v").isNotNull()).withColumn("_b", bucket_of(F.col("_v")))
    if counts is None:
        counts = bucket_counts(df, groups, value)
    counts = counts.filter(F.col("bucket").isNotNull()).select(
        *[F.col(g).alias(n) for g, n in zip(groups, names)], F.col("bucket").alias("_b"), "n"
    )
    counts = counts.groupBy(*names, "_b").agg(F.sum("n").alias("_n"))
    whole = Window.partitionBy(*names)
    ranks = [
        F.struct(F.lit(name).alias("name"), F.ceil(F.col("_all") * F.lit(share)).alias("rank"))
        for name, share in shares.items()
    ]
    reached = counts.select(
        "*", F.sum("_n").over(whole.orderBy("_b")).alias("_upto"), F.sum("_n").over(whole).alias("_all")
    ).withColumn("_want", F.explode(F.array(*ranks)))
    before = F.col("_upto") - F.col("_n")
    hits = reached.filter(F.col("_want.rank").between(before + 1, F.col("_upto"))).select(
        *[F.col(n).alias(f"{n}_hit") for n in names], F.col("_b").alias("_b_hit"),
        F.col("_want.name").alias("_name"), (F.col("_want.rank") - before).alias("_rank"),
    )
    same = F.col("_b") == F.col("_b_hit")
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"{n}_hit"))
    inside = rows.join(hits.drop("_name", "_rank").distinct(), same, "left_semi")
    values = inside.groupBy(*names, "_b", "_v").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*names, "_b").orderBy("_v"))
    met = values.withColumn("_upto", upto).join(hits, same).filter(
        F.col("_rank").between(F.col("_upto") - F.col("_n") + 1, F.col("_upto"))
    )
    return met.groupBy(*names).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in shares]
    ).withColumnsRenamed(dict(zip(names, groups)))


def exact_percentile(df: DataFrame, value: str, percentile: float, counts: DataFrame | None = None) -> Column:
    """The same over all rows, as a scalar; NULL without rows."""
    found = grouped_percentiles(df, [], value, {"p": percentile}, counts)
    return found.agg(F.max("p")).scalar()
