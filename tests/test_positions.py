"""Places in a total order: against plain sorting, with hot groups, nulls, ties, no rows."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from faultweave.operators import positions
from faultweave.operators.positions import numbered
from faultweave.sources.workspace import materialise


def test_places_match_sorting(spark):
    rows = [(None if i % 7 == 0 else f"g{i % 3}" if i % 2 else "hot", (i * 37) % 501, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v long, position_of long").repartition(7)
    got = numbered(df, [F.col("v").desc_nulls_last(), F.col("position_of")], ["g"], total="n").collect()
    groups = defaultdict(list)
    for g, v, i in rows:
        groups[g].append((-v, i))
    want = {i: n for members in groups.values() for n, (_, i) in enumerate(sorted(members))}
    assert {r.position_of: r.position for r in got} == want
    assert all(r.n == len(groups[r.g]) for r in got)


def test_whole_table_and_ties(spark):
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 3 + [(None,)], "v string")
    got = numbered(df, [F.col("v").asc_nulls_first()], name="at").collect()
    assert sorted(r["at"] for r in got) == list(range(54))
    assert [r["v"] for r in sorted(got, key=lambda r: r["at"])] == [None] + ["a"] * 50 + ["b"] * 3


def test_no_rows(spark):
    assert numbered(spark.createDataFrame([], "v string"), [F.col("v")]).collect() == []


def test_a_hot_group_lies_in_many_tasks(spark, monkeypatch):
    written = []
    monkeypatch.setattr(positions, "materialise", lambda df, name: written.append(materialise(df, name)) or written[-1])
    df = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id").alias("v")).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = numbered(df, [F.col("v")], ["g"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert written[0].groupBy("_part").count().agg(F.max("count")).first()[0] < 10_000
    assert placed.filter("position <> v").count() == 0
