from __future__ import annotations

import math
import random

import pytest

from faultweave.operators import selftime
from faultweave.operators.quantiles import bucket_counts, exact_percentile, grouped_percentiles
from faultweave.sources.tables import TableStore


def percentile_of(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return spark.range(1).select(exact_percentile(df, "x", p).alias("p")).first().p


@pytest.mark.parametrize("p", [0.01, 0.5, 0.99, 1.0])
def test_equals_sorting(spark, p):
    rng = random.Random(5)
    values = [rng.choice([0.0, 7.5, rng.expovariate(0.01), rng.uniform(100, 100.0001)])
              for _ in range(3000)]
    assert percentile_of(spark, values, p) == sorted(values)[math.ceil(p * len(values)) - 1]


def test_one_value_holding_a_third(spark):
    values = [42.0] * 1000 + [float(i) for i in range(2000)]
    assert percentile_of(spark, values, 0.03) == sorted(values)[89]
    assert percentile_of(spark, [42.0] * 500, 0.99) == 42.0


def test_nulls_are_ignored_and_nothing_gives_null(spark):
    assert percentile_of(spark, [None, 3.0, None], 0.99) == 3.0
    assert percentile_of(spark, [None], 0.99) is None


def test_groups_with_several_ranks_and_a_hot_one(spark):
    rng = random.Random(9)
    rows = [("hot", rng.choice([5.0, rng.expovariate(0.01)])) for _ in range(20_000)]
    rows += [(None, float(i)) for i in range(7)] + [("minus", -float(i)) for i in range(50)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    got = {r.g: r.asDict() for r in grouped_percentiles(df, ["g"], "x", shares).collect()}
    assert set(got) == {"hot", None, "minus"}
    for group, row in got.items():
        values = sorted(v for g, v in rows if g == group)
        for name, share in shares.items():
            assert row[name] == values[math.ceil(share * len(values)) - 1]


def test_percentiles_gather_no_rows(spark):
    df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS double) AS x")
    plan = grouped_percentiles(df, ["g"], "x", {"p": 0.9})._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan.lower() and "collect" not in plan.lower()


def test_stored_counts_serve_coarser_groups(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice("xyz"), rng.expovariate(0.01)) for _ in range(5000)] + [("a", None, None)]
    df = spark.createDataFrame(rows, "g string, h string, x double")
    counts = bucket_counts(df, ["g", "h"], "x")
    assert counts.count() < 5000 and counts.agg({"n": "sum"}).first()[0] == 5001
    for groups in (["g", "h"], ["g"], []):
        fresh = grouped_percentiles(df, groups, "x", {"p50": 0.5, "p99": 0.99}).collect()
        stored = grouped_percentiles(df, groups, "x", {"p50": 0.5, "p99": 0.99}, counts).collect()
        assert sorted(map(str, fresh)) == sorted(map(str, stored)) and fresh


def test_learning_date_by_date_equals_learning_at_once(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        (f"/e{i % 7}", "fault" if i % 11 == 0 else "baseline", f"2022-08-{10 + i % 3}", rng.expovariate(0.01) if i % 50 else None)
        for i in range(4000)
    ] + [("/rare", "baseline", "2022-08-12", 3.0)]
    spans = spark.createDataFrame(rows, "endpoint string, capture_root string, capture_date string, self_time_ms double")
    store = TableStore(spark, str(tmp_path))
    for date in ("2022-08-10", "2022-08-12", "2022-08-11", "2022-08-12"):  # one date comes twice
        counts = selftime.self_time_counts(spans.filter(spans.capture_date == date), by_date=True)
        store.write(counts, "self_time_counts", parts=["capture_date"])
    once = selftime.latency_ceiling(spans).collect()
    by_date = selftime.latency_ceiling(spans, counts=store.read("self_time_counts")).collect()
    assert sorted(map(tuple, by_date)) == sorted(map(tuple, once)) and len(once) == 8
