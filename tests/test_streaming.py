"""Streams from files against the batch operators: two or more batches, late rows, any cut."""

from __future__ import annotations

import random

import pytest
from moments import at

from faultweave.operators import anomalies, callgraph
from faultweave.streaming import live

SCHEMA = (
    "trace_id string, span_id string, service_name string, start_time_ts timestamp, is_failure int, "
    "response_time_ms double, cpu_usage_mcores double, memory_usage_mb double"
)


def span(i: int, second: float, rng: random.Random, trace: str | None = None) -> tuple:
    failed = int(rng.random() < 0.4)
    return (
        trace or f"t{i % 9}", f"s{i:05}", f"svc{rng.randrange(4)}", at(second), failed,
        rng.uniform(1, 3000), rng.choice([None, rng.uniform(1, 9)]), rng.uniform(1, 9),
    )


@pytest.fixture
def feed(spark, tmp_path):
    """Runs a stream over batches of rows, each written and published before the next; the last
    batch is far ahead, so that the watermark closes everything before it."""

    def run(make, batches):
        source, out = str(tmp_path / "in"), str(tmp_path / "out")
        end = [("end", "end", "end", at(10**7), 0, 1.0, 1.0, 1.0)]
        for rows in [*batches, end, [(*end[0][:3], at(10**7 + 1), *end[0][4:])]]:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
            stream = make(spark.readStream.schema(SCHEMA).parquet(source))
            query = live.publish(stream, out, str(tmp_path / "checkpoint"))
            assert query.awaitTermination(120) and query.exception() is None
        return spark.read.parquet(out)

    return run


def as_rows(df, columns):
    """Sums depend in their last bits on the order of adding."""
    rounded = [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(columns).collect()]
    return sorted(rounded, key=str)


def test_scores_of_a_stream_equal_the_batch(spark, feed):
    rng = random.Random(1)
    first = [span(i, rng.uniform(0, 7200), rng) for i in range(400)]
    # Late by up to ten minutes behind the newest of the first batch.
    second = [span(1000 + i, rng.uniform(6800, 12_000), rng) for i in range(300)]
    whole = spark.createDataFrame(first + second, SCHEMA)
    series = anomalies.error_rate_timeseries(whole)
    baseline = anomalies.baseline_stats(series).filter("service_name <> 'svc3'")
    want = anomalies.score_against(series.join(baseline, "service_name", "left"))
    got = feed(lambda spans: live.live_scores(spans, baseline), [first, second]).filter("service_name <> 'end'")
    assert as_rows(got, want.columns) == as_rows(want, want.columns)
    assert got.filter("is_error_rate_slo_breach = 1").count() > 0


def test_rows_behind_the_watermark_are_dropped(spark, feed):
    rng = random.Random(2)
    first = [span(i, 7200 + i, rng) for i in range(60)]
    late = [span(100, 10, rng)]
    got = feed(lambda spans: live.live_series(spans, 15), [first, late]).filter("service_name <> 'end'")
    assert got.agg({"total_requests": "sum"}).first()[0] == 60


@pytest.mark.parametrize("cuts", [1, 2, 5])
def test_chains_of_a_stream_equal_the_batch(spark, feed, cuts):
    rng = random.Random(3)
    rows = [span(i, rng.uniform(0, 2400), rng, "hot" if i % 3 else None) for i in range(300)]
    rows += [span(1000 + i, 240 * i, rng, "edges") for i in range(9)]
    # Arrival is out of order by up to five minutes.
    rows.sort(key=lambda r: (r[3] - at(0)).total_seconds() + rng.uniform(0, 300))
    batches = [rows[i * len(rows) // cuts : (i + 1) * len(rows) // cuts] for i in range(cuts)]
    want = callgraph.propagation_chains(spark.createDataFrame(rows, SCHEMA))
    got = feed(lambda spans: live.live_chains(spans), batches)
    assert as_rows(got, want.columns) == as_rows(want, want.columns) and want.count() > 20
