from __future__ import annotations

from moments import at
from pyspark.sql import functions as F

from faultweave.operators import canonical, selftime
from faultweave.operators import spans as span_ops


def usage(spark, rows):
    return spark.createDataFrame(
        [(p, at(s) if s is not None else None, c, m) for p, s, c, m in rows],
        "pod_id string, ts timestamp, cpu_usage_mcores double, memory_usage_mb double",
    )


def test_resource_join_keeps_span_count(spark):
    spans = spark.createDataFrame(
        [("a", "p", at(5)), ("b", "p", at(65)), ("c", "q", at(5)), ("d", None, at(5))],
        "span_id string, pod_id string, start_time_ts timestamp",
    )
    res = usage(spark, [("p", 1, 10.0, 100.0), ("p", 59, 30.0, 300.0), ("p", 600, 1.0, 1.0),
                        ("z", None, 1.0, 1.0)])
    got = {r.span_id: (r.cpu_usage_mcores, r.memory_usage_mb)
           for r in span_ops.join_resources(spans, res).collect()}
    assert got == {"a": (20.0, 200.0), "b": (None, None), "c": (None, None), "d": (None, None)}


def test_join_spans_is_inner_on_all_four(spark):
    def one(rows, extra):
        return spark.createDataFrame(rows, f"span_id string, {extra} int")

    tables = {
        "trace_service_name": one([("a", 1), ("b", 1), ("c", 1)], "t"),
        "trace_response_times": one([("a", 2), ("b", 2)], "r"),
        "trace_request_times": one([("a", 3), ("c", 3)], "q"),
        "status_codes": one([("a", 4), ("b", 4), ("c", 4)], "s"),
    }
    got = span_ops.join_spans(tables).collect()
    assert [tuple(r) for r in got] == [("a", 1, 2, 3, 4)]


def traces(spark, rows):
    return spark.createDataFrame(
        rows,
        "span_id string, parent_span_id string, duration_ms double, endpoint string, "
        "capture_root string",
    )


def test_self_time(spark):
    rows = [
        ("root", None, 100.0, "e", "baseline"),
        ("x", "root", 30.0, "e", "baseline"),
        ("y", "root", 20.0, "e", "baseline"),
        ("deep", "x", 50.0, "e", "baseline"),
        ("orphan", "gone", 7.0, "e", "baseline"),
    ]
    got = {r.span_id: r.self_time_ms
           for r in selftime.add_self_time(traces(spark, rows)).collect()}
    assert got == {"root": 50.0, "x": 0.0, "y": 20.0, "deep": 50.0, "orphan": 7.0}
    sums = {r.parent_span_id: r.child_duration_ms
            for r in selftime.child_time(traces(spark, rows)).collect()}
    assert sums == {None: 100.0, "root": 50.0, "x": 50.0, "gone": 7.0}


def timed(spark, rows):
    return spark.createDataFrame(
        rows, "span_id string, endpoint string, capture_root string, self_time_ms double"
    )


def test_ceiling_falls_back_below_thirty_samples(spark):
    rows = [(f"f{i}", "few", "baseline", float(i)) for i in range(29)]
    rows += [(f"m{i}", "many", "baseline", 1000.0 + i) for i in range(30)]
    rows += [("n", "fault-only", "fault", 5000.0)]
    df = timed(spark, rows)
    got = {r.endpoint: (r.baseline_p99_ms, r.baseline_samples)
           for r in selftime.latency_ceiling(df).collect()}
    assert got == {"few": (1029.0, 29), "many": (1029.0, 30)}
    judged = selftime.flag_degraded(
        selftime.join_latency_ceiling(df, selftime.latency_ceiling(df))
    )
    flags = {r.span_id: (r.baseline_p99_ms, r.is_degraded) for r in judged.collect()}
    assert flags["n"] == (None, 0)
    assert flags["m29"] == (1029.0, 0)  # equal to the ceiling is not degraded


def test_either_join_of_ceilings_gives_the_same_rows(spark):
    df = timed(spark, [(f"s{i}", f"e{i % 5}", "baseline", float(i)) for i in range(200)])
    ceilings = selftime.latency_ceiling(df)
    near = selftime.join_latency_ceiling(df, F.broadcast(ceilings))
    far = selftime.join_latency_ceiling(df, ceilings.hint("merge"))
    assert sorted(map(str, near.collect())) == sorted(map(str, far.collect()))


def test_status_message(spark):
    df = spark.createDataFrame(
        [("a", 12.345, 10.0, 1), ("b", 1.0, None, 0)],
        "span_id string, self_time_ms double, baseline_p99_ms double, is_degraded int",
    )
    got = {r.span_id: (r.status_code, r.error_message, r.is_error)
           for r in canonical.canonical_status_codes(df).collect()}
    assert got["a"] == (
        503, "Self time 12.35 ms exceeded the fault-free p99 of 10.0 ms for this operation", 1
    )
    assert got["b"] == (200, "", 0)


def test_byte_counters_may_pass_two_gigabytes(spark):
    df = spark.createDataFrame(
        [("p", 1704067200, 1.0, 2.0, 5e9, None)],
        "pod_id string, epoch_sec bigint, cpu_usage_mcores double, memory_usage_mb double, "
        "network_rx_bytes double, network_tx_bytes double",
    )
    row = canonical.canonical_resource_usage(df).first()
    assert (row.network_rx_bytes, row.network_tx_bytes, row.timestamp) == (
        5_000_000_000, None, "2024-01-01 00:00:00",
    )
