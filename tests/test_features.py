from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from faultweave.functions import features, names, numbers
from faultweave.operators import spans as span_ops


def values(spark, data, type_name, build):
    df = spark.createDataFrame([(v,) for v in data], f"x {type_name}")
    return [r[0] for r in df.select(build(F.col("x"))).collect()]


def test_status_features(spark):
    codes = [200, 399, 400, 499, 500, 503, None]
    assert values(spark, codes, "int", features.is_failure) == [0, 0, 0, 0, 1, 1, 0]
    assert values(spark, codes, "int", features.error_category) == [
        "success", "success", "client_error", "client_error", "server_error", "server_error",
        "success",
    ]


def test_latency_features(spark):
    ms = [99.99, 100.0, 499.9, 500.0, 2000.0, 2000.01, None]
    assert values(spark, ms, "double", features.latency_bucket) == [
        "low", "medium", "medium", "high", "critical", "critical", "critical",
    ]
    assert values(spark, ms, "double", features.is_latency_spike) == [0, 0, 0, 0, 0, 1, 0]


def test_ratio(spark):
    df = spark.createDataFrame(
        [(4.0, 2.0), (4.0, 0.0), (4.0, None), (None, 2.0), (None, None)], "c double, m double"
    )
    got = [r[0] for r in df.select(features.cpu_memory_ratio(F.col("c"), F.col("m"))).collect()]
    assert got == [2.0, 0.0, 0.0, None, 0.0]


def test_service_from_pod(spark):
    pods = ["a-b-hash-suffix", "svc-x", "svc-x-y", "nodash", None, "a--b"]
    assert values(spark, pods, "string", names.service_from_pod) == [
        "a-b", "svc-x", "svc", "nodash", None, "a--b",
    ]


def test_lookup_and_namespace(spark):
    build = lambda c: names.namespace_of(c, {"2022-08-22": "shop"})
    assert values(spark, ["2022-08-22", "x", None], "string", build) == ["shop", "unknown", "unknown"]
    assert values(spark, ["error_surge", "novel"], "string", names.pattern_label) == [
        "Error surge", "novel",
    ]


def test_error_rate_status(spark):
    assert values(
        spark, [0.0, 0.99, 1.0, 4.99, 5.0, 15.0, None], "double", features.error_rate_status
    ) == ["good", "good", "warning", "warning", "serious", "critical", "neutral"]


@pytest.mark.parametrize(
    "efficiency,status,note",
    [
        (1.2, "good", "super-linear - overhead amortised"),
        (1.1, "good", "near-linear scaling"),
        (0.9, "good", "near-linear scaling"),
        (0.7, "warning", "sub-linear, acceptable"),
        (0.5, "serious", "overhead dominating"),
        (0.49, "critical", "scaling has broken down"),
    ],
)
def test_efficiency_bands(spark, efficiency, status, note):
    assert values(spark, [efficiency], "double", features.efficiency_status) == [status]
    assert values(spark, [efficiency], "double", features.efficiency_note) == [note]


def test_patterns_cover_all_flags(spark):
    df = spark.sql(
        "SELECT e, l, r FROM VALUES (0),(1) a(e), VALUES (0),(1) b(l), VALUES (0),(1) c(r)"
    )
    got = {
        (r.e, r.l, r.r): r.p
        for r in df.withColumn(
            "p", features.pattern_type(F.col("e"), F.col("l"), F.col("r"))
        ).collect()
    }
    assert got == {
        (0, 0, 0): "normal", (1, 0, 0): "error_surge", (0, 1, 0): "latency_spike",
        (0, 0, 1): "resource_pressure", (1, 1, 0): "cascading_failure",
        (0, 1, 1): "resource_exhaustion", (1, 0, 1): "error_resource_link",
        (1, 1, 1): "full_failure",
    }


def test_bad_numbers_become_null(spark):
    raw = ["12", "12.9", "abc", "", None, "1661152800123456789"]
    assert values(spark, raw, "string", numbers.to_bigint) == [
        12, 12, None, None, None, 1661152800123456789,
    ]
    assert values(spark, ["1.5", "abc", None], "string", numbers.to_double) == [1.5, None, None]


def test_nanos_keep_their_milliseconds(spark):
    build = lambda c: F.date_format(numbers.nanos_to_timestamp(c), "HH:mm:ss.SSS")
    assert values(spark, [1704067200123000000, 1704067200123999999], "bigint", build) == [
        "00:00:00.123", "00:00:00.123",
    ]


def test_zscore_and_limits(spark):
    df = spark.createDataFrame(
        [(5.0, 1.0, 2.0), (5.0, 1.0, 0.0), (5.0, 1.0, None), (None, 1.0, 2.0)],
        "v double, m double, s double",
    )
    got = [r[0] for r in df.select(numbers.zscore(F.col("v"), F.col("m"), F.col("s"))).collect()]
    assert got == [2.0, 0.0, 0.0, None]
    over = lambda c: numbers.above(c, 0.05)
    assert values(spark, [0.05, 0.0500001, None], "double", over) == [0, 1, 0]
    assert values(spark, [9.0], "double", lambda c: numbers.above(c, None)) == [0]


def test_engineer_features_adds_every_column(spark):
    df = spark.sql(
        "SELECT 500 AS status_code, 50.0D AS response_time_ms, 4.0D AS cpu_usage_mcores, "
        "2.0D AS memory_usage_mb, timestamp'2024-01-01 13:05:00' AS start_time_ts"
    )
    row = span_ops.engineer_features(df).first()
    assert (
        row.is_failure, row.is_latency_spike, row.latency_bucket, row.error_category,
        row.hour_of_day, row.cpu_memory_ratio,
    ) == (1, 0, "low", "server_error", 13, 2.0)
