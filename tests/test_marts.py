from __future__ import annotations

import pytest
from moments import at
from pyspark.sql import functions as F

from faultweave.operators import marts, scaling


@pytest.fixture
def telemetry(spans):
    df = spans([("t1", "a", None, "A", 0, 1, 10), ("t1", "b", "a", "B", 10, 0, 600),
                ("t2", "c", None, "A", 3600, 0, 30), ("t2", "d", "c", None, 3600, 0, 3000)])
    from faultweave.operators.spans import engineer_features

    return engineer_features(df.withColumns(
        {"cpu_usage_mcores": F.lit(2.0), "memory_usage_mb": F.lit(4.0)}))


def pairs(spark, rows):
    return spark.createDataFrame(
        [(a, b, 1, 1, 1, 1, 1.0, float(s)) for a, b, s in rows],
        "caller_service string, callee_service string, call_count bigint, "
        "caller_error_count bigint, callee_error_count bigint, co_failure_count bigint, "
        "avg_callee_latency_ms double, propagation_score double")


def test_names_and_filter(telemetry):
    assert [r[0] for r in marts.mart_service_names(telemetry).collect()] == ["A", "B"]
    assert marts.service_filter(telemetry, ()).count() == 4
    assert marts.service_filter(telemetry, ("A", "Z")).count() == 2
    assert marts.service_filter(telemetry, ("Z",)).count() == 0


def test_summary(telemetry):
    assert tuple(marts.mart_telemetry_summary(telemetry, ("A",)).first()) == (2, 1, 20.0, 1, 2, 50.0)
    assert tuple(marts.mart_telemetry_summary(telemetry, ("Z",)).first()) == (0, 0, None, 0, 0, None)


def test_hours_bands_categories(telemetry):
    hours = [tuple(r) for r in marts.mart_hourly(telemetry).collect()]
    assert hours == [(0, 2, 1, 1, 50.0), (1, 2, 0, 2, 0.0)]
    bands = [tuple(r) for r in marts.mart_latency_distribution(telemetry).collect()]
    assert bands == [("low", 2), ("high", 1), ("critical", 1)]
    assert [tuple(r) for r in marts.mart_error_categories(telemetry).collect()] == [
        ("success", 3), ("server_error", 1)]


def test_health_and_worst(telemetry):
    health = marts.mart_service_health(telemetry, ("A", "B"))
    assert [r.service_name for r in health.collect()] == ["A", "B"]
    assert tuple(marts.mart_worst_service(health).first()) == ("A", 2, 50.0, "critical")
    assert {tuple(r) for r in marts.rate_services(health).collect()} == {
        ("A", 50.0, "critical"), ("B", 0.0, "good")}
    assert marts.top_failing_services(health, 1).first().service_name == "A"


def test_pair_marts(spark):
    df = pairs(spark, [("A", "B", 0.9), ("A", "C", 0.5), ("B", "C", 0.0), ("C", "A", 0.9)])
    assert [(r.caller_service, r.callee_service) for r in marts.mart_pairs(df, 0.5, 2).collect()] == [
        ("A", "B"), ("C", "A")]
    assert marts.mart_report_pairs(df).count() == 3
    chains = spark.createDataFrame([("A", "B", 1), ("A", "B", 3), ("B", "A", 5)],
                                   "source_service string, target_service string, "
                                   "propagation_lag_sec bigint")
    assert tuple(marts.mart_strong_pairs(df, chains).first()) == (4, 3, 3)
    assert [tuple(r) for r in marts.mart_chain_paths(chains, 1).collect()] == [("A", "B", 2, 2.0)]
    assert marts.median_lag(chains).first()[0] == 3.0
    assert marts.median_lag(chains.limit(0)).first()[0] is None
    assert sum(r.chain_count for r in marts.mart_lag_profile(chains).collect()) == 3


def test_matrix(spark):
    df = pairs(spark, [("A", "B", 0.9), ("A", "C", 0.1), ("B", "C", 0.4), ("B", "B", 0.2)])
    names = ["A", "B", "Z"]
    full = {r.callee_service: tuple(r)[1:] for r in
            marts.mart_propagation_matrix(df, names, k=None).collect()}
    assert full == {"B": (0.9, 0.2, 0.0), "C": (0.1, 0.4, 0.0)}
    top = [tuple(r) for r in marts.mart_propagation_matrix(df, names, k=1).collect()]
    assert top == [("B", 0.9, 0.0, 0.0)]


def test_blast_radius(spark):
    df = pairs(spark, [("A", "B", 0.9), ("A", "C", 0.1), ("A", "D", 0.5), ("B", "A", 0.3)])
    got = {(r.service_name, r.direction): [] for r in marts.mart_blast_radius(df, 2).collect()}
    for r in marts.mart_blast_radius(df, 2).orderBy("rank").collect():
        got[r.service_name, r.direction].append(r.neighbour)
    assert got["A", "downstream"] == ["B", "D"] and got["A", "upstream"] == ["B"]


@pytest.fixture
def scores(spark):
    rows = [("A", 0, 1, 1, 0, 1, 1), ("A", 1, 1, 1, 1, 1, 0), ("B", 0, 0, 0, 1, 0, 0),
            ("B", 1, 1, 1, 0, 0, 0), ("C", 0, 0, 0, 0, 0, 0)]
    return spark.createDataFrame(
        [(s, at(900 * b), e, m, r, se, sl, e + m + r, int(e + m + r >= 2))
         for s, b, e, m, r, se, sl in rows],
        "service_name string, time_bucket timestamp, is_anomaly_error int, is_anomaly_latency int, "
        "is_anomaly_resource int, is_error_rate_slo_breach int, is_latency_slo_breach int, "
        "anomaly_score int, is_anomaly_overall int")


def test_anomaly_marts(scores):
    assert tuple(marts.mart_anomaly_summary(scores).first()) == (5, 3, 3, 3, 2, 60.0)
    assert tuple(marts.mart_anomaly_summary(scores, ("Z",)).first()) == (0, 0, 0, 0, 0, None)
    assert tuple(marts.mart_normal_vs_anomalous(scores).first()) == (2, 3, 60.0)
    breaches = marts.mart_slo_breaches(scores)
    assert [r.service_name for r in breaches.collect()] == ["A", "B", "C"]
    assert [(r.service_name, r.slo_breaches) for r in marts.top_slo_breaches(breaches).collect()] == [
        ("A", 3)]
    assert [tuple(r) for r in marts.mart_anomalies_by_service(scores, k=1).collect()] == [("A", 2)]
    assert [r.multi_signal for r in marts.mart_anomaly_timeline(scores).collect()] == [1, 2]
    assert {r.service_name for r in marts.mart_top4_timeline(scores, 1).collect()} == {"A"}
    assert {tuple(r) for r in marts.mart_signal_mix(scores).collect()} == {
        ("Error rate", 3), ("Latency", 3), ("Resources", 2)}


def test_pattern_marts(spark):
    df = spark.createDataFrame(
        [("A", "error_surge", 9, 1.0), ("B", "error_surge", 1, 3.0), ("B", "odd", 2, 1.0)],
        "service_name string, pattern_type string, occurrence_count bigint, avg_severity double")
    assert [tuple(r) for r in marts.mart_patterns(df).collect()] == [
        ("error_surge", 10, 2.0), ("odd", 2, 1.0)]
    assert [r.label for r in marts.label_patterns(df).orderBy("occurrence_count").collect()] == [
        "Error surge", "odd", "Error surge"]
    assert [r.occurrence_count for r in marts.mart_patterns_detail(df, ("B",), 1).collect()] == [2]


def raw_runs(spark, rows):
    return spark.createDataFrame(
        [(f"{n}_r{k}", n, n, k, t / 4, t / 4, t / 4, t / 4, t) for n, k, t in rows],
        "label string, input_rows bigint, data_size bigint, repetition int, groupby_agg_sec double, "
        "window_fn_sec double, join_sec double, shuffle_sec double, total_sec double")


def test_runs(spark):
    runs = scaling.scalability_runs(raw_runs(spark, [(2000, 1, 8.0), (1000, 2, 6.0), (1000, 1, 4.0),
                                                     (3000, 1, 0.0)]))
    got = {r.label: (r.throughput_rows_per_sec, r.speedup_vs_baseline, r.baseline_size)
           for r in runs.collect()}
    assert got == {"1000_r1": (250.0, 1.0, 1000), "1000_r2": (166.7, 0.667, 1000),
                   "2000_r1": (250.0, 0.5, 1000), "3000_r1": (0.0, 4000.0, 1000)}
    untimed = scaling.scalability_runs(raw_runs(spark, [(1000, 1, 0.0), (2000, 1, 2.0)])).collect()
    assert {(r.speedup_vs_baseline, r.baseline_size, r.baseline_time_sec) for r in untimed} == {
        (None, None, None)}


def test_scaling_metrics(spark):
    runs = scaling.scalability_runs(raw_runs(spark, [(1000, 1, 4.0), (1000, 2, 6.0), (2000, 1, 10.0)]))
    metrics = [tuple(r) for r in scaling.scalability_metrics(runs).collect()]
    assert metrics == [(1000, 2, 5.0, 208.4, 1.0, 1.0, 1.0, "near-linear"),
                       (2000, 1, 10.0, 200.0, 2.0, 0.5, 0.25, "sub-linear")]
    by_size = scaling.mart_scaling_by_size(runs)
    eff = [(r.size_ratio, r.time_ratio, r.linear_total_sec, r.efficiency, r.efficiency_status)
           for r in scaling.mart_scaling_efficiency(by_size).collect()]
    assert eff == [(1.0, 1.0, 5.0, 1.0, "good"), (2.0, 2.0, 10.0, 1.0, "good")]
    printed = scaling.mart_report_efficiency(runs).collect()[1]
    assert (printed.ratio, printed.speedup, printed.efficiency) == (2.0, 0.5, 0.25)
    ops = scaling.mart_report_ops(runs, 1).collect()
    assert [(r.data_size, r.join_sec, r.speedup_at_max_size) for r in ops] == [(1000, 1.25, 0.4)]
    assert scaling.mart_scaling_raw(runs).first().label == "1000_r1"


def test_exec_summary(spark, telemetry, scores):
    runs = raw_runs(spark, [(1000, 1, 4.0), (1000, 2, 6.0)])
    row = marts.mart_exec_summary(telemetry, scores, pairs(spark, [("A", "B", 0.1), ("B", "A", 0)]),
                                  runs).first()
    assert tuple(row) == (4, 3, 1, 1, 25.0, 60.0)
