"""Capture files to reports through every run_* function."""

from __future__ import annotations

import json

import pytest

from faultweave.operators import anomalies, callgraph, faults, marts
from faultweave.plans.cross_service import run_cross_service
from faultweave.plans.failure_detection import run_failure_detection
from faultweave.plans.normalise import run_normalise
from faultweave.plans.preprocess import preprocess, run_preprocess
from faultweave.plans.reports import run_sql_reports
from faultweave.sources import canonical, labels, raw
from faultweave.sources.tables import TableStore

TRACE = "TraceID,SpanID,ParentID,PodName,OperationName,StartTimeUnixNano,EndTimeUnixNano,Duration"
METRIC = (
    "Time,TimeStamp,PodName,CpuUsage(m),CpuUsageRate(%),MemoryUsage(Mi),MemoryUsageRate(%),"
    "NetworkReceiveBytes,NetworkTransmitBytes"
)
START = 1661126400


def capture(path, faulty: bool = True):
    """Two services; the callee slows down in the fault capture."""
    for root, slow in (("construct_data", 1), ("rca_data", 50))[: 2 if faulty else 1]:
        folder = path / root / "2022-08-22"
        (folder / "trace").mkdir(parents=True)
        (folder / "metric").mkdir()
        rows = [TRACE]
        for i in range(80):
            at = (START + i * 7) * 10**9
            for span, parent, pod, ms in (("a", "root", "front-x-1", 40), ("b", f"{root}a{i}", "back-x-1", 20 * slow)):
                rows.append(f"t{i},{root}{span}{i},{parent},{pod},/{span},{at},{at + ms * 10**6},{ms * 1000}")
        (folder / "trace" / "all.csv").write_text("\n".join(rows) + "\n")
        metric = [METRIC] + [f"x,{START + m * 60},{p},{m},0,100,0,1,1" for m in range(10) for p in ("front-x-1", "back-x-1")]
        (folder / "metric" / "pods_metric.csv").write_text("\n".join(metric) + "\n")
    if faulty:
        listed = {"0": [{"inject_time": "t", "inject_timestamp": START + 60, "inject_pod": "back-x-1", "inject_type": "cpu"}]}
        (path / "rca_data" / "2022-08-22" / "2022-08-22-fault_list.json").write_text(json.dumps(listed))
    return str(path)


def test_every_stage_follows_from_the_one_before(spark, tmp_path):
    path, out = capture(tmp_path / "in"), str(tmp_path / "canonical")
    store = TableStore(spark, str(tmp_path / "store"))
    counts = run_normalise(spark, path, out, store)
    assert counts["trace_service_name"] == 320
    telemetry = run_preprocess(spark, out, str(tmp_path / "telemetry"), store)
    assert store.read("processed_telemetry").count() == telemetry.count() == 320
    assert telemetry.count() == preprocess(canonical.read_canonical(spark, out)).count()
    run_cross_service(telemetry, store, str(tmp_path / "chains"))
    assert sorted(store.read("cross_service_pairs").collect()) == sorted(
        callgraph.service_dependency_graph(telemetry).collect()
    )
    assert store.read("propagation_chains").count() == callgraph.propagation_chains(telemetry).count()
    run_failure_detection(telemetry, store, str(tmp_path / "scores"))
    scores = anomalies.score_anomalies(anomalies.error_rate_timeseries(telemetry))
    assert store.read("anomaly_scores").count() == scores.count()
    reports = run_sql_reports(spark, telemetry, store)
    assert reports["ground_truth_evaluation"] == 1
    assert all(store.read(name).count() == n for name, n in reports.items())
    windows = faults.join_fault_window(telemetry, store.read("fault_injections")).collect()
    assert {w.inject_service for w in windows} == {"back"}
    assert all(START + 60 <= w.span_epoch <= START + 360 for w in windows) and len(windows) > 10


def test_capture_without_faults(spark, tmp_path):
    path = capture(tmp_path / "in", faulty=False)
    store = TableStore(spark, str(tmp_path / "store"))
    counts = run_normalise(spark, path, str(tmp_path / "canonical"), store)
    assert counts["trace_service_name"] == 160 and store.read("fault_injections").count() == 0
    assert labels.read_fault_labels(spark, path).count() == 0
    telemetry = run_preprocess(spark, str(tmp_path / "canonical"), str(tmp_path / "t"), store)
    assert "ground_truth_evaluation" not in run_sql_reports(spark, telemetry, store)


def test_columns_in_another_order_are_read_by_their_header(spark, tmp_path):
    path = capture(tmp_path / "in")
    other = tmp_path / "in" / "construct_data" / "2022-08-22" / "metric" / "other_metric.csv"
    head = METRIC.replace("CpuUsage(m)", "?").replace("MemoryUsage(Mi)", "CpuUsage(m)").replace("?", "MemoryUsage(Mi)")
    other.write_text(f"{head}\nx,{START},p-x-1,1,0,2,0,1,1\n")
    rows = {r.pod_id: r for r in raw.read_metrics(spark, path).collect()}
    assert (rows["p-x-1"].cpu_usage_mcores, rows["p-x-1"].memory_usage_mb) == (2.0, 1.0)
    assert len(rows) > 1
    # Where tasks can't list the files, such a file is still never read for another.
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(raw.listing, "can_list", lambda path: False)
        with pytest.raises(Exception, match="header"):
            raw.read_metrics(spark, path).collect()


def test_injection_windows(spark):
    from moments import at

    rows = [("s", at(n), f) for n, f in ((9, 1), (10, 1), (10, 0), (310, 1), (311, 1), (500, 0))]
    telemetry = spark.createDataFrame(rows, "service_name string, start_time_ts timestamp, is_failure int")
    base = int(at(0).timestamp())
    truth = [("s", "cpu", base + 10), ("s", "cpu", base + 10), ("s", "net", base + 300), ("idle", "cpu", base), (None, "cpu", base)]
    truth = spark.createDataFrame(truth, "inject_service string, inject_type string, inject_timestamp long")
    got = {
        (r.inject_service, r.inject_type, r.span_epoch and r.span_epoch - base): (r.spans, r.failures)
        for r in faults.join_fault_window(telemetry, truth).collect()
    }
    assert got == {
        ("s", "cpu", 10): (4, 2), ("s", "cpu", 310): (2, 2),
        ("s", "net", 310): (1, 1), ("s", "net", 311): (1, 1), ("s", "net", 500): (1, 0),
        ("idle", "cpu", None): (None, None), (None, "cpu", None): (None, None),
    }


def test_results_beyond_the_old_limits_are_whole(spark):
    n = 401
    pairs = spark.range(n).selectExpr(
        "concat('a', id) AS caller_service", "concat('b', id) AS callee_service", "0.5D AS propagation_score"
    )
    assert marts.mart_pairs(pairs).count() == n
    names = [f"a{i}" for i in range(n)]
    assert marts.mart_propagation_matrix(pairs, names[:20]).count() == n
    chains = spark.range(60_000).selectExpr(
        "CAST(id AS string) AS trace_id", "'s' AS source_service", "'t' AS target_service",
        "timestamp_seconds(id) AS source_timestamp", "timestamp_seconds(id + 1) AS target_timestamp",
    )
    assert callgraph.first_chains(chains).count() == 60_000 and callgraph.first_chains(chains, 5).count() == 5


def test_many_services_in_one_minute_are_shared_out(spark):
    rates = spark.range(2000).selectExpr(
        "concat('s', id) AS service_name", "timestamp_seconds(0) AS minute_ts", "CAST(id % 7 AS double) AS error_rate"
    )
    paired = callgraph.paired_series(rates)
    assert paired.count() == 2000 * 1999 // 2
    shares = -(-2000 // callgraph.SHARE_SERVICES)
    shared = rates.selectExpr(f"pmod(xxhash64(service_name), {shares}) AS s").groupBy("s").count()
    assert max(r["count"] for r in shared.collect()) < 2 * callgraph.SHARE_SERVICES
