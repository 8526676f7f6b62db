from __future__ import annotations

from faultweave.operators import cleaning
from faultweave.schemas import CANONICAL


def frame(spark, table, rows):
    return spark.createDataFrame(rows, CANONICAL[table])


def ids(df, column="span_id"):
    return sorted(r[column] for r in df.collect())


def test_service_rules(spark):
    rows = [
        ("t", "svc", "ok", "p", "n", "pod", None),
        ("t", "svc", "root", None, "n", "pod", None),
        ("t", "svc", "blank", "", "n", "pod", None),
        ("t", None, "noservice", "p", "n", "pod", None),
        ("t", "svc", None, "p", "n", "pod", None),
        ("t", "svc-b", "ok", "p", "n", "pod", None),
    ]
    df = frame(spark, "trace_service_name", rows)
    kept = cleaning.clean_trace_service(df)
    assert ids(kept) == ["ok"]
    assert kept.first().service_name == "svc"
    assert kept.columns == df.columns
    assert ids(cleaning.clean_trace_service(df, keep_roots=True)) == ["blank", "ok", "root"]


def test_invalid_copy_does_not_hide_a_valid_one(spark):
    rows = [("t", None, "s", "p", "n", "pod", None), ("t", "svc", "s", "p", "n", "pod", None)]
    kept = cleaning.clean_trace_service(frame(spark, "trace_service_name", rows))
    assert [r.service_name for r in kept.collect()] == ["svc"]


def test_response_rules(spark):
    rows = [
        ("neg", -1.0, None, 1.0, None),
        ("zero", 0.0, None, 1.0, None),
        ("null", None, None, 1.0, None),
        ("noproc", 5.0, None, None, None),
        ("negproc", 5.0, None, -1.0, None),
        (None, 5.0, None, 1.0, None),
    ]
    kept = cleaning.clean_response_times(frame(spark, "trace_response_times", rows))
    assert ids(kept) == ["noproc", "zero"]


def test_request_rules(spark):
    rows = [
        ("good", "2024-01-01 00:00:00.250", "2024-01-01 00:00:01", 1.0, None, "e"),
        ("badend", "2024-01-01 00:00:00", "n/a", 1.0, None, "e"),
        ("badstart", "n/a", "2024-01-01 00:00:01", 1.0, None, "e"),
        ("nostart", None, "2024-01-01 00:00:01", 1.0, None, "e"),
    ]
    kept = cleaning.clean_request_times(frame(spark, "trace_request_times", rows))
    assert ids(kept) == ["badend", "good"]
    by_id = {r.span_id: r for r in kept.collect()}
    assert by_id["badend"].end_time_ts is None
    assert by_id["good"].start_time_ts.microsecond == 250_000


def test_resource_rules(spark):
    rows = [
        ("p", "2024-01-01 00:00:00", -1.0, 1.0, 1, 1, None, None),
        ("p", "2024-01-01 00:00:01", None, 1.0, 1, 1, None, None),
        ("p", "2024-01-01 00:00:02", 0.0, 1.0, 2**40, 1, None, None),
        ("p", "2024-01-01 00:00:02", 3.0, 1.0, 1, 1, None, None),
        ("p", "garbled", 3.0, 1.0, 1, 1, None, None),
    ]
    kept = cleaning.clean_resource_usage(frame(spark, "resource_usage", rows)).collect()
    assert {(r.timestamp, r.cpu_usage_mcores) for r in kept} == {
        ("2024-01-01 00:00:02", 0.0), ("garbled", 3.0),
    }
    assert {r.ts for r in kept if r.timestamp == "garbled"} == {None}


def test_status_rules(spark):
    rows = [("a", 200, "", 0), ("a", 503, "slow", 1), (None, 200, "", 0), ("b", None, None, None)]
    kept = cleaning.clean_status_codes(frame(spark, "status_codes", rows)).collect()
    assert {(r.span_id, r.status_code) for r in kept} == {("a", 200), ("b", None)}


def test_dedup_is_independent_of_partitioning(spark):
    df = spark.range(2000).selectExpr("id % 7 AS k", "hash(id) AS a", "cast(id AS string) AS b")
    once = sorted(map(tuple, cleaning.dedup(df.repartition(1), ["k"]).collect()))
    again = sorted(map(tuple, cleaning.dedup(df.repartition(13, "b"), ["k"]).collect()))
    assert once == again and len(once) == 7


def test_dedup_order(spark):
    df = spark.createDataFrame([("k", 2, 1), ("k", 1, 9), ("k", None, 5)], "k string, a int, b int")
    assert cleaning.dedup(df, ["k"], ["b"]).first().b == 1
    assert cleaning.dedup(df, ["k"]).first().a is None
    assert cleaning.dedup(df.select("k"), ["k"]).count() == 1


def test_drop_sparse_columns(spark):
    df = spark.createDataFrame(
        [(1, None, None, None), (2, None, None, 1), (3, None, 1, 1), (4, None, 1, 1)],
        "a int, b int, c int, d int",
    )
    assert cleaning.drop_sparse_columns(df).columns == ["a", "c", "d"]
    assert cleaning.drop_sparse_columns(df, 0.1).columns == ["a"]
    assert cleaning.drop_sparse_columns(df.limit(0)).columns == ["a", "b", "c", "d"]


def test_parsed_times_stay_out_of_the_shuffle(spark):
    requests = spark.createDataFrame(
        [("s", "2024-01-01 00:00:01", "bad"), ("s", "2024-01-01 00:00:00", "2024-01-01 00:00:02"), ("s", "n/a", None)],
        "span_id string, start_time string, end_time string",
    )
    cleaned = cleaning.clean_request_times(requests)
    plan = cleaned._jdf.queryExecution().executedPlan().toString()
    dealt = plan[plan.index("Exchange") :]
    assert "start_time" in dealt and "start_time_ts" not in dealt and "end_time_ts" not in dealt
    row = cleaned.first()
    assert str(row["start_time_ts"]) == "2024-01-01 00:00:00" and str(row["end_time_ts"]) == "2024-01-01 00:00:02"
    assert cleaned.columns == [*requests.columns, "start_time_ts", "end_time_ts"]
