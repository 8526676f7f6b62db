from __future__ import annotations

import io
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from faultweave.config import ROOTS
from faultweave.operators.logs import parse_log
from faultweave.plans import normalise
from faultweave.sources import canonical, labels, listing, manifest, raw, tables, workspace

TRACE = "TraceID,SpanID,ParentID,PodName,OperationName,StartTimeUnixNano,EndTimeUnixNano,Duration"
METRIC = ("Time,TimeStamp,PodName,CpuUsage(m),CpuUsageRate(%),MemoryUsage(Mi),MemoryUsageRate(%),"
          "NetworkReceiveBytes,NetworkTransmitBytes")


@pytest.fixture
def captures(tmp_path):
    """A small capture: two roots, a summary beside the pod metrics, one broken file."""

    def put(name, text):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)

    put("construct_data/2022-08-22/trace/a.csv", "\n".join([
        TRACE,
        "t1,s1,,cart-abc-x1,op,1704067200123456789,1704067201000000000,1500",
        "t1,s2,s1,web-abc-x1,op,1704067200000000000,1704067201000000000,abc",
        "t1,,s1,web-abc-x1,op,1704067200000000000,1704067201000000000,10",
        "t1,s4,s1,web-abc-x1,op,1704067200000000000,1704067201000000000,-5",
    ]) + "\n")
    put("rca_data/2023-05-05/trace/b.csv", TRACE + "\nt2,s5,,api-abc-x1,op,1,2,0\n")
    put("construct_data/2022-08-22/metric/cart_metric.csv", "\n".join([
        METRIC,
        "x,1704067200,cart-abc-x1,12.5,0,64,0,5000000000,7",
        "x,1704067260,cart-abc-x1,-1,0,64,0,1,1",
        "x,,cart-abc-x1,1,0,64,0,1,1",
        "x,1704067320,,1,0,64,0,1,1",
        "x,1704067380,cart-abc-x1,bad,0,64,0,1,1",
    ]) + "\n")
    put("construct_data/2022-08-22/metric/front_service.csv", "a,b\n1,2\n")
    put("construct_data/2022-08-22/log/empty.csv", "")
    put("construct_data/2022-08-22/log/bom.csv",
        "\ufeff Timestamp ,TimeUnixNano,Node,PodName,Container,TraceID,SpanID,Log,More\n1,2,3,4,5,6,7,8,9\n")
    put("construct_data/2023-01-29/log/short.csv", "Timestamp,Node\n1,2\n1,2\n")
    put("rca_data/2022-08-22/2022-08-22-fault_list.json", json.dumps({
        "10": [{"inject_time": "10:00", "inject_timestamp": 1704067200,
                "inject_pod": "cart-abc-x1", "inject_type": "cpu"},
               {"inject_time": "10:30", "inject_pod": "web-abc-x1", "inject_type": "net"}],
        "11": {"not": "a list"},
    }))
    put("rca_data/2022-08-23/2022-08-23-fault_list.json", json.dumps([
        {"inject_time": "12:00", "inject_timestamp": "5", "inject_pod": "solo", "inject_type": "x"}]))
    put("rca_data/2023-01-29/2023-01-29-fault_list.json", "{broken")
    return str(tmp_path)


def test_traces(spark, captures):
    got = {r.span_id: r for r in raw.read_traces(spark, captures).collect()}
    assert set(got) == {"s1", "s5"}
    s1 = got["s1"]
    assert (s1.parent_span_id, s1.service_name, s1.duration_ms, s1.start_ns, s1.capture_date,
            s1.capture_root) == (None, "cart", 1.5, 1704067200123456789, "2022-08-22", "baseline")
    assert (got["s5"].capture_date, got["s5"].capture_root, got["s5"].duration_ms) == (
        "2023-05-05", "fault", 0.0)


def test_one_root_may_be_absent_but_not_all(spark, captures):
    one = raw.read_traces(spark, captures, roots=("construct_data", "elsewhere"))
    assert [r.span_id for r in one.collect()] == ["s1"]
    with pytest.raises(PySparkException):
        raw.read_traces(spark, captures, roots=("elsewhere",))
    assert raw.source_globs("s3a://b/x/", ("r",), "*/t/*.csv") == ["s3a://b/x/r/*/t/*.csv"]
    assert raw.source_globs("/d", ROOTS, "*.csv") == ["/d/{construct_data,rca_data}/*.csv"]


def test_metrics(spark, captures):
    rows = raw.read_metrics(spark, captures).collect()
    assert [(r.epoch_sec, r.cpu_usage_mcores, r.network_rx_bytes) for r in rows] == [
        (1704067200, 12.5, 5e9)]


def test_lineage(spark, captures):
    got = {(r.capture_date, r.capture_root): r.rows
           for r in raw.file_lineage(spark, captures).collect()}
    assert got == {("2022-08-22", "baseline"): 4, ("2023-05-05", "fault"): 1}


def test_fault_lists(spark, captures):
    found = labels.ground_truth(labels.read_fault_labels(spark, captures))
    got = {(r.capture_date, r.inject_time): (r.inject_timestamp, r.inject_service)
           for r in found.collect()}
    assert got == {("2022-08-22", "10:00"): (1704067200, "cart"),
                   ("2022-08-22", "10:30"): (0, "web"), ("2022-08-23", "12:00"): (5, "solo")}
    assert labels.ground_truth(found.limit(0)).columns[-1] == "inject_service"


def test_manifest(spark, captures):
    files = manifest.file_manifest(spark, captures)
    got = {r.relative_path: (r.root, r.capture_date, r.kind) for r in files.collect()}
    assert "construct_data/2022-08-22/metric/front_service.csv" not in got
    assert got["construct_data/2022-08-22/metric/cart_metric.csv"] == (
        "construct_data", "2022-08-22", "metric")
    assert len(got) == 6
    only = manifest.file_manifest(spark, captures, kinds=("trace",), roots=("rca_data",))
    assert [r.relative_path for r in only.collect()] == ["rca_data/2023-05-05/trace/b.csv"]
    assert manifest.dataset_is_present(spark, captures)
    assert not manifest.dataset_is_present(spark, captures, "elsewhere")
    totals = {(r.root, r.kind): r.files for r in manifest.manifest_totals(files).collect()}
    assert totals["construct_data", "log"] == 3


def test_validation(spark, captures):
    got = {r.relative_path.split("/", 1)[1]: r
           for r in manifest.validate_columns(spark, captures).collect()}
    good = got["2022-08-22/trace/a.csv"]
    assert (good.valid, good.row_count, good.missing_columns, good.error) == (True, 4, [], None)
    assert good.sample_row.startswith("t1,s1,")
    assert got["2022-08-22/metric/cart_metric.csv"].extra_columns == [
        "NetworkReceiveBytes", "NetworkTransmitBytes"]
    bom = got["2022-08-22/log/bom.csv"]
    assert (bom.valid, bom.extra_columns, bom.row_count) == (True, ["More"], 1)
    empty = got["2022-08-22/log/empty.csv"]
    assert (empty.valid, empty.row_count, empty.error) == (False, 0, "Empty file (no header row)")
    short = got["2023-01-29/log/short.csv"]
    assert (short.valid, short.row_count, len(short.missing_columns)) == (False, 2, 6)


def test_dataset_gate(spark, captures):
    report = manifest.validate_dataset(spark, captures)
    assert {r.kind: (r.files, r.rows, r.problems) for r in report.collect()} == {
        "trace": (1, 4, 0), "metric": (1, 5, 0)}
    assert manifest.require_valid(report, min_rows=9) == 9
    with pytest.raises(ValueError, match="below"):
        manifest.require_valid(report)
    with pytest.raises(ValueError, match="problem"):
        manifest.require_valid(manifest.validate_dataset(spark, captures, ("log",)), 0)
    absent = manifest.validate_dataset(spark, captures, ("nothing",)).first()
    assert (absent.files, absent.problems) == (0, 1)


def test_row_counts(spark, captures):
    got = {r.root_kind: r.rows for r in manifest.row_counts(spark, captures).collect()}
    assert got == {"construct_data/trace": 4, "construct_data/metric": 5, "construct_data/log": 3,
                   "rca_data/trace": 1}


def test_listing_matches_sparks_own_index(spark, captures, tmp_path):
    odd = tmp_path / "rca_data" / "2023-05-05" / "trace" / "a b+c%.csv"
    odd.write_text(TRACE + "\r\n")
    args = (spark, captures, manifest.KINDS, ROOTS, manifest.METRIC_SUFFIX)
    columns = ["relative_path", "root", "capture_date", "kind", "size_bytes", "header", "first_row"]
    mine = sorted(map(tuple, manifest._listed(*args).select(columns).collect()))
    bom = "\ufeff"
    theirs = sorted(
        (*r[:5], r[5] and r[5].removeprefix(bom), r[6])
        for r in manifest._indexed(*args).select(columns).collect()
    )
    assert mine == theirs and any("a b+c%" in r[0] for r in mine)


def test_first_lines():
    def lines(data):
        return listing.first_lines(io.BytesIO(data))

    assert lines(b"") == [] and lines(b"\n") == [""] and lines(b"a") == ["a"]
    assert lines(b"a\r\nb\rc") == ["a", "b"] and lines(b"\xef\xbb\xbfa\n") == ["a"]
    long = b"x" * (listing.HEAD - 1)
    assert lines(long + b"\r\nsecond\n") == [long.decode(), "second"]
    assert lines(b"x" * (3 * listing.HEAD))[0] == "x" * (3 * listing.HEAD)


def test_many_small_files_are_listed_in_tasks(spark, tmp_path):
    for date in range(5):
        folder = tmp_path / "construct_data" / f"2022-08-{date + 10}" / "trace"
        folder.mkdir(parents=True)
        for i in range(10_000):
            (folder / f"{i}.csv").write_text("" if i % 1000 == 0 else "a,b\n1,2\n" if i % 2 else "a,b")
    files = manifest.file_manifest(spark, str(tmp_path))
    plan = files._jdf.queryExecution().toString()
    assert "BatchScan capture_listing" in plan and "LocalRelation" not in plan
    assert files.rdd.getNumPartitions() == 5
    got = files.groupBy("capture_date").agg(
        F.count("*").alias("n"), F.count_if(F.col("size_bytes") == 0).alias("empty")
    ).collect()
    assert {(r.n, r.empty) for r in got} == {(10_000, 10)} and len(got) == 5
    checked = manifest.validate_columns(spark, str(tmp_path), expected={"trace": ["a", "b"]})
    sums = checked.agg(F.count("*"), F.sum("row_count"), F.count_if(F.col("valid")), F.count("sample_row")).first()
    assert tuple(sums) == (50_000, 25_000, 49_950, 25_000)


def test_columns_in_another_order(spark, captures, tmp_path):
    folder = tmp_path / "rca_data" / "2023-05-05" / "trace"
    names = TRACE.split(",")
    values = dict(zip(names, ["t3", "s9", "s1", "web-abc-x1", '"get, all"', "7", "8", "2500"])) | {"Extra": "more"}
    turned = [*names[::-1], "Extra"]
    lines = [",".join(f'"{c}"' for c in turned), ",".join(values[c] for c in turned)]
    (folder / "turned.csv").write_text("\n".join(lines) + "\n")
    (folder / "empty.csv").write_text("")
    got = {r.span_id: r for r in raw.read_traces(spark, captures).collect()}
    assert set(got) == {"s1", "s5", "s9"} and got["s1"].duration_ms == 1.5
    s9 = got["s9"]
    assert (s9.trace_id, s9.parent_span_id, s9.service_name, s9.endpoint, s9.start_ns, s9.end_ns, s9.duration_ms) == (
        "t3", "s1", "web", "get, all", 7, 8, 2.5)
    (folder / "lacking.csv").write_text("TraceID,SpanID\na,b\n")
    with pytest.raises(ValueError, match="lacking.csv"):
        raw.read_traces(spark, captures)


def test_header_is_found_in_a_split_file(spark, tmp_path):
    folder = tmp_path / "construct_data" / "2022-08-22" / "trace"
    folder.mkdir(parents=True)
    (folder / "big.csv").write_text(TRACE + "\n" + "t,s,p,pod-a-b,op,1,2,3\n" * 5000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        row = manifest.validate_columns(spark, str(tmp_path)).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row.valid, row.row_count, row.sample_row) == (True, 5000, "t,s,p,pod-a-b,op,1,2,3")


def test_canonical_round_trip(spark, captures, tmp_path):
    out = str(tmp_path / "out")
    counts = normalise.run_normalise(
        spark, captures, out, tables.TableStore(spark, str(tmp_path / "store")))
    assert counts == {"trace_service_name": 2, "trace_response_times": 2,
                      "trace_request_times": 2, "resource_usage": 1, "status_codes": 2}
    back = canonical.read_canonical(spark, out)
    s1 = back["trace_request_times"].filter("span_id = 's1'").first()
    assert s1.start_time == "2024-01-01 00:00:00.123"
    assert back["resource_usage"].first().network_rx_bytes == 5_000_000_000
    assert spark.read.parquet(str(tmp_path / "store" / "fault_injections")).count() == 3


def test_malformed_number_reads_as_null(spark, tmp_path):
    for name in canonical.CANONICAL:
        folder = tmp_path / f"{name}.csv"
        folder.mkdir()
        (folder / "part.csv").write_text("span_id,status_code,error_message,is_error\na,oops,,1\n")
    row = canonical.read_canonical(spark, str(tmp_path))["status_codes"].first()
    assert tuple(row) == ("a", None, None, 1)


def test_store(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.write(spark.range(5), "five")
    store.write(spark.range(3), "five")
    assert store.read("five").count() == 3
    assert store.read("nothing") is None and store.read("no good") is None
    with pytest.raises(ValueError):
        store.write(spark.range(1), "drop table x")
    counts = {r.table_name: r.row_count
              for r in tables.table_inventory(store, ["five", "nothing", "a b"]).collect()}
    assert counts == {"five": 3, "nothing": 0, "a b": 0}
    total = tables.inventory_total(tables.table_inventory(store, ["five", "nothing"])).first()
    assert tuple(total) == (2, 3)


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.write(spark.range(5), "five")
    fails = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        store.write(fails, "five")
    assert store.read("five").count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["five"]


def test_a_table_may_be_rewritten_from_itself(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.write(spark.range(5), "numbers")
    store.write(store.read("numbers").filter("id > 1").union(spark.range(100, 102)), "numbers")
    assert sorted(r.id for r in store.read("numbers").collect()) == [2, 3, 4, 100, 101]
    assert [p.name for p in tmp_path.iterdir()] == ["numbers"]


def test_a_switch_cut_short_is_finished_by_the_reader(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.write(spark.range(5), "five")
    (tmp_path / "five").rename(tmp_path / "_old-five-0")
    assert store.read("five").count() == 5 and store.read("six") is None


def test_only_the_dates_at_hand_are_replaced(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))

    def day(date, *values):
        return spark.createDataFrame([(v, date) for v in values], "v int, capture_date string")

    def stored():
        return sorted((r.capture_date, r.v) for r in store.read("days").collect())

    store.write(day("d1", 1, 2).union(day("d2", 3)), "days", parts=["capture_date"])
    store.write(day("d2", 4, 5), "days", parts=["capture_date"])
    assert stored() == [("d1", 1), ("d1", 2), ("d2", 4), ("d2", 5)]
    bad = day("d1", 9).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        store.write(bad, "days", parts=["capture_date"])
    assert stored() == [("d1", 1), ("d1", 2), ("d2", 4), ("d2", 5)]
    again = store.read("days").filter("capture_date = 'd1'").select(F.expr("v + 10").alias("v"), "capture_date")
    store.write(again, "days", parts=["capture_date"])
    assert stored() == [("d1", 11), ("d1", 12), ("d2", 4), ("d2", 5)]


@pytest.mark.parametrize("low, high, parts", [(0, 99, 7), (-5, 5, 4), (3, 3, 8), (0, 2, 16), (0, 10**18, 32)])
def test_ranges_part_a_database_table(spark, low, high, parts):
    values = [None, low - 10, low, low + 1, (low + high) // 2, high - 1, high, high + 10]
    rows = spark.createDataFrame([(v,) for v in values], "key long")
    conditions = tables.ranges("key", low, high, parts)
    assert 1 <= len(conditions) <= parts
    hits = rows.select(*[F.coalesce(F.expr(c).cast("int"), F.lit(0)).alias(f"p{i}") for i, c in enumerate(conditions)])
    assert all(sum(r) == 1 for r in hits.collect())
    with pytest.raises(ValueError):
        tables.ranges("key; drop", 0, 1, 2)


def test_broken_table_is_an_error_not_an_absence(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.write(spark.range(3), "good")
    store.write(spark.range(3).limit(0), "empty")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not a table")
    assert store.read("missing") is None and store.read("empty").count() == 0
    with pytest.raises(Exception, match="(?i)parquet"):
        store.read("bad").count()
    assert store.read_optional("bad") is None


def test_unreachable_database(spark):
    store = tables.JdbcStore(spark, "jdbc:nosuchdriver://nowhere/x", {"user": "u"})
    assert store.read_optional("fault_injections") is None
    with pytest.raises(Exception, match="(?i)driver"):
        store.read("fault_injections")
    assert store.properties == {"batchsize": "10000", "user": "u"}


def test_sample_is_stable_and_about_a_tenth(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("span_id"))
    first = {r[0] for r in tables.sample_rows(df.repartition(3), "span_id").collect()}
    again = {r[0] for r in tables.sample_rows(df.repartition(11), "span_id").collect()}
    assert first == again and 1800 < len(first) < 2200


def test_stage_status(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path))
    store.write(spark.range(2), "anomaly_scores")
    store.write(spark.range(0), "cross_service_pairs")
    got = {r.output_table: (r.status, r.rows, r.stages_complete) for r in tables.stage_status(
        tables.table_inventory(store, ["anomaly_scores", "cross_service_pairs"])).collect()}
    assert got["anomaly_scores"] == ("complete", 2, 1)
    assert got["cross_service_pairs"] == ("not run", 0, 1)
    assert len(got) == 5


LINES = [
    "2024-01-01 00:00:00.000 [INFO    ] started",
    "2024-01-01 00:00:01.000 [DEBUG   ] detail",
    "2024-01-01 00:00:02.000 [WARN    ] Disk low",
    "Traceback: disk",
    "2024-01-01 00:00:03.000 [CRIT    ] disk gone",
]


def parsed(spark, tmp_path, **kw):
    (tmp_path / "a.log").write_text("\n".join(LINES) + "\n")
    from faultweave.sources.raw import read_log

    rows = parse_log(read_log(spark, str(tmp_path / "a.log")), **kw).orderBy("line_no").collect()
    return [(r.level, r.message) for r in rows]


def test_log_levels(spark, tmp_path):
    assert parsed(spark, tmp_path) == [
        ("INFO", "started"), ("WARNING", "Disk low"), (None, "Traceback: disk"),
        ("CRITICAL", "disk gone")]
    assert parsed(spark, tmp_path, min_level="WARNING") == [
        ("WARNING", "Disk low"), ("CRITICAL", "disk gone")]
    assert len(parsed(spark, tmp_path, min_level="DEBUG")) == 5


def test_log_search_and_tail(spark, tmp_path):
    assert parsed(spark, tmp_path, search="DISK") == [
        ("WARNING", "Disk low"), (None, "Traceback: disk"), ("CRITICAL", "disk gone")]
    assert parsed(spark, tmp_path, tail=2) == [(None, "Traceback: disk"), ("CRITICAL", "disk gone")]


def test_shared_folder_comes_from_the_session(spark):
    assert workspace.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = workspace.materialise(spark.range(4).toDF("n"), "numbers")
    assert kept.count() == 4 and "Range" not in kept._jdf.queryExecution().analyzed().toString()


def test_compressed_canonical_files_give_the_same_rows(spark, tmp_path, monkeypatch):
    from faultweave.schemas import CANONICAL

    monkeypatch.setattr(canonical, "FILE_ROWS", 40)
    rows = [(f"s{i}", 200, "slow, \"x\"" if i % 3 else "a\\b", i % 2) for i in range(100)]
    tables = {name: spark.createDataFrame([], schema) for name, schema in CANONICAL.items()}
    tables["status_codes"] = spark.createDataFrame(rows, CANONICAL["status_codes"]).coalesce(1)
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    assert canonical.write_canonical(tables, plain) == canonical.write_canonical(tables, packed, compression="lz4")
    got, want = (
        sorted(map(tuple, canonical.read_canonical(spark, p)["status_codes"].collect())) for p in (packed, plain)
    )
    assert got == want and len(got) == 100
    files = list((tmp_path / "packed" / "status_codes.csv").glob("part-*"))
    assert len(files) == 3 and all(f.suffix == ".lz4" for f in files)


def test_normalise_reads_its_traces_once(spark, tmp_path):
    row = ("t", "s", None, "svc-rs-p", "svc", "op", 1, 2, 1.0, "2022-08-22", "baseline")
    traces = spark.createDataFrame(
        [row], "trace_id string, span_id string, parent_span_id string, pod_id string, service_name string, "
        "endpoint string, start_ns long, end_ns long, duration_ms double, capture_date string, capture_root string",
    )
    traces.write.parquet(str(tmp_path / "given"))
    metrics = spark.createDataFrame(
        [], "pod_id string, epoch_sec long, cpu_usage_mcores double, memory_usage_mb double, "
        "network_rx_bytes double, network_tx_bytes double",
    )
    tables = normalise.normalise(spark.read.parquet(str(tmp_path / "given")), metrics)
    for name, df in tables.items():
        assert not any("/given/" in file for file in df.inputFiles()), name
    assert tables["trace_service_name"].first()["span_id"] == "s"
