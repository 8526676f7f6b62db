"""The supplied tables read as telemetry.

Durations, cpu and memory are multiples of 1/64 so that their sums are exact in any
order, and two engines agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.config import BASELINE_ROOT, FAULT_ROOT
from faultweave.functions import names
from faultweave.operators import cleaning, selftime, spans
from faultweave.sources import labels, workspace

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
DATES = ("2022-08-22", "2022-08-23", "2023-01-29", "2023-01-30", "2023-05-05")
METHODS = ("GET", "POST", "PUT", "DELETE", "PATCH")
FAULTS = ("cpu_contention", "cpu_consumed", "network_delay", "exception", "return")
DEDUP_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]
CALLERS = [f"svc-{k}" for k in range(10)]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _pod(number: Column) -> Column:
    return F.concat(F.lit("svc-"), (number % 10).cast("string"), F.lit("-rs1-p0"))


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *DEDUP_ORDER)


def as_spans(rows: DataFrame) -> DataFrame:
    """Span columns of lineitem rows; the lineitem columns are kept."""
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    ticks = F.floor(F.col("l_extendedprice") * 1.25)
    start = (
        order % 30 * 86400 + order * 37 % 86400 + line * 11 + part % 60 + F.lit(EPOCH)
    ).cast("bigint")
    parent = (order * 10 + F.floor(line / 2)).cast("string")
    return rows.select(
        "*",
        order.cast("string").alias("trace_id"),
        (order * 10 + line).cast("string").alias("span_id"),
        F.when(line > 1, parent).alias("parent_span_id"),
        _pod(F.col("l_suppkey")).alias("pod_id"),
        F.when(part % 2000 == 13, "op-rare")
        .otherwise(F.concat(F.lit("op-"), (part % 7).cast("string")))
        .alias("endpoint"),
        _pick(METHODS, line % 5).alias("http_method"),
        (ticks / 64.0).alias("duration_ms"),
        (start * 1_000_000_000 + part % 1000 * 1_000_000).alias("start_ns"),
        (start * 1_000_000_000 + part % 1000 * 1_000_000 + ticks * 15625).alias("end_ns"),
        F.when(F.col("l_discount") > 0.095, 503)
        .when(F.col("l_discount") > 0.085, 404)
        .otherwise(200)
        .alias("status_code"),
        F.when(order % 2 == 0, "baseline").otherwise("fault").alias("capture_root"),
        _pick(DATES, order % 5).alias("capture_date"),
    ).withColumn("service_name", names.service_from_pod(F.col("pod_id")))


def traces(spark: SparkSession, sf: str) -> DataFrame:
    """What reading the trace files yields; duplicated spans included."""
    return as_spans(lineitem(spark, sf)).select(
        "trace_id", "span_id", "parent_span_id", "pod_id", "service_name", "endpoint",
        "start_ns", "end_ns", "duration_ms", "capture_date", "capture_root",
    )


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Pod samples from events; some with no cpu or a negative one."""
    event, value = F.col("event_id"), F.col("value")
    return table(spark, sf, "events").select(
        _pod(F.col("user_id")).alias("pod_id"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("epoch_sec"),
        F.when(event % 50 == 0, -1.0)
        .when(event % 51 == 0, F.lit(None))
        .otherwise(F.floor(value * 640) / 64.0)
        .alias("cpu_usage_mcores"),
        (event % 97 * 8 + 512).cast("double").alias("memory_usage_mb"),
        (event * 1048576).cast("double").alias("network_rx_bytes"),
        (event * 524288).cast("double").alias("network_tx_bytes"),
    )


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What reading the metric files yields."""
    return samples(spark, sf).filter(F.col("cpu_usage_mcores") >= 0)


def canonical_raw(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The five canonical tables as they might arrive: duplicates, gaps and bad values."""
    rows = as_spans(lineitem(spark, sf))
    part, quantity, line = F.col("l_partkey"), F.col("l_quantity"), F.col("l_linenumber")

    def text(nanos: str) -> Column:
        micros = F.call_function("div", F.col(nanos), F.lit(1000))
        return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss.SSS")

    root = F.when(F.col("l_orderkey") % 2 == 0, F.lit("")).otherwise(F.lit(None))
    missing = F.lit(None).cast("double")
    return {
        "trace_service_name": rows.select(
            "trace_id",
            F.when(part % 101 != 0, F.col("service_name")).alias("service_name"),
            F.when(part % 103 != 0, F.col("span_id")).alias("span_id"),
            F.when(line > 1, F.col("parent_span_id")).otherwise(root).alias("parent_span_id"),
            F.lit("ns").alias("namespace"),
            "pod_id",
            F.lit(None).cast("string").alias("node_id"),
        ),
        "trace_response_times": rows.select(
            "span_id",
            F.when(quantity == 50, -1.0)
            .when(quantity == 48, missing)
            .otherwise(F.col("duration_ms"))
            .alias("response_time_ms"),
            missing.alias("wait_time_ms"),
            F.when(line == 3, missing)
            .when(quantity == 49, -1.0)
            .otherwise(F.col("duration_ms"))
            .alias("processing_time_ms"),
            missing.alias("network_latency_ms"),
        ),
        "trace_request_times": rows.select(
            "span_id",
            F.when(F.col("l_tax") > 0.075, "n/a").otherwise(text("start_ns")).alias("start_time"),
            F.when(F.col("l_tax") < 0.005, "n/a").otherwise(text("end_ns")).alias("end_time"),
            "duration_ms", "http_method", "endpoint",
        ),
        "resource_usage": samples(spark, sf).select(
            "pod_id",
            F.date_format(F.timestamp_seconds("epoch_sec"), "yyyy-MM-dd HH:mm:ss").alias(
                "timestamp"
            ),
            "cpu_usage_mcores", "memory_usage_mb",
            F.col("network_rx_bytes").cast("bigint").alias("network_rx_bytes"),
            F.col("network_tx_bytes").cast("bigint").alias("network_tx_bytes"),
            F.lit(None).cast("bigint").alias("disk_io_read_bytes"),
            F.lit(None).cast("bigint").alias("disk_io_write_bytes"),
        ),
        "status_codes": rows.select(
            "span_id", "status_code",
            F.when(F.col("status_code") == 503, "slow").otherwise("").alias("error_message"),
            F.when(F.col("status_code") == 503, 1).otherwise(0).alias("is_error"),
        ),
    }


def spans_clean(spark: SparkSession, sf: str, keep_roots: bool = False) -> DataFrame:
    """Telemetry of one row per span, before resources are attached."""
    rows = cleaning.dedup(lineitem(spark, sf), ["l_orderkey", "l_linenumber"], DEDUP_ORDER)
    micros = F.call_function("div", F.col("start_ns"), F.lit(1000))
    one = as_spans(rows).select(
        "trace_id", "service_name", "span_id", "parent_span_id", "pod_id", "endpoint",
        "http_method", "status_code",
        F.col("duration_ms").alias("response_time_ms"),
        F.timestamp_micros(micros).alias("start_time_ts"),
    )
    return one if keep_roots else one.filter(F.col("parent_span_id").isNotNull())


def telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Unified telemetry, straight from lineitem and events."""
    usage = metrics(spark, sf).withColumn("ts", F.timestamp_seconds("epoch_sec"))
    return spans.engineer_features(spans.join_resources(spans_clean(spark, sf), usage))


def fault_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Injected faults from supplier."""
    key = F.col("s_suppkey")
    second = (key * 3571 + EPOCH).cast("bigint")
    return table(spark, sf, "supplier").select(
        _pick(DATES, key % 4).alias("capture_date"),
        F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd HH:mm:ss").alias("inject_time"),
        second.alias("inject_timestamp"),
        _pod(key).alias("inject_pod"),
        _pick(FAULTS, F.col("s_nationkey") % 5).alias("inject_type"),
    )


def ground_truth(spark: SparkSession, sf: str) -> DataFrame:
    return labels.ground_truth(fault_labels(spark, sf))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark runs aggregated from lineitem: a size per line number, three repetitions."""
    line = F.col("l_linenumber")
    repetition = (F.col("l_suppkey") % 3 + 1).cast("int")

    def seconds(share: int) -> Column:
        return F.floor(F.sum(F.col("l_quantity") * (line * share)) / 64.0) / 64.0

    grouped = (
        table(spark, sf, "lineitem")
        .groupBy((line * 100000).cast("bigint").alias("data_size"), repetition.alias("repetition"))
        .agg(
            F.count("*").alias("input_rows"),
            seconds(1).alias("groupby_agg_sec"),
            seconds(2).alias("window_fn_sec"),
            seconds(3).alias("join_sec"),
            seconds(4).alias("shuffle_sec"),
        )
    )
    total = sum(
        (F.col(c) for c in ("window_fn_sec", "join_sec", "shuffle_sec")), F.col("groupby_agg_sec")
    )
    return grouped.select(
        F.concat(F.col("data_size").cast("string"), F.lit("_r"), F.col("repetition").cast("string"))
        .alias("label"),
        "input_rows", "data_size", "repetition",
        "groupby_agg_sec", "window_fn_sec", "join_sec", "shuffle_sec",
        total.alias("total_sec"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines from events; one kind of event does not parse as a log line."""
    level = (
        F.when(F.col("event_id") % 11 == 0, "DEBUG")
        .when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "click", "WARN")
        .when(F.col("event_type") == "purchase", "CRIT")
        .otherwise("INFO")
    )
    moment = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS")
    text = F.concat(F.lit("User "), F.col("user_id").cast("string"), F.lit(" "), F.col("props"))
    parsed = F.concat(moment, F.lit(" ["), F.rpad(level, 8, " "), F.lit("] "), text)
    return table(spark, sf, "events").select(
        F.col("event_id").alias("line_no"),
        F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("  at frame "), text))
        .otherwise(parsed)
        .alias("line"),
    )


def fault_documents(spark: SparkSession, sf: str) -> DataFrame:
    """JSON fault lists keyed by hour, for at most a thousand suppliers each."""
    injection = F.struct("inject_time", "inject_timestamp", "inject_pod", "inject_type")
    chunk = F.floor((F.col("inject_timestamp") - EPOCH) / 3571 / 1000)
    hourly = (
        fault_labels(spark, sf)
        .groupBy("capture_date", chunk.alias("chunk"), F.substring("inject_time", 12, 2).alias("h"))
        .agg(F.collect_list(injection).alias("faults"))
    )
    return hourly.groupBy("capture_date", "chunk").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("h", "faults")))).alias("document")
    )


# ---- the same data as source files -----------------------------------------

# Spark names the files it writes itself, so the readers are given these patterns.
METRIC_FILES = "*/metric/*.csv"
METRIC_SUFFIX = ".csv"
FAULT_FILES = "*/part-*.txt"

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, what: str, write) -> str:
    """Write a derived dataset once per application."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _written:
        path = workspace.new_path(spark, what)
        write(path)
        _written[key] = path
    return _written[key]


def telemetry_table(spark: SparkSession, sf: str) -> DataFrame:
    """Unified telemetry as a table: deduplicated and joined once, scanned by every analysis."""
    path = _once(spark, sf, "telemetry", lambda at: telemetry(spark, sf).write.parquet(at))
    return spark.read.parquet(path)


def ceilings_table(spark: SparkSession, sf: str) -> DataFrame:
    """The learned ceilings as a table, a row per endpoint."""

    def write(path: str) -> None:
        timed = selftime.add_self_time(traces(spark, sf))
        baseline = workspace.materialise(selftime.baseline_self_time(timed), "baseline")
        selftime.latency_ceiling(baseline).write.parquet(path)

    return spark.read.parquet(_once(spark, sf, "ceilings", write))


def capture_files(spark: SparkSession, sf: str) -> str:
    """Trace and metric CSV files and fault lists, in the layout captures come in."""

    def write(path: str) -> None:
        trace = as_spans(lineitem(spark, sf)).select(
            F.col("trace_id").alias("TraceID"),
            F.col("span_id").alias("SpanID"),
            F.col("parent_span_id").alias("ParentID"),
            F.col("pod_id").alias("PodName"),
            F.col("endpoint").alias("OperationName"),
            F.col("start_ns").alias("StartTimeUnixNano"),
            F.col("end_ns").alias("EndTimeUnixNano"),
            (F.col("duration_ms") * 1000.0).alias("Duration"),
            "capture_root", "capture_date",
        )
        metric = samples(spark, sf).select(
            F.timestamp_seconds("epoch_sec").cast("string").alias("Time"),
            F.col("epoch_sec").alias("TimeStamp"),
            F.col("pod_id").alias("PodName"),
            F.col("cpu_usage_mcores").alias("CpuUsage(m)"),
            F.lit(0).alias("CpuUsageRate(%)"),
            F.col("memory_usage_mb").alias("MemoryUsage(Mi)"),
            F.lit(0).alias("MemoryUsageRate(%)"),
            F.col("network_rx_bytes").alias("NetworkReceiveBytes"),
            F.col("network_tx_bytes").alias("NetworkTransmitBytes"),
        )
        roots = {"baseline": BASELINE_ROOT, "fault": FAULT_ROOT}
        for kind, root in roots.items():
            for date in DATES:
                part = trace.filter(
                    (F.col("capture_root") == kind) & (F.col("capture_date") == date)
                ).drop("capture_root", "capture_date")
                part.write.option("header", True).csv(f"{path}/{root}/{date}/trace")
        metric.write.option("header", True).csv(f"{path}/{BASELINE_ROOT}/{DATES[0]}/metric")
        for date in DATES[:4]:
            documents = fault_documents(spark, sf).filter(F.col("capture_date") == date)
            documents.select("document").write.mode("append").option(
                "maxRecordsPerFile", 1
            ).text(f"{path}/{FAULT_ROOT}/{date}")

    return _once(spark, sf, "captures", write)
