"""Every query with the columns it is compared on and, where SQL can say it, its check.

Column specs carry a prefix: i whole number, d double (kept to 6 decimals), t timestamp, none
text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultweave.config import DEFAULTS, ROOTS, Settings
from faultweave.functions import features, names
from faultweave.operators import (
    anomalies, callgraph, canonical, cleaning, faults, marts, scaling, selftime, spans, workload,
)
from faultweave.operators.logs import parse_log
from faultweave.plans import normalise, preprocess, reports, scalability
from faultweave.sources import canonical as canonical_files
from faultweave.sources import labels, manifest, raw, tables, workspace
from harness import binding as b
from harness.oracle import pct, with_views

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    columns: str
    check: str | None = None


ENTRIES: dict[str, Entry] = {}


def add(name: str, columns: str, run: Query, check: str | None = None) -> None:
    ENTRIES[name] = Entry(run, columns, check)


# ---- comparable output -----------------------------------------------------


def _spark_column(spec: str) -> Column:
    kind, _, name = spec.rpartition(":")
    column = F.col(name)
    if kind == "i":
        column = column.cast("bigint")
    elif kind == "d":
        # Half up on the double itself: the engines' own round() treat ties differently.
        column = F.floor(column.cast("double") * 1e6 + 0.5) / 1e6
    elif kind == "t":
        column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
    return column.alias(name)


def _duck_column(spec: str) -> str:
    kind, _, name = spec.rpartition(":")
    forms = {
        "i": f"CAST({name} AS BIGINT)",
        "d": f"CAST(floor(CAST({name} AS DOUBLE) * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT) / 1e6::DOUBLE",
        "t": f"strftime({name}, '%Y-%m-%d %H:%M:%S.%g')",
        "": f"CAST({name} AS VARCHAR)",
    }
    return f"{forms[kind]} AS {name}"


def query_of(entry: Entry) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return entry.run(spark, sf).select(*[_spark_column(c) for c in entry.columns.split()])

    return run


def check_of(entry: Entry) -> str:
    columns = ", ".join(_duck_column(c) for c in entry.columns.split())
    return with_views(f"SELECT {columns} FROM ({entry.check}) AS answer")


# ---- shorthands ------------------------------------------------------------


def pairs(s: SparkSession, sf: str) -> DataFrame:
    return callgraph.service_dependency_graph(b.telemetry_table(s, sf))


def chains(s: SparkSession, sf: str) -> DataFrame:
    return callgraph.propagation_chains(b.telemetry_table(s, sf), DEFAULTS.chain_window_sec)


def corr(s: SparkSession, sf: str) -> DataFrame:
    # The supplied data correlates weakly: the usual 0.3 would leave nothing.
    return callgraph.error_correlation(b.telemetry_table(s, sf), min_correlation=0.0)


def series(s: SparkSession, sf: str) -> DataFrame:
    return anomalies.error_rate_timeseries(b.telemetry_table(s, sf), DEFAULTS.bucket_minutes)


def scored(s: SparkSession, sf: str) -> DataFrame:
    return anomalies.score_anomalies(series(s, sf))


def patterns(s: SparkSession, sf: str) -> DataFrame:
    return anomalies.failure_patterns(scored(s, sf))


def runs(s: SparkSession, sf: str) -> DataFrame:
    return scaling.scalability_runs(b.runs(s, sf))


def timed(s: SparkSession, sf: str) -> DataFrame:
    return selftime.add_self_time(b.traces(s, sf))


def judged(s: SparkSession, sf: str) -> DataFrame:
    known = selftime.join_latency_ceiling(timed(s, sf), b.ceilings_table(s, sf))
    return selftime.flag_degraded(known)


def cleaned(s: SparkSession, sf: str) -> dict[str, DataFrame]:
    return cleaning.clean_all(b.canonical_raw(s, sf))


def report(name: str, truth: bool = False) -> Query:
    def run(s: SparkSession, sf: str) -> DataFrame:
        labelled = b.ground_truth(s, sf) if truth else None
        return reports.run_reports(s, b.telemetry_table(s, sf), labelled, only=[name])[name]

    return run


def captures(s: SparkSession, sf: str) -> str:
    return b.capture_files(s, sf)


def store(s: SparkSession) -> tables.TableStore:
    return tables.TableStore(s, workspace.new_path(s, "store"))


# ---- column lists ----------------------------------------------------------

TRACE = (
    "trace_id span_id parent_span_id pod_id service_name endpoint i:start_ns i:end_ns "
    "d:duration_ms capture_date capture_root"
)
METRIC = (
    "pod_id i:epoch_sec d:cpu_usage_mcores d:memory_usage_mb i:network_rx_bytes i:network_tx_bytes"
)
SERVICE = "trace_id service_name span_id parent_span_id namespace pod_id node_id"
RESPONSE = (
    "span_id d:response_time_ms d:wait_time_ms d:processing_time_ms d:network_latency_ms"
)
REQUEST = "span_id start_time end_time d:duration_ms http_method endpoint"
USAGE = (
    "pod_id timestamp d:cpu_usage_mcores d:memory_usage_mb i:network_rx_bytes i:network_tx_bytes "
    "i:disk_io_read_bytes i:disk_io_write_bytes"
)
STATUS = "span_id i:status_code error_message i:is_error"
LABEL = "capture_date inject_time i:inject_timestamp inject_pod inject_type"
UNIFIED = (
    "span_id trace_id service_name parent_span_id namespace pod_id node_id d:response_time_ms "
    "d:wait_time_ms d:processing_time_ms d:network_latency_ms start_time end_time d:duration_ms "
    "http_method endpoint t:start_time_ts t:end_time_ts i:status_code error_message i:is_error "
    "d:cpu_usage_mcores d:memory_usage_mb i:is_failure i:is_latency_spike latency_bucket "
    "error_category i:hour_of_day d:cpu_memory_ratio"
)
PAIRS = (
    "caller_service callee_service i:call_count i:caller_error_count i:callee_error_count "
    "i:co_failure_count d:avg_callee_latency_ms d:propagation_score"
)
CHAINS = (
    "trace_id source_service target_service t:source_timestamp t:target_timestamp "
    "i:propagation_lag_sec i:propagation_depth"
)
CORR = "service_a service_b d:error_correlation i:sample_size"
BUCKET = "service_name t:time_bucket"
SERIES = (
    f"{BUCKET} i:total_requests i:error_count d:avg_latency_ms d:avg_cpu_mcores d:avg_memory_mb "
    "d:error_rate"
)
STATS = (
    "d:mean_error_rate d:std_error_rate d:mean_latency d:std_latency d:mean_cpu d:std_cpu "
    "d:mean_memory d:std_memory"
)
FLAGS = (
    "i:is_anomaly_error i:is_anomaly_latency i:is_anomaly_resource i:is_error_rate_slo_breach "
    "i:is_latency_slo_breach"
)
ZSCORES = "d:zscore_error_rate d:zscore_latency d:zscore_cpu d:zscore_memory"
SCORED = f"{BUCKET} {FLAGS} {ZSCORES} i:anomaly_score i:is_anomaly_overall"
PATTERNS = "service_name pattern_type i:occurrence_count d:avg_severity"
RUNS = (
    "label i:input_rows i:data_size i:repetition d:groupby_agg_sec d:window_fn_sec d:join_sec "
    "d:shuffle_sec d:total_sec d:throughput_rows_per_sec d:speedup_vs_baseline i:baseline_size "
    "d:baseline_time_sec"
)

RANKED_PAIRS = "SELECT * FROM pairs ORDER BY propagation_score DESC, caller_service, callee_service"

# ---- scans -----------------------------------------------------------------


def _csv_schema(s: SparkSession, sf: str) -> DataFrame:
    path = workspace.new_path(s, "canonical")
    canonical_files.write_canonical(b.canonical_raw(s, sf), path, compression="lz4")
    return spans.join_spans(cleaning.clean_all(canonical_files.read_canonical(s, path)))


JOINED = (
    f"{SERVICE} d:response_time_ms d:processing_time_ms start_time end_time d:duration_ms "
    "http_method endpoint i:status_code error_message i:is_error"
)
# An empty field reads back as NULL.
add(
    "src_csv_schema", JOINED, _csv_schema,
    "SELECT * REPLACE (nullif(error_message, '') AS error_message) FROM joined_spans",
)
add("src_traces", TRACE, lambda s, sf: raw.read_traces(s, captures(s, sf)), "SELECT * FROM traces")
add(
    "src_metrics", METRIC,
    lambda s, sf: raw.read_metrics(s, captures(s, sf), pattern=b.METRIC_FILES),
    "SELECT * FROM metrics",
)
add(
    "src_multi_root_paths", "i:rows",
    lambda s, sf: s.read.option("header", True)
    .csv(raw.source_globs(captures(s, sf), ROOTS, raw.TRACE_FILES))
    .agg(F.count("*").alias("rows")),
    "SELECT count(*) AS rows FROM traces",
)
add(
    "src_file_lineage", "capture_date capture_root i:rows",
    lambda s, sf: raw.file_lineage(s, captures(s, sf)),
    "SELECT capture_date, capture_root, count(*) AS rows FROM traces GROUP BY ALL",
)


def _parquet(s: SparkSession, sf: str) -> DataFrame:
    path = canonical_files.write_parquet(b.telemetry_table(s, sf), workspace.new_path(s, "telemetry"))
    return canonical_files.read_parquet(s, path)


SPAN = (
    "trace_id span_id parent_span_id service_name pod_id endpoint http_method "
    "d:response_time_ms t:start_time_ts i:status_code i:is_failure"
)
add("src_parquet", SPAN, _parquet, "SELECT * FROM spans")


def _optional(s: SparkSession, sf: str) -> DataFrame:
    at = store(s)
    at.write(b.ground_truth(s, sf), "fault_injections")
    absent = at.read("never_written") is None
    return at.read("fault_injections").withColumn("missing_is_absent", F.lit(int(absent)))


add(
    "src_jdbc_optional", f"{LABEL} inject_service i:missing_is_absent", _optional,
    "SELECT *, 1 AS missing_is_absent FROM labels_in",
)
add(
    "src_fault_json", LABEL,
    lambda s, sf: labels.read_fault_labels(s, captures(s, sf), pattern=b.FAULT_FILES),
    "SELECT * FROM labels_in",
)
add("ground_truth", f"{LABEL} inject_service", b.ground_truth, "SELECT * FROM labels_in")


add(
    "file_manifest", "i:files i:sized root kind capture_date",
    lambda s, sf: manifest.file_manifest(s, captures(s, sf), metric_suffix=b.METRIC_SUFFIX)
    .groupBy("root", "kind", "capture_date")
    .agg(
        (F.count("*") > 0).cast("int").alias("files"),
        F.min((F.col("size_bytes") > 0).cast("int")).alias("sized"),
    ),
    f"""SELECT DISTINCT CASE WHEN capture_root = 'baseline' THEN '{ROOTS[0]}' ELSE '{ROOTS[1]}' END
          AS root, 'trace' AS kind, capture_date, 1 AS files, 1 AS sized FROM traces
        UNION ALL SELECT '{ROOTS[0]}', 'metric', '2022-08-22', 1, 1""",
)

# ---- sinks and checks ------------------------------------------------------

add("sink_parquet", UNIFIED, lambda s, sf: canonical_files.read_parquet(
    s, canonical_files.write_parquet(
        preprocess.preprocess(b.canonical_raw(s, sf)), workspace.new_path(s, "unified"),
        partition_by=["service_name"])), "SELECT * FROM unified")


def _sink_csv(s: SparkSession, sf: str) -> DataFrame:
    path = workspace.new_path(s, "canonical")
    counts = canonical_files.write_canonical(b.canonical_raw(s, sf), path)
    back = canonical_files.read_canonical(s, path)
    out = None
    for name, df in back.items():
        one = df.agg(F.count("*").alias("rows_read")).select(
            F.lit(name).alias("table_name"), F.lit(counts[name]).alias("rows_written"), "rows_read"
        )
        out = one if out is None else out.unionByName(one)
    return out


_KEPT = ("raw_service trace_service_name", "raw_response trace_response_times",
         "raw_request trace_request_times", "raw_usage resource_usage", "raw_status status_codes")
add(
    "sink_canonical_csv", "table_name i:rows_written i:rows_read", _sink_csv,
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS rows_written, count(*) AS rows_read FROM {v}"
        for v, n in (k.split() for k in _KEPT)
    ),
)


def _sink_table(s: SparkSession, sf: str) -> DataFrame:
    at = store(s)
    at.write(pairs(s, sf), "cross_service_pairs")
    return at.read("cross_service_pairs")


add("sink_table", PAIRS, _sink_table, "SELECT * FROM pairs")


def _sink_sample(s: SparkSession, sf: str) -> DataFrame:
    at = store(s)
    at.write(
        b.telemetry_table(s, sf), "processed_telemetry_sample",
        sample_key="span_id", sample_mod=DEFAULTS.sample_mod,
    )
    return at.read("processed_telemetry_sample")


HASHED = "CAST('0x' || substr(md5(span_id), 1, 8) AS BIGINT)"
add("sink_sample", SPAN, _sink_sample, f"SELECT * FROM spans WHERE {HASHED} % 10 = 0")
add(
    "sink_capped_chains", CHAINS,
    lambda s, sf: callgraph.first_chains(chains(s, sf)), "SELECT * FROM chains",
)


def _validate_columns(s: SparkSession, sf: str) -> DataFrame:
    files = manifest.validate_columns(s, captures(s, sf), metric_suffix=b.METRIC_SUFFIX)
    return files.groupBy("root", "capture_date", "kind").agg(
        F.sum("row_count").alias("rows"),
        F.count_if(~F.col("valid")).alias("invalid"),
        F.max(F.array_join("missing_columns", ",")).alias("missing"),
        F.max(F.array_join("extra_columns", ",")).alias("extra"),
        F.count_if(F.col("sample_row").isNull() & (F.col("row_count") > 0)).alias("unsampled"),
    )


_FOLDERS = f"""
    SELECT CASE WHEN capture_root = 'baseline' THEN '{ROOTS[0]}' ELSE '{ROOTS[1]}' END AS root,
      capture_date, 'trace' AS kind, count(*) AS rows, '' AS extra FROM traces GROUP BY ALL
    UNION ALL SELECT '{ROOTS[0]}', '2022-08-22', 'metric', count(*),
      'NetworkReceiveBytes,NetworkTransmitBytes' FROM samples"""
add(
    "validate_columns", "root capture_date kind i:rows i:invalid missing extra i:unsampled",
    _validate_columns,
    f"SELECT *, 0 AS invalid, '' AS missing, 0 AS unsampled FROM ({_FOLDERS})",
)
add(
    "validate_dataset", "kind i:rows i:problems",
    lambda s, sf: manifest.validate_dataset(
        s, captures(s, sf), ("trace", "metric", "log"), metric_suffix=b.METRIC_SUFFIX
    ),
    f"""SELECT kind, sum(rows) AS rows, 0 AS problems FROM ({_FOLDERS}) WHERE root = '{ROOTS[0]}'
        GROUP BY ALL UNION ALL SELECT 'log', 0, 1""",
)
add(
    "row_counts_by_kind", "root_kind i:rows",
    lambda s, sf: manifest.row_counts(s, captures(s, sf), metric_suffix=b.METRIC_SUFFIX),
    f"SELECT root || '/' || kind AS root_kind, sum(rows) AS rows FROM ({_FOLDERS}) GROUP BY ALL",
)


def _inventory(s: SparkSession, sf: str) -> DataFrame:
    at = store(s)
    at.write(b.telemetry_table(s, sf), "processed_telemetry")
    at.write(pairs(s, sf), "cross_service_pairs")
    return tables.table_inventory(
        at, ["processed_telemetry", "cross_service_pairs", "anomaly_scores", "bad name"]
    )


add(
    "table_inventory", "table_name i:row_count", _inventory,
    """SELECT 'processed_telemetry' AS table_name, count(*) AS row_count FROM spans
       UNION ALL SELECT 'cross_service_pairs', count(*) FROM pairs
       UNION ALL SELECT 'anomaly_scores', 0 UNION ALL SELECT 'bad name', 0""",
)
add(
    "stage_status", "stage output_table status i:rows i:stages_complete",
    lambda s, sf: tables.stage_status(_inventory(s, sf)),
    """SELECT *, 2 AS stages_complete FROM (
       SELECT '1 - Ingestion' AS stage, 'raw_telemetry' AS output_table, 'not run' AS status,
         0 AS rows
       UNION ALL SELECT '2 - Preprocessing', 'processed_telemetry', 'complete', count(*) FROM spans
       UNION ALL SELECT '3 - Cross-service (RQ1)', 'cross_service_pairs', 'complete', count(*)
         FROM pairs
       UNION ALL SELECT '4 - Failure detection (RQ2)', 'anomaly_scores', 'not run', 0
       UNION ALL SELECT '5 - Scalability (RQ3)', 'scalability_metrics', 'not run', 0)""",
)

# ---- cleaning, projections, features ---------------------------------------

_CLEAN = {
    "trace_service": ("trace_service_name", cleaning.clean_trace_service, SERVICE, "service"),
    "response_times": ("trace_response_times", cleaning.clean_response_times, RESPONSE, "response"),
    "request_times": (
        "trace_request_times", cleaning.clean_request_times,
        f"{REQUEST} t:start_time_ts t:end_time_ts", "request",
    ),
    "resource_usage": (
        "resource_usage", cleaning.clean_resource_usage, f"{USAGE} t:ts", "usage",
    ),
    "status_codes": ("status_codes", cleaning.clean_status_codes, STATUS, "status"),
}
for _name, (_table, _clean, _columns, _view) in _CLEAN.items():
    add(
        f"clean_{_name}", _columns,
        lambda s, sf, t=_table, f=_clean: f(b.canonical_raw(s, sf)[t]),
        f"SELECT * FROM clean_{_view}",
    )

add(
    "service_from_pod", "pod_id service_name i:spans",
    lambda s, sf: b.traces(s, sf)
    .groupBy("pod_id", names.service_from_pod(F.col("pod_id")).alias("service_name"))
    .agg(F.count("*").alias("spans")),
    "SELECT pod_id, service_name, count(*) AS spans FROM traces GROUP BY ALL",
)

_CANONICAL = {
    "trace_service": (canonical.canonical_trace_service, SERVICE, "service"),
    "response_times": (canonical.canonical_response_times, RESPONSE, "response"),
    "request_times": (canonical.canonical_request_times, REQUEST, "request"),
    "status_codes": (canonical.canonical_status_codes, STATUS, "status"),
}
for _name, (_project, _columns, _view) in _CANONICAL.items():
    add(
        f"canonical_{_name}", _columns,
        lambda s, sf, f=_project: f(judged(s, sf)),
        f"SELECT * FROM can_{_view}",
    )
add(
    "canonical_resource_usage", USAGE,
    lambda s, sf: canonical.canonical_resource_usage(b.metrics(s, sf)),
    "SELECT * FROM can_usage",
)
add(
    "is_degraded", "span_id d:self_time_ms d:baseline_p99_ms i:is_degraded", judged,
    "SELECT * FROM judged",
)
add("self_time", "span_id d:duration_ms d:self_time_ms", timed, "SELECT * FROM timed")

for _name, _column, _source, _view in (
    ("feat_is_failure", "i:is_failure", b.telemetry, "spans"),
    ("feat_latency_spike", "i:is_latency_spike", b.telemetry, "telemetry"),
    ("feat_latency_bucket", "latency_bucket", b.telemetry, "telemetry"),
    ("feat_error_category", "error_category", b.telemetry, "telemetry"),
    ("feat_hour_of_day", "i:hour_of_day", b.telemetry, "telemetry"),
    ("feat_cpu_memory_ratio", "d:cpu_memory_ratio", b.telemetry, "telemetry"),
):
    add(f"{_name}", f"span_id {_column}", _source, f"SELECT * FROM {_view}")

add(
    "service_filter", "service_name i:requests",
    lambda s, sf: marts.service_filter(b.telemetry_table(s, sf), ("svc-1", "svc-4", "elsewhere"))
    .groupBy("service_name").agg(F.count("*").alias("requests")),
    """SELECT service_name, count(*) AS requests FROM spans
       WHERE service_name IN ('svc-1', 'svc-4', 'elsewhere') GROUP BY ALL""",
)
STATUS_OF = """CASE WHEN error_rate_pct IS NULL THEN 'neutral' WHEN error_rate_pct < 1 THEN 'good'
    WHEN error_rate_pct < 5 THEN 'warning' WHEN error_rate_pct < 15 THEN 'serious'
    ELSE 'critical' END"""
add(
    "error_rate_status", "service_name t:time_bucket d:error_rate_pct status",
    lambda s, sf: series(s, sf)
    .withColumn("error_rate_pct", F.col("error_rate") * 100.0)
    .withColumn("status", features.error_rate_status(F.col("error_rate_pct"))),
    f"""SELECT *, {STATUS_OF} AS status FROM (
          SELECT *, error_rate * 100.0::DOUBLE AS error_rate_pct FROM series)""",
)
LABEL_OF = """CASE pattern_type WHEN 'full_failure' THEN 'Full failure (all three signals)'
    WHEN 'cascading_failure' THEN 'Cascading failure (errors + latency)'
    WHEN 'resource_exhaustion' THEN 'Resource exhaustion (latency + resources)'
    WHEN 'error_resource_link' THEN 'Error/resource link' WHEN 'error_surge' THEN 'Error surge'
    WHEN 'latency_spike' THEN 'Latency spike' WHEN 'resource_pressure' THEN 'Resource pressure'
    ELSE pattern_type END"""
add(
    "pattern_label", "service_name pattern_type label",
    lambda s, sf: marts.label_patterns(patterns(s, sf)),
    f"SELECT *, {LABEL_OF} AS label FROM patterns",
)
_LOUD = """CASE lvl WHEN 'DEBUG' THEN 0 WHEN 'INFO' THEN 1 WHEN 'WARN' THEN 2 WHEN 'ERROR' THEN 3
    ELSE 4 END"""
add(
    "log_parse", "i:line_no ts level message",
    lambda s, sf: parse_log(b.log_lines(s, sf), "INFO", '"K": 6'),
    f"""SELECT line_no, CASE WHEN NOT bare THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS ts,
          CASE WHEN bare THEN NULL WHEN lvl = 'WARN' THEN 'WARNING'
            WHEN lvl = 'CRIT' THEN 'CRITICAL' ELSE lvl END AS level,
          CASE WHEN bare THEN line ELSE body END AS message
        FROM log WHERE contains(lower(line), '"k": 6') AND (bare OR {_LOUD} >= 1)""",
)
add(
    "drop_sparse_columns", "i:columns_kept i:rows",
    lambda s, sf: (lambda kept: kept.agg(F.count("*").alias("rows")).withColumn(
        "columns_kept", F.lit(len(kept.columns))))(
        cleaning.drop_sparse_columns(
            b.canonical_raw(s, sf)["trace_response_times"], DEFAULTS.null_threshold)),
    # wait and network latency are always NULL, processing time is NULL for one line in seven
    """SELECT 1 + (avg(CASE WHEN response_time_ms IS NULL THEN 1.0 ELSE 0 END) <= 0.5)::INT
         + (avg(CASE WHEN processing_time_ms IS NULL THEN 1.0 ELSE 0 END) <= 0.5)::INT
         + (avg(CASE WHEN wait_time_ms IS NULL THEN 1.0 ELSE 0 END) <= 0.5)::INT
         + (avg(CASE WHEN network_latency_ms IS NULL THEN 1.0 ELSE 0 END) <= 0.5)::INT
         AS columns_kept, count(*) AS rows FROM raw_response""",
)

# ---- joins -----------------------------------------------------------------

add(
    "join_spans", JOINED,
    lambda s, sf: spans.join_spans(cleaned(s, sf)), "SELECT * FROM joined_spans",
)
add(
    "join_resources", "span_id pod_id d:cpu_usage_mcores d:memory_usage_mb", b.telemetry,
    "SELECT * FROM telemetry",
)
add(
    "call_edges",
    "caller_service callee_service i:caller_failure i:callee_failure t:caller_start "
    "t:callee_start d:callee_latency",
    lambda s, sf: callgraph.call_edges(b.telemetry_table(s, sf)), "SELECT * FROM edges",
)
add(
    "paired_series", "t:minute_ts service_a service_b d:error_rate_a d:error_rate_b",
    lambda s, sf: callgraph.paired_series(callgraph.service_minute_error_rate(b.telemetry_table(s, sf))),
    "SELECT * FROM paired",
)
add(
    "join_baseline_stats", f"{BUCKET} d:error_rate {STATS}",
    lambda s, sf: anomalies.join_baseline_stats(series(s, sf)), "SELECT * FROM zscores",
)


def _signals(s: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    # Written: three detectors and their baselines read it.
    ts = workspace.materialise(series(s, sf), "series")
    return (
        anomalies.detect_error_rate_anomalies(ts),
        anomalies.detect_latency_anomalies(ts),
        anomalies.detect_resource_anomalies(ts),
    )


add(
    "unify_outer", f"{BUCKET} {FLAGS} {ZSCORES}",
    lambda s, sf: anomalies.unify_outer(*_signals(s, sf)), "SELECT * FROM flags",
)
add(
    "join_latency_ceiling", "span_id endpoint d:self_time_ms d:baseline_p99_ms i:baseline_samples",
    lambda s, sf: selftime.join_latency_ceiling(timed(s, sf), b.ceilings_table(s, sf)),
    "SELECT * FROM judged",
)
add(
    "join_child_time", "span_id parent_span_id d:duration_ms d:child_duration_ms",
    lambda s, sf: selftime.join_child_time(b.traces(s, sf)), "SELECT * FROM timed",
)
EVALUATION = (
    "inject_service inject_type i:injections i:spans_observed i:failures_observed "
    "d:failure_rate_in_window_pct"
)
EVALUATED = f"""
    SELECT inject_service, inject_type, count(DISTINCT inject_timestamp) AS injections,
      sum(n) AS spans_observed, sum(f) AS failures_observed,
      CASE WHEN sum(n) > 0 THEN {pct('sum(f)', 'sum(n)')} END AS failure_rate_in_window_pct
    FROM labels_in g LEFT JOIN (SELECT service_name, CAST(floor(epoch(start_time_ts)) AS BIGINT)
        AS second, count(*) AS n, sum(is_failure) AS f FROM spans GROUP BY ALL) m
      ON m.service_name = g.inject_service
      AND m.second BETWEEN g.inject_timestamp AND g.inject_timestamp + 300
    GROUP BY ALL"""
add(
    "join_fault_window",
    "inject_service inject_type i:inject_timestamp i:span_epoch i:spans i:failures",
    lambda s, sf: faults.join_fault_window(
        b.telemetry_table(s, sf), b.ground_truth(s, sf), DEFAULTS.fault_window_sec
    ),
    """SELECT inject_service, inject_type, inject_timestamp, second AS span_epoch,
         sum(n) AS spans, sum(f) AS failures
       FROM labels_in g LEFT JOIN (SELECT service_name, CAST(floor(epoch(start_time_ts)) AS BIGINT)
           AS second, count(*) AS n, sum(is_failure) AS f FROM spans GROUP BY ALL) m
         ON m.service_name = g.inject_service
         AND m.second BETWEEN g.inject_timestamp AND g.inject_timestamp + 300
       GROUP BY ALL""",
)
add(
    "join_bench", "i:row_count", lambda s, sf: workload.bench_join(b.telemetry_table(s, sf)),
    f"""SELECT count(*) AS row_count FROM spans f JOIN (
          SELECT trace_id, service_name FROM spans WHERE {HASHED} % 100 = 0) t
        ON f.trace_id = t.trace_id AND f.service_name <> t.service_name""",
)

# ---- aggregations ----------------------------------------------------------

add(
    "resource_minute_avg", "pod_id t:metric_minute d:cpu_usage_mcores d:memory_usage_mb",
    lambda s, sf: spans.resource_minute_avg(
        b.metrics(s, sf).withColumn("ts", F.timestamp_seconds("epoch_sec"))
    ),
    "SELECT *, make_timestamp(minute_no * 60000000) AS metric_minute FROM usage",
)
add("service_dependency_graph", PAIRS, pairs, "SELECT * FROM pairs")
add(
    "service_minute_error_rate", "service_name t:minute_ts d:error_rate",
    lambda s, sf: callgraph.service_minute_error_rate(b.telemetry_table(s, sf)), "SELECT * FROM minute_rate",
)
add("error_correlation", CORR, corr, "SELECT * FROM correlations")
add("error_rate_timeseries", SERIES, series, "SELECT * FROM series")
add(
    "baseline_stats", f"service_name {STATS}",
    lambda s, sf: anomalies.baseline_stats(series(s, sf)), "SELECT * FROM stats",
)
add(
    "error_rate_anomalies",
    f"{BUCKET} d:zscore_error_rate i:is_error_rate_slo_breach i:is_anomaly_error",
    lambda s, sf: anomalies.detect_error_rate_anomalies(series(s, sf)), "SELECT * FROM flags",
)
add(
    "latency_anomalies", f"{BUCKET} d:zscore_latency i:is_latency_slo_breach i:is_anomaly_latency",
    lambda s, sf: anomalies.detect_latency_anomalies(series(s, sf)), "SELECT * FROM flags",
)
add(
    "resource_anomalies", f"{BUCKET} d:zscore_cpu d:zscore_memory i:is_anomaly_resource",
    lambda s, sf: anomalies.detect_resource_anomalies(series(s, sf)), "SELECT * FROM flags",
)
add("anomaly_unified", SCORED, scored, "SELECT * FROM scored")
add(
    "anomaly_unified_from_signals", SCORED,
    lambda s, sf: anomalies.unify_anomalies(*_signals(s, sf)), "SELECT * FROM scored",
)
add(
    "child_time", "parent_span_id d:child_duration_ms",
    lambda s, sf: selftime.child_time(b.traces(s, sf)), "SELECT * FROM child",
)
add(
    "latency_ceiling", "endpoint d:baseline_p99_ms i:baseline_samples",
    lambda s, sf: selftime.latency_ceiling(
        workspace.materialise(selftime.baseline_self_time(timed(s, sf)), "baseline")
    ),
    "SELECT * FROM ceiling",
)
add("failure_patterns", PATTERNS, patterns, "SELECT * FROM patterns")
add(
    "rq2_summary", "section item d:value",
    lambda s, sf: anomalies.rq2_summary(scored(s, sf), patterns(s, sf)),
    """SELECT 'summary' AS section, 'total_time_buckets_analyzed' AS item, count(*)::DOUBLE AS value
         FROM scored
       UNION ALL SELECT 'summary', 'total_anomalies_detected', sum(is_anomaly_overall)::DOUBLE
         FROM scored
       UNION ALL SELECT 'summary', 'anomaly_rate_pct',
         round(100.0::DOUBLE * sum(is_anomaly_overall) / count(*), 2) FROM scored
       UNION ALL (SELECT 'top_anomalous_services', service_name, anomaly_count::DOUBLE
         FROM anomalous ORDER BY anomaly_count DESC, service_name LIMIT 5)
       UNION ALL SELECT 'pattern_distribution', pattern_type, occurrences::DOUBLE
         FROM pattern_sums""",
)
add(
    "propagation_metrics",
    "caller callee d:score i:call_count i:total_propagation_chains d:avg_propagation_lag_sec",
    lambda s, sf: callgraph.propagation_metrics(pairs(s, sf), chains(s, sf)),
    f"""SELECT caller_service AS caller, callee_service AS callee,
          round(propagation_score, 4) AS score, call_count,
          (SELECT count(*) FROM chains) AS total_propagation_chains,
          (SELECT coalesce(round(avg(propagation_lag_sec), 2), 0) FROM chains)
            AS avg_propagation_lag_sec
        FROM ({RANKED_PAIRS} LIMIT 10)""",
)

PROFILE = (
    "service_name i:span_count d:mean_latency_ms d:p50_latency_ms d:p95_latency_ms "
    "d:p99_latency_ms d:max_latency_ms i:failed_spans d:failure_rate_pct"
)


def _cut(p: float) -> str:
    return f"round(min(v) FILTER (rn >= ceil({p}::DOUBLE * n)), 3)"


add(
    "service_latency_profile", PROFILE, report("service_latency_profile"),
    f"""SELECT service_name, count(*) AS span_count, round(avg(v), 3) AS mean_latency_ms,
          {_cut(0.5)} AS p50_latency_ms, {_cut(0.95)} AS p95_latency_ms,
          {_cut(0.99)} AS p99_latency_ms, round(max(v), 3) AS max_latency_ms,
          sum(is_failure) AS failed_spans, {pct('sum(is_failure)', 'count(*)')} AS failure_rate_pct
        FROM (SELECT service_name, is_failure, response_time_ms AS v,
            row_number() OVER (PARTITION BY service_name ORDER BY response_time_ms) AS rn,
            count(*) OVER (PARTITION BY service_name) AS n FROM spans)
        GROUP BY service_name""",
)
add(
    "endpoint_hotspots",
    "service_name endpoint i:calls d:mean_latency_ms d:p95_latency_ms i:failed_calls "
    "d:failure_rate_pct",
    report("endpoint_hotspots"),
    f"""SELECT service_name, endpoint, count(*) AS calls, round(avg(v), 3) AS mean_latency_ms,
          {_cut(0.95)} AS p95_latency_ms, sum(is_failure) AS failed_calls,
          {pct('sum(is_failure)', 'count(*)')} AS failure_rate_pct
        FROM (SELECT service_name, endpoint, is_failure, response_time_ms AS v,
            row_number() OVER (PARTITION BY service_name, endpoint ORDER BY response_time_ms) AS rn,
            count(*) OVER (PARTITION BY service_name, endpoint) AS n FROM spans)
        GROUP BY service_name, endpoint HAVING count(*) >= 100
        ORDER BY p95_latency_ms DESC, service_name, endpoint LIMIT 50""",
)
add(
    "trace_depth_distribution", "span_count_bucket i:trace_count i:failed_spans",
    report("trace_depth_distribution"),
    """SELECT CASE WHEN n = 1 THEN '1 span' WHEN n <= 5 THEN '2-5 spans' WHEN n <= 10
          THEN '6-10 spans' WHEN n <= 20 THEN '11-20 spans' ELSE '21+ spans' END
          AS span_count_bucket, count(*) AS trace_count, sum(f) AS failed_spans
       FROM (SELECT trace_id, count(*) AS n, sum(is_failure) AS f FROM spans GROUP BY ALL)
       GROUP BY ALL""",
)
add(
    "ground_truth_evaluation", EVALUATION, report("ground_truth_evaluation", True), EVALUATED,
)
add(
    "bench_groupby", "service_name i:total i:errors d:avg_latency d:std_latency",
    lambda s, sf: workload.bench_groupby(b.telemetry_table(s, sf)),
    """SELECT service_name, count(*) AS total, sum(is_failure) AS errors,
         avg(response_time_ms) AS avg_latency, stddev_samp(response_time_ms) AS std_latency
       FROM spans GROUP BY ALL""",
)
add(
    "scalability_metrics",
    "i:data_size i:repetitions d:avg_total_time_sec d:avg_throughput_rows_per_sec d:data_ratio "
    "d:speedup d:scalability_efficiency scaling_characteristic",
    lambda s, sf: scaling.scalability_metrics(runs(s, sf)),
    """SELECT *, CASE WHEN scalability_efficiency < 0.8 THEN 'sub-linear'
         WHEN scalability_efficiency < 1.1 THEN 'near-linear' ELSE 'super-linear' END
         AS scaling_characteristic
       FROM (SELECT data_size, repetitions, round(total_sec, 3) AS avg_total_time_sec,
           round(throughput, 1) AS avg_throughput_rows_per_sec,
           round(data_size / s0, 2) AS data_ratio, round(t0 / total_sec, 3) AS speedup,
           round((t0 / total_sec) / (data_size / s0), 3) AS scalability_efficiency
         FROM by_size, smallest)""",
)
add("scalability_runs", RUNS, runs, "SELECT * FROM runs")

# ---- windows, top-k, sorts -------------------------------------------------

add("propagation_chains", CHAINS, chains, "SELECT * FROM chains")
add(
    "service_failure_ranking",
    "service_name i:span_count i:failed_spans d:failure_rate_pct i:failure_rank i:failure_quartile",
    report("service_failure_ranking"),
    f"""SELECT *, rank() OVER (ORDER BY failure_rate_pct DESC) AS failure_rank,
          ntile(4) OVER (ORDER BY failure_rate_pct DESC, service_name) AS failure_quartile
        FROM (SELECT service_name, count(*) AS span_count, sum(is_failure) AS failed_spans,
            {pct('sum(is_failure)', 'count(*)')} AS failure_rate_pct
          FROM spans GROUP BY ALL HAVING count(*) >= 50)""",
)
add(
    "hourly_failure_trend",
    "service_name t:bucket_hour i:spans i:failed d:failure_rate_pct "
    "d:previous_hour_failure_rate_pct",
    report("hourly_failure_trend"),
    f"""SELECT *, lag(failure_rate_pct) OVER (PARTITION BY service_name ORDER BY bucket_hour)
          AS previous_hour_failure_rate_pct
        FROM (SELECT service_name, date_trunc('hour', start_time_ts) AS bucket_hour,
            count(*) AS spans, sum(is_failure) AS failed,
            {pct('sum(is_failure)', 'count(*)')} AS failure_rate_pct
          FROM spans GROUP BY service_name, date_trunc('hour', start_time_ts))""",
)
add(
    "bench_window", "i:row_count",
    lambda s, sf: workload.bench_window(b.telemetry_table(s, sf), "start_time_ts"),
    """SELECT count(*) AS row_count FROM (SELECT lead(service_name) OVER (
         PARTITION BY trace_id ORDER BY start_time_ts, span_id) AS following FROM spans)
       WHERE following IS NOT NULL""",
)
add(
    "dedup_by_key", SPAN.replace(" i:is_failure", ""), lambda s, sf: b.spans_clean(s, sf),
    "SELECT * FROM spans",
)
add(
    "tumbling_window", "span_id t:time_bucket",
    lambda s, sf: anomalies.tumbling_window(b.telemetry_table(s, sf), DEFAULTS.bucket_minutes),
    "SELECT span_id, time_bucket(INTERVAL 15 MINUTE, start_time_ts) AS time_bucket FROM spans",
)
add("topk_pairs", PAIRS, lambda s, sf: callgraph.top_pairs(pairs(s, sf)), f"{RANKED_PAIRS} LIMIT 10")
add(
    "topk_services", "service_name i:anomaly_count",
    lambda s, sf: anomalies.top_services(scored(s, sf)),
    "SELECT * FROM anomalous ORDER BY anomaly_count DESC, service_name LIMIT 5",
)


add(
    "sort_abs_corr", f"{CORR} i:position",
    lambda s, sf: callgraph.rank_abs_corr(callgraph.correlate_series(
        callgraph.service_minute_error_rate(b.telemetry_table(s, sf)), 0.0, DEFAULTS.min_samples
    )),
    """SELECT *, row_number() OVER (
         ORDER BY round(abs(error_correlation), 9) DESC, service_a, service_b)
         AS position FROM correlations""",
)
BANDS = "SELECT latency_bucket, count(*) AS requests FROM telemetry GROUP BY ALL"
add(
    "order_latency_bands", "latency_bucket i:requests i:position",
    lambda s, sf: marts.order_latency_bands(
        marts.mart_latency_distribution(b.telemetry_table(s, sf))
    ).withColumn("position", features.band_rank(F.col("latency_bucket"))),
    f"""SELECT *, CASE latency_bucket WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3
          ELSE 4 END AS position FROM ({BANDS})""",
)


def _scalar_suite(s: SparkSession, sf: str) -> DataFrame:
    ts, value, event = F.col("ts").cast("timestamp"), F.col("value"), F.col("event_id")
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return b.table(s, sf, "events").select(
        event.alias("event_id"),
        F.try_to_timestamp(text).alias("parsed"),
        F.try_to_timestamp(F.lit("n/a")).alias("unparsed"),
        F.date_trunc("minute", ts).alias("minute"),
        F.date_trunc("hour", ts).alias("hour_start"),
        F.hour(ts).alias("hour_no"),
        F.unix_timestamp(ts).alias("epoch"),
        text.alias("text"),
        F.timestamp_seconds(event).alias("from_epoch"),
        (ts + F.make_interval(secs=event.cast("decimal(18,6)"))).alias("shifted"),
        F.regexp_extract("props", r"(\d+)", 1).alias("digits"),
        F.regexp_replace("props", r"[^0-9]", "").alias("stripped"),
        F.contains(F.col("props"), F.lit("7")).cast("int").alias("has_seven"),
        F.concat(F.lit("e-"), F.lpad(event.cast("string"), 12, "0")).alias("padded"),
        F.round(value, 1).alias("rounded"),
        F.abs(value - 10).alias("distance"),
        F.sqrt(value).alias("root"),
        F.try_divide(value, event % 3).alias("guarded"),
        F.greatest(value, F.lit(5.0)).alias("at_least"),
        F.least(value, F.lit(5.0)).alias("at_most"),
        F.when(value > 10, "big").otherwise("small").alias("size"),
        F.coalesce(F.nullif(F.col("event_type"), F.lit("click")), F.lit("none")).alias("kind"),
        F.get(F.array(*[F.lit(m) for m in b.METHODS]), (event % 7).cast("int")).alias("method"),
        names.lookup(F.col("event_type"), {"view": "v", "click": "c"}, F.lit("other")).alias("code"),
        F.from_json("props", "k int")["k"].alias("k"),
    )


add(
    "scalar_suite",
    "i:event_id t:parsed t:unparsed t:minute t:hour_start i:hour_no i:epoch text t:from_epoch "
    "t:shifted digits stripped i:has_seven padded d:rounded d:distance d:root d:guarded d:at_least "
    "d:at_most size kind method code i:k",
    _scalar_suite,
    """SELECT event_id, date_trunc('second', ts) AS parsed, CAST(NULL AS TIMESTAMP) AS unparsed,
         date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour_start,
         hour(ts) AS hour_no, floor(epoch(ts)) AS epoch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
         make_timestamp(event_id * 1000000) AS from_epoch,
         ts + to_seconds(event_id) AS shifted,
         regexp_extract(props, '(\\d+)', 1) AS digits,
         regexp_replace(props, '[^0-9]', '', 'g') AS stripped,
         contains(props, '7')::INT AS has_seven,
         'e-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS padded, round(value, 1) AS rounded,
         abs(value - 10) AS distance, sqrt(value) AS root,
         CASE WHEN event_id % 3 <> 0 THEN value / (event_id % 3) END AS guarded,
         greatest(value, 5.0) AS at_least, least(value, 5.0) AS at_most,
         CASE WHEN value > 10 THEN 'big' ELSE 'small' END AS size,
         coalesce(nullif(event_type, 'click'), 'none') AS kind,
         ['GET', 'POST', 'PUT', 'DELETE', 'PATCH'][event_id % 7 + 1] AS method,
         CASE event_type WHEN 'view' THEN 'v' WHEN 'click' THEN 'c' ELSE 'other' END AS code,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
       FROM events""",
)

# ---- SQL reports as a catalogue --------------------------------------------


def _counted(found: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in found.items():
        one = df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("report"), "row_count"
        )
        out = one if out is None else out.unionByName(one)
    return out


def _all_reports(s: SparkSession, sf: str) -> DataFrame:
    """Row count per report."""
    reports.register_views(b.telemetry_table(s, sf), b.ground_truth(s, sf))
    return _counted(reports.run_queries(s, reports.load_queries(), True))


_REPORT_NAMES = (
    "service_latency_profile", "endpoint_hotspots", "trace_depth_distribution",
    "service_failure_ranking", "hourly_failure_trend", "ground_truth_evaluation",
)
_REPORT_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' AS report, count(*) AS row_count FROM ({ENTRIES[n].check})"
    for n in _REPORT_NAMES
)
add("run_queries", "report i:row_count", _all_reports, _REPORT_ROWS)


def _register_views(s: SparkSession, sf: str) -> DataFrame:
    reports.register_views(b.telemetry_table(s, sf), b.ground_truth(s, sf))
    return s.sql(
        """SELECT (SELECT count(*) FROM telemetry) AS spans,
                  (SELECT count(*) FROM ground_truth) AS injections"""
    )


add(
    "register_views", "i:spans i:injections", _register_views,
    "SELECT (SELECT count(*) FROM spans) AS spans, count(*) AS injections FROM labels_in",
)


def _catalog(s: SparkSession, sf: str) -> DataFrame:
    """Rows of each shipped statement, without labels: the evaluation is skipped."""
    reports.register_views(b.telemetry_table(s, sf))
    return _counted(reports.run_queries(s, reports.load_queries(), False))


add(
    "sql_catalog_run", "report i:row_count", _catalog,
    f"SELECT * FROM ({_REPORT_ROWS}) WHERE report <> 'ground_truth_evaluation'",
)

# ---- marts -----------------------------------------------------------------

add(
    "mart_service_names", "service_name", lambda s, sf: marts.mart_service_names(b.telemetry_table(s, sf)),
    "SELECT DISTINCT service_name FROM spans",
)
add(
    "mart_telemetry_summary",
    "i:total_records i:failures d:avg_latency i:services i:traces d:error_rate",
    lambda s, sf: marts.mart_telemetry_summary(b.telemetry_table(s, sf)),
    """SELECT count(*) AS total_records, sum(is_failure) AS failures,
         avg(response_time_ms) AS avg_latency, count(DISTINCT service_name) AS services,
         count(DISTINCT trace_id) AS traces,
         100.0::DOUBLE * sum(is_failure) / count(*) AS error_rate FROM spans""",
)
add(
    "mart_hourly", "i:hour_of_day i:requests i:failures i:successes d:error_rate_pct",
    lambda s, sf: marts.mart_hourly(b.telemetry_table(s, sf)),
    """SELECT hour_of_day, count(*) AS requests, sum(is_failure) AS failures,
         count(*) - sum(is_failure) AS successes,
         100.0::DOUBLE * sum(is_failure) / count(*) AS error_rate_pct
       FROM telemetry GROUP BY ALL""",
)
HEALTH = (
    "service_name i:requests i:failures d:avg_latency_ms d:avg_cpu_mcores d:avg_memory_mb "
    "d:error_rate_pct"
)
add(
    "mart_service_health", HEALTH, lambda s, sf: marts.mart_service_health(b.telemetry_table(s, sf)),
    "SELECT * REPLACE (round(error_rate_pct, 2) AS error_rate_pct) FROM health",
)
add(
    "mart_top_failing_services", "service_name i:failures",
    lambda s, sf: marts.top_failing_services(marts.mart_service_health(b.telemetry_table(s, sf))),
    "SELECT * FROM health ORDER BY failures DESC, service_name LIMIT 12",
)
add(
    "mart_latency_distribution", "latency_bucket i:requests",
    lambda s, sf: marts.mart_latency_distribution(b.telemetry_table(s, sf)), BANDS,
)
add(
    "mart_error_categories", "error_category i:requests",
    lambda s, sf: marts.mart_error_categories(b.telemetry_table(s, sf)),
    "SELECT error_category, count(*) AS requests FROM telemetry GROUP BY ALL",
)
add(
    "mart_pairs", PAIRS, lambda s, sf: marts.mart_pairs(pairs(s, sf)), RANKED_PAIRS,
)
add(
    "mart_top5_pairs", "caller_service callee_service d:propagation_score",
    lambda s, sf: marts.mart_pairs(pairs(s, sf), k=5), f"{RANKED_PAIRS} LIMIT 5",
)
PATHS = """SELECT source_service, target_service, count(*) AS chain_count,
    avg(propagation_lag_sec) AS avg_lag_sec FROM chains GROUP BY ALL
    ORDER BY chain_count DESC, source_service, target_service"""
add(
    "mart_chain_paths", "source_service target_service i:chain_count d:avg_lag_sec",
    lambda s, sf: marts.mart_chain_paths(chains(s, sf)), f"{PATHS} LIMIT 15",
)
add(
    "mart_lag_profile", "source_service i:propagation_lag_sec i:chain_count",
    lambda s, sf: marts.mart_lag_profile(chains(s, sf)),
    """SELECT source_service, propagation_lag_sec, count(*) AS chain_count FROM chains
       GROUP BY ALL""",
)
add(
    "mart_median_lag", "d:median_lag_sec", lambda s, sf: marts.median_lag(chains(s, sf)),
    "SELECT median(propagation_lag_sec) AS median_lag_sec FROM chains",
)
add(
    "mart_correlations", CORR, lambda s, sf: marts.mart_correlations(corr(s, sf)),
    """SELECT * FROM correlations ORDER BY abs(error_correlation) DESC, service_a, service_b
       LIMIT 15""",
)
SIGNAL_SUMS = """sum(is_anomaly_error) AS error_signal, sum(is_anomaly_latency) AS latency_signal,
    sum(is_anomaly_resource) AS resource_signal"""
add(
    "mart_anomaly_summary",
    "i:total_buckets i:overall i:error_signal i:latency_signal i:resource_signal d:anomaly_rate",
    lambda s, sf: marts.mart_anomaly_summary(scored(s, sf)),
    f"""SELECT count(*) AS total_buckets, sum(is_anomaly_overall) AS overall, {SIGNAL_SUMS},
          100.0::DOUBLE * sum(is_anomaly_overall) / count(*) AS anomaly_rate FROM scored""",
)
SLO = (
    "service_name i:error_slo_breaches i:latency_slo_breaches i:overall_anomalies i:buckets"
)
add("mart_slo_breaches", SLO, lambda s, sf: marts.mart_slo_breaches(scored(s, sf)), "SELECT * FROM slo")
add(
    "mart_top_slo_breaches", f"{SLO} i:slo_breaches",
    lambda s, sf: marts.top_slo_breaches(marts.mart_slo_breaches(scored(s, sf))),
    """SELECT *, error_slo_breaches + latency_slo_breaches AS slo_breaches FROM slo
       WHERE error_slo_breaches + latency_slo_breaches > 0
       ORDER BY slo_breaches DESC, service_name LIMIT 12""",
)
add(
    "mart_anomalies_by_service", "service_name i:anomaly_count",
    lambda s, sf: marts.mart_anomalies_by_service(scored(s, sf)),
    "SELECT * FROM anomalous ORDER BY anomaly_count DESC, service_name LIMIT 15",
)
add(
    "mart_anomaly_timeline",
    "t:time_bucket i:error_signal i:latency_signal i:resource_signal i:multi_signal",
    lambda s, sf: marts.mart_anomaly_timeline(scored(s, sf)),
    f"""SELECT time_bucket, {SIGNAL_SUMS}, sum(is_anomaly_overall) AS multi_signal
        FROM scored GROUP BY time_bucket""",
)
add(
    "mart_patterns", "pattern_type i:occurrences d:avg_severity",
    lambda s, sf: marts.mart_patterns(patterns(s, sf)), "SELECT * FROM pattern_sums",
)
add(
    "mart_patterns_detail", PATTERNS, lambda s, sf: marts.mart_patterns_detail(patterns(s, sf)),
    "SELECT * FROM patterns",
)
BY_SIZE = (
    "i:data_size d:total_sec d:std_total_sec d:groupby_agg_sec d:window_fn_sec d:join_sec "
    "d:shuffle_sec d:throughput i:repetitions"
)
add(
    "mart_scaling_by_size", BY_SIZE, lambda s, sf: scaling.mart_scaling_by_size(runs(s, sf)),
    "SELECT * FROM by_size",
)
add(
    "mart_scaling_raw",
    "label i:data_size i:repetition d:groupby_agg_sec d:window_fn_sec d:join_sec d:shuffle_sec "
    "d:total_sec d:throughput_rows_per_sec",
    lambda s, sf: scaling.mart_scaling_raw(runs(s, sf)), "SELECT * FROM runs",
)
add(
    "mart_scaling_efficiency",
    "i:data_size d:total_sec d:size_ratio d:time_ratio d:linear_total_sec d:efficiency "
    "efficiency_status efficiency_note",
    lambda s, sf: scaling.mart_scaling_efficiency(scaling.mart_scaling_by_size(runs(s, sf))),
    """SELECT *, CASE WHEN efficiency >= 0.9 THEN 'good' WHEN efficiency >= 0.7 THEN 'warning'
         WHEN efficiency >= 0.5 THEN 'serious' ELSE 'critical' END AS efficiency_status,
         CASE WHEN efficiency > 1.1 THEN 'super-linear - overhead amortised'
           WHEN efficiency >= 0.9 THEN 'near-linear scaling'
           WHEN efficiency >= 0.7 THEN 'sub-linear, acceptable'
           WHEN efficiency >= 0.5 THEN 'overhead dominating'
           ELSE 'scaling has broken down' END AS efficiency_note
       FROM (SELECT data_size, total_sec, data_size / s0 AS size_ratio,
           total_sec / t0 AS time_ratio, data_size / s0 * t0 AS linear_total_sec,
           (data_size / s0) / (total_sec / t0) AS efficiency FROM by_size, smallest)""",
)
_CELLS = " ".join(f"d:c{i}" for i in range(10))


def _matrix(how: str, k: int | None, positive: bool) -> Query:
    def run(s: SparkSession, sf: str) -> DataFrame:
        source = pairs(s, sf)
        if positive:
            source = source.filter(F.col("propagation_score") > 0)
        wide = marts.mart_propagation_matrix(source, b.CALLERS, how, k)
        return wide.select(
            "callee_service", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(b.CALLERS)]
        )

    return run


def _matrix_sql(agg: str, where: str) -> str:
    cells = ", ".join(
        f"coalesce({agg}(propagation_score) FILTER (caller_service = '{c}'), 0.0) AS c{i}"
        for i, c in enumerate(b.CALLERS)
    )
    return f"SELECT callee_service, {cells} FROM pairs WHERE {where} GROUP BY callee_service"


add(
    "mart_propagation_matrix", f"callee_service {_CELLS}", _matrix("max", None, False),
    _matrix_sql("max", "true"),
)
add(
    "mart_propagation_matrix_mean", f"callee_service {_CELLS}", _matrix("mean", None, True),
    _matrix_sql("avg", "propagation_score > 0"),
)
add(
    "mart_blast_radius", "service_name direction neighbour d:propagation_score i:rank",
    lambda s, sf: marts.mart_blast_radius(pairs(s, sf)),
    """SELECT * FROM (SELECT caller_service AS service_name, 'downstream' AS direction,
         callee_service AS neighbour, propagation_score, row_number() OVER (
           PARTITION BY caller_service ORDER BY propagation_score DESC, callee_service) AS rank
         FROM pairs UNION ALL
       SELECT callee_service, 'upstream', caller_service, propagation_score, row_number() OVER (
           PARTITION BY callee_service ORDER BY propagation_score DESC, caller_service)
         FROM pairs) WHERE rank <= 10""",
)
add(
    "mart_strong_pairs", "i:service_pairs i:strong_pairs i:cascades",
    lambda s, sf: marts.mart_strong_pairs(pairs(s, sf), chains(s, sf)),
    """SELECT count(*) AS service_pairs, count(*) FILTER (propagation_score >= 0.5)
         AS strong_pairs, (SELECT count(*) FROM chains) AS cascades FROM pairs""",
)
add(
    "mart_worst_service", "service_name i:requests d:error_rate_pct status",
    lambda s, sf: marts.mart_worst_service(marts.mart_service_health(b.telemetry_table(s, sf))),
    f"""SELECT *, {STATUS_OF} AS status FROM health ORDER BY error_rate_pct DESC, service_name
        LIMIT 1""",
)
add(
    "mart_top4_timeline", "service_name t:time_bucket i:is_anomaly_overall i:anomaly_score",
    lambda s, sf: marts.mart_top4_timeline(scored(s, sf)),
    """SELECT * FROM scored WHERE service_name IN (SELECT service_name FROM anomalous
         ORDER BY anomaly_count DESC, service_name LIMIT 4)""",
)
add(
    "mart_signal_mix", "signal i:buckets", lambda s, sf: marts.mart_signal_mix(scored(s, sf)),
    """SELECT 'Error rate' AS signal, sum(is_anomaly_error) AS buckets FROM scored
       UNION ALL SELECT 'Latency', sum(is_anomaly_latency) FROM scored
       UNION ALL SELECT 'Resources', sum(is_anomaly_resource) FROM scored""",
)
add(
    "mart_report_efficiency",
    "i:data_size d:avg_time d:throughput d:mean_speedup d:ratio d:speedup d:efficiency "
    "d:mean_efficiency",
    lambda s, sf: scaling.mart_report_efficiency(runs(s, sf)),
    """SELECT *, speedup / ratio AS efficiency, mean_speedup / ratio AS mean_efficiency FROM (
         SELECT data_size, round(total_sec, 2) AS avg_time, round(throughput, 0) AS throughput,
           round(mean_speedup, 3) AS mean_speedup, data_size / s0 AS ratio,
           round(t0, 2) / round(total_sec, 2) AS speedup FROM by_size, smallest)""",
)
add(
    "mart_exec_summary",
    "i:records i:anomalies i:propagation_pairs i:sizes_tested d:error_rate_pct d:anomaly_rate_pct",
    lambda s, sf: marts.mart_exec_summary(b.telemetry_table(s, sf), scored(s, sf), pairs(s, sf), runs(s, sf)),
    """SELECT (SELECT count(*) FROM spans) AS records,
         (SELECT sum(is_anomaly_overall) FROM scored) AS anomalies,
         (SELECT count(*) FROM pairs WHERE propagation_score > 0) AS propagation_pairs,
         (SELECT count(DISTINCT data_size) FROM runs) AS sizes_tested,
         (SELECT round(100.0::DOUBLE * sum(is_failure) / count(*), 2) FROM spans)
           AS error_rate_pct,
         (SELECT round(100.0::DOUBLE * sum(is_anomaly_overall) / count(*), 2) FROM scored)
           AS anomaly_rate_pct""",
)
add(
    "mart_report_pairs", "caller_service callee_service d:score i:call_count i:co_failure_count",
    lambda s, sf: marts.mart_report_pairs(pairs(s, sf)),
    """SELECT caller_service, callee_service, round(propagation_score, 4) AS score, call_count,
         co_failure_count FROM pairs WHERE propagation_score > 0
       ORDER BY propagation_score DESC, caller_service, callee_service LIMIT 10""",
)
add(
    "mart_report_ops",
    "i:data_size d:groupby_agg_sec d:window_fn_sec d:join_sec d:shuffle_sec d:speedup_at_max_size",
    lambda s, sf: scaling.mart_report_ops(runs(s, sf)),
    """SELECT data_size, round(groupby_agg_sec, 2) AS groupby_agg_sec,
         round(window_fn_sec, 2) AS window_fn_sec, round(join_sec, 2) AS join_sec,
         round(shuffle_sec, 2) AS shuffle_sec,
         (SELECT round(mean_speedup, 3) FROM by_size ORDER BY data_size DESC LIMIT 1)
           AS speedup_at_max_size
       FROM by_size""",
)
add(
    "mart_normal_vs_anomalous", "i:normal i:anomalous d:anomaly_rate_pct",
    lambda s, sf: marts.mart_normal_vs_anomalous(scored(s, sf)),
    """SELECT count(*) - sum(is_anomaly_overall) AS normal, sum(is_anomaly_overall) AS anomalous,
         100.0::DOUBLE * sum(is_anomaly_overall) / count(*) AS anomaly_rate_pct FROM scored""",
)

# ---- scaling experiment ----------------------------------------------------



def _bench_run(s: SparkSession, sf: str) -> DataFrame:
    """The measured run with its times reduced to whether they were taken."""
    run = scalability.bench_run(b.telemetry_table(s, sf), "telemetry", "start_time_ts")
    times = ["groupby_agg_sec", "window_fn_sec", "join_sec", "shuffle_sec", "total_sec"]
    return run.select("label", "input_rows", "data_size", "repetition", F.least(*times).alias("least")).select(
        "label", "input_rows", "data_size", "repetition", (F.col("least") > 0).cast("int").alias("timed")
    )


add(
    "bench_run", "label i:input_rows i:data_size i:repetition i:timed", _bench_run,
    """SELECT 'telemetry' AS label, count(*) AS input_rows, count(*) AS data_size,
         1 AS repetition, 1 AS timed FROM spans""",
)
add(
    "bench_shuffle", "i:row_count", lambda s, sf: workload.bench_shuffle(b.telemetry_table(s, sf), 16),
    "SELECT count(*) AS row_count FROM spans",
)

# ---- pipelines -------------------------------------------------------------


def _normalised(s: SparkSession, sf: str) -> dict[str, DataFrame]:
    path = captures(s, sf)
    return normalise.normalise(
        raw.read_traces(s, path), raw.read_metrics(s, path, pattern=b.METRIC_FILES)
    )


add(
    "normalise", JOINED,
    lambda s, sf: spans.join_spans(cleaning.clean_all(_normalised(s, sf))),
    """SELECT * FROM norm_service JOIN norm_response USING (span_id)
       JOIN norm_request USING (span_id) JOIN norm_status USING (span_id)""",
)
add(
    "preprocess", UNIFIED, lambda s, sf: preprocess.preprocess(b.canonical_raw(s, sf)),
    "SELECT * FROM unified",
)


def _cross_service(s: SparkSession, sf: str) -> DataFrame:
    from faultweave.plans.cross_service import run_cross_service

    return run_cross_service(
        b.telemetry_table(s, sf), store(s),
        workspace.new_path(s, "chains"), Settings(min_correlation=0.0),
    )


add(
    "cross_service",
    "caller callee d:score i:call_count i:total_propagation_chains d:avg_propagation_lag_sec",
    _cross_service, ENTRIES["propagation_metrics"].check,
)


def _failure_detection(s: SparkSession, sf: str) -> DataFrame:
    from faultweave.plans.failure_detection import run_failure_detection

    return run_failure_detection(b.telemetry_table(s, sf), store(s), workspace.new_path(s, "anomalies"))


add("failure_detection", "section item d:value", _failure_detection, ENTRIES["rq2_summary"].check)


def _sql_reports(s: SparkSession, sf: str) -> DataFrame:
    at = store(s)
    at.write(b.ground_truth(s, sf), "fault_injections")
    counts = reports.run_sql_reports(s, b.telemetry_table(s, sf), at)
    return tables.table_inventory(at, list(counts)).withColumnRenamed("table_name", "report")


add("sql_reports", "report i:row_count", _sql_reports, _REPORT_ROWS)
