"""DuckDB SQL for the same questions, built from named subqueries.

Written independently of the library: windows for deduplication and percentiles,
plain self-joins for chains and fault windows.
"""

from __future__ import annotations

import re

DEDUP_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"
)


def first_copy(source: str, keys: str, columns: str) -> str:
    """One row per key: the first in the order of the other columns, NULL first."""
    order = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in columns.split(","))
    return (
        f"SELECT * FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    )


def pct(part: str, whole: str) -> str:
    """100 * part / whole rounded half up to 3 decimals in whole numbers."""
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CAST((200000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 1000.0"


def pod(number: str) -> str:
    return f"'svc-' || CAST({number} % 10 AS VARCHAR) || '-rs1-p0'"


def ranked(source: str, value: str, group: str, p: float) -> str:
    """Smallest value of each group with at least the share p of the values at or below it."""
    over = f"PARTITION BY {group}" if group else ""
    head = f"{group}, " if group else ""
    return (
        f"SELECT {head}min({value}) AS cut FROM (SELECT {head}{value}, "
        f"row_number() OVER ({over} ORDER BY {value}) AS rn, count(*) OVER ({over}) AS n "
        f"FROM {source}) WHERE rn >= ceil(CAST({p} AS DOUBLE) * n)"
        + (f" GROUP BY {group}" if group else "")
    )


FULL_MS = "'%Y-%m-%d %H:%M:%S.%g'"
FULL_S = "'%Y-%m-%d %H:%M:%S'"

VIEWS: dict[str, str] = {
    # ---- binding
    "li_spans": f"""
        SELECT l_orderkey, l_linenumber, {DEDUP_ORDER},
          CAST(l_orderkey AS VARCHAR) AS trace_id,
          CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS span_id,
          CASE WHEN l_linenumber > 1
            THEN CAST(l_orderkey * 10 + l_linenumber // 2 AS VARCHAR) END AS parent_span_id,
          {pod('l_suppkey')} AS pod_id,
          'svc-' || CAST(l_suppkey % 10 AS VARCHAR) AS service_name,
          CASE WHEN l_partkey % 2000 = 13 THEN 'op-rare'
            ELSE 'op-' || CAST(l_partkey % 7 AS VARCHAR) END AS endpoint,
          ['GET', 'POST', 'PUT', 'DELETE', 'PATCH'][l_linenumber % 5 + 1] AS http_method,
          floor(l_extendedprice * 1.25::DOUBLE) / 64.0::DOUBLE AS duration_ms,
          CAST(floor(l_extendedprice * 1.25::DOUBLE) AS BIGINT) AS ticks,
          1704067200 + l_orderkey % 30 * 86400 + l_orderkey * 37 % 86400
            + l_linenumber * 11 + l_partkey % 60 AS start_sec,
          CASE WHEN l_discount > 0.095::DOUBLE THEN 503
               WHEN l_discount > 0.085::DOUBLE THEN 404 ELSE 200 END AS status_code,
          CASE WHEN l_orderkey % 2 = 0 THEN 'baseline' ELSE 'fault' END AS capture_root,
          ['2022-08-22', '2022-08-23', '2023-01-29', '2023-01-30', '2023-05-05']
            [l_orderkey % 5 + 1] AS capture_date
        FROM lineitem""",
    "traces": """
        SELECT *, start_sec * 1000000000 + l_partkey % 1000 * 1000000 AS start_ns,
          start_sec * 1000000000 + l_partkey % 1000 * 1000000 + ticks * 15625 AS end_ns
        FROM li_spans""",
    "samples": f"""
        SELECT {pod('user_id')} AS pod_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_sec,
          CASE WHEN event_id % 50 = 0 THEN -1.0::DOUBLE WHEN event_id % 51 = 0 THEN NULL
            ELSE floor(value * 640::DOUBLE) / 64.0::DOUBLE END AS cpu_usage_mcores,
          CAST(event_id % 97 * 8 + 512 AS DOUBLE) AS memory_usage_mb,
          event_id * 1048576 AS network_rx_bytes, event_id * 524288 AS network_tx_bytes
        FROM events""",
    "metrics": "SELECT * FROM samples WHERE cpu_usage_mcores >= 0",
    "spans": f"""
        SELECT *, duration_ms AS response_time_ms,
          make_timestamp((start_sec * 1000 + l_partkey % 1000) * 1000) AS start_time_ts,
          CASE WHEN status_code >= 500 THEN 1 ELSE 0 END AS is_failure
        FROM ({first_copy('li_spans', 'l_orderkey, l_linenumber', DEDUP_ORDER)})
        WHERE parent_span_id IS NOT NULL""",
    "usage": """
        SELECT pod_id, epoch_sec // 60 AS minute_no, avg(cpu_usage_mcores) AS cpu_usage_mcores,
          avg(memory_usage_mb) AS memory_usage_mb
        FROM metrics GROUP BY ALL""",
    "telemetry": """
        SELECT s.*, u.cpu_usage_mcores, u.memory_usage_mb,
          CASE WHEN response_time_ms > 2000 THEN 1 ELSE 0 END AS is_latency_spike,
          CASE WHEN response_time_ms < 100 THEN 'low' WHEN response_time_ms < 500 THEN 'medium'
            WHEN response_time_ms < 2000 THEN 'high' ELSE 'critical' END AS latency_bucket,
          CASE WHEN status_code >= 500 THEN 'server_error' WHEN status_code >= 400
            THEN 'client_error' ELSE 'success' END AS error_category,
          CAST(hour(start_time_ts) AS INTEGER) AS hour_of_day,
          CASE WHEN u.memory_usage_mb > 0 THEN u.cpu_usage_mcores / u.memory_usage_mb
            ELSE 0.0 END AS cpu_memory_ratio
        FROM spans s LEFT JOIN usage u ON s.pod_id = u.pod_id
          AND s.start_sec // 60 = u.minute_no""",
    "labels_in": f"""
        SELECT ['2022-08-22', '2022-08-23', '2023-01-29', '2023-01-30'][s_suppkey % 4 + 1]
            AS capture_date,
          strftime(make_timestamp((1704067200 + s_suppkey * 3571) * 1000000), {FULL_S})
            AS inject_time,
          1704067200 + s_suppkey * 3571 AS inject_timestamp,
          {pod('s_suppkey')} AS inject_pod,
          ['cpu_contention', 'cpu_consumed', 'network_delay', 'exception', 'return']
            [s_nationkey % 5 + 1] AS inject_type,
          'svc-' || CAST(s_suppkey % 10 AS VARCHAR) AS inject_service
        FROM supplier""",
    # ---- canonical tables as they arrive, and cleaned
    "raw_service": """
        SELECT trace_id, CASE WHEN l_partkey % 101 <> 0 THEN service_name END AS service_name,
          CASE WHEN l_partkey % 103 <> 0 THEN span_id END AS span_id,
          CASE WHEN l_linenumber > 1 THEN parent_span_id WHEN l_orderkey % 2 = 0 THEN '' END
            AS parent_span_id,
          'ns' AS namespace, pod_id, CAST(NULL AS VARCHAR) AS node_id
        FROM traces""",
    "raw_response": """
        SELECT span_id, CASE WHEN l_quantity = 50 THEN -1.0::DOUBLE WHEN l_quantity = 48 THEN NULL
            ELSE duration_ms END AS response_time_ms,
          CAST(NULL AS DOUBLE) AS wait_time_ms,
          CASE WHEN l_linenumber = 3 THEN NULL WHEN l_quantity = 49 THEN -1.0::DOUBLE
            ELSE duration_ms END AS processing_time_ms,
          CAST(NULL AS DOUBLE) AS network_latency_ms
        FROM traces""",
    "raw_request": f"""
        SELECT span_id,
          CASE WHEN l_tax > 0.075::DOUBLE THEN 'n/a'
            ELSE strftime(make_timestamp(start_ns // 1000), {FULL_MS}) END AS start_time,
          CASE WHEN l_tax < 0.005::DOUBLE THEN 'n/a'
            ELSE strftime(make_timestamp(end_ns // 1000), {FULL_MS}) END AS end_time,
          duration_ms, http_method, endpoint
        FROM traces""",
    "raw_usage": f"""
        SELECT pod_id, strftime(make_timestamp(epoch_sec * 1000000), {FULL_S}) AS timestamp,
          cpu_usage_mcores, memory_usage_mb, network_rx_bytes, network_tx_bytes,
          CAST(NULL AS BIGINT) AS disk_io_read_bytes, CAST(NULL AS BIGINT) AS disk_io_write_bytes
        FROM samples""",
    "raw_status": """
        SELECT span_id, status_code,
          CASE WHEN status_code = 503 THEN 'slow' ELSE '' END AS error_message,
          CASE WHEN status_code = 503 THEN 1 ELSE 0 END AS is_error
        FROM traces""",
    "valid_service": """SELECT * FROM raw_service WHERE span_id IS NOT NULL
        AND service_name IS NOT NULL AND parent_span_id <> ''""",
    "clean_service": first_copy(
        "valid_service", "span_id", "trace_id, service_name, parent_span_id, namespace, pod_id"
    ),
    "valid_response": """SELECT * FROM raw_response WHERE span_id IS NOT NULL
        AND response_time_ms >= 0 AND (processing_time_ms IS NULL OR processing_time_ms >= 0)""",
    "clean_response": first_copy(
        "valid_response", "span_id", "response_time_ms, processing_time_ms"
    ),
    "valid_request": """SELECT *, TRY_CAST(start_time AS TIMESTAMP) AS start_time_ts,
          TRY_CAST(end_time AS TIMESTAMP) AS end_time_ts
        FROM raw_request WHERE TRY_CAST(start_time AS TIMESTAMP) IS NOT NULL""",
    "clean_request": first_copy(
        "valid_request", "span_id", "start_time, end_time, duration_ms, http_method, endpoint"
    ),
    "valid_usage": """SELECT *, TRY_CAST(timestamp AS TIMESTAMP) AS ts FROM raw_usage
        WHERE cpu_usage_mcores >= 0""",
    "clean_usage": first_copy(
        "valid_usage", "pod_id, timestamp",
        "cpu_usage_mcores, memory_usage_mb, network_rx_bytes, network_tx_bytes",
    ),
    "clean_status": first_copy(
        "raw_status", "span_id", "status_code, error_message, is_error"
    ),
    "joined_spans": """
        SELECT * FROM clean_service JOIN clean_response USING (span_id)
          JOIN clean_request USING (span_id) JOIN clean_status USING (span_id)""",
    "unified": """
        SELECT j.*, u.cpu AS cpu_usage_mcores, u.mem AS memory_usage_mb,
          CASE WHEN status_code >= 500 THEN 1 ELSE 0 END AS is_failure,
          CASE WHEN response_time_ms > 2000 THEN 1 ELSE 0 END AS is_latency_spike,
          CASE WHEN response_time_ms < 100 THEN 'low' WHEN response_time_ms < 500 THEN 'medium'
            WHEN response_time_ms < 2000 THEN 'high' ELSE 'critical' END AS latency_bucket,
          CASE WHEN status_code >= 500 THEN 'server_error' WHEN status_code >= 400
            THEN 'client_error' ELSE 'success' END AS error_category,
          hour(start_time_ts) AS hour_of_day,
          CASE WHEN u.mem > 0 THEN u.cpu / u.mem ELSE 0.0 END AS cpu_memory_ratio
        FROM joined_spans j LEFT JOIN (
          SELECT pod_id, date_trunc('minute', ts) AS m, avg(cpu_usage_mcores) AS cpu,
            avg(memory_usage_mb) AS mem FROM clean_usage GROUP BY ALL) u
          ON j.pod_id = u.pod_id AND date_trunc('minute', j.start_time_ts) = u.m""",
    # ---- self time and ceilings
    "child": """SELECT parent_span_id, sum(duration_ms) AS child_duration_ms
        FROM traces GROUP BY ALL""",
    "timed": """
        SELECT t.*, c.child_duration_ms,
          greatest(duration_ms - coalesce(c.child_duration_ms, 0), 0) AS self_time_ms
        FROM traces t LEFT JOIN child c ON t.span_id = c.parent_span_id""",
    "base": "SELECT * FROM timed WHERE capture_root = 'baseline'",
    "base_cut": ranked("base", "self_time_ms", "endpoint", 0.99),
    "base_all": ranked("base", "self_time_ms", "", 0.99),
    "ceiling": """
        SELECT endpoint, n AS baseline_samples,
          CASE WHEN n >= 30 THEN cut ELSE (SELECT cut FROM base_all) END AS baseline_p99_ms
        FROM (SELECT endpoint, count(*) AS n FROM base GROUP BY ALL) JOIN base_cut USING (endpoint)
        """,
    "judged": """
        SELECT t.*, c.baseline_p99_ms, c.baseline_samples,
          CASE WHEN c.baseline_p99_ms IS NOT NULL AND t.self_time_ms > c.baseline_p99_ms
            THEN 1 ELSE 0 END AS is_degraded
        FROM timed t LEFT JOIN ceiling c USING (endpoint)""",
    "can_service": """
        SELECT trace_id, service_name, span_id, parent_span_id,
          CASE WHEN capture_date IN ('2022-08-22', '2022-08-23') THEN 'hipstershop'
               WHEN capture_date IN ('2023-01-29', '2023-01-30') THEN 'trainticket'
               ELSE 'unknown' END AS namespace,
          pod_id, CAST(NULL AS VARCHAR) AS node_id
        FROM judged""",
    "can_response": """
        SELECT span_id, duration_ms AS response_time_ms, CAST(NULL AS DOUBLE) AS wait_time_ms,
          duration_ms AS processing_time_ms, CAST(NULL AS DOUBLE) AS network_latency_ms
        FROM judged""",
    "can_request": f"""
        SELECT span_id, strftime(make_timestamp(start_ns // 1000), {FULL_MS}) AS start_time,
          strftime(make_timestamp(end_ns // 1000), {FULL_MS}) AS end_time, duration_ms,
          CAST(NULL AS VARCHAR) AS http_method, endpoint
        FROM judged""",
    "can_status": """
        SELECT span_id, CASE WHEN is_degraded = 1 THEN 503 ELSE 200 END AS status_code,
          CASE WHEN is_degraded = 1 THEN
            'Self time ' || CAST(round(self_time_ms, 2) AS VARCHAR)
            || ' ms exceeded the fault-free p99 of '
            || CAST(round(baseline_p99_ms, 2) AS VARCHAR) || ' ms for this operation'
            ELSE '' END AS error_message,
          is_degraded AS is_error
        FROM judged""",
    "can_usage": f"""
        SELECT pod_id, strftime(make_timestamp(epoch_sec * 1000000), {FULL_S}) AS timestamp,
          cpu_usage_mcores, memory_usage_mb, network_rx_bytes, network_tx_bytes,
          CAST(NULL AS BIGINT) AS disk_io_read_bytes, CAST(NULL AS BIGINT) AS disk_io_write_bytes
        FROM metrics""",
    # nothing canonical is invalid except spans without a parent
    "can_service_valid": "SELECT * FROM can_service WHERE parent_span_id <> ''",
    "norm_service": first_copy(
        "can_service_valid", "span_id",
        "trace_id, service_name, parent_span_id, namespace, pod_id",
    ),
    "norm_response": first_copy("can_response", "span_id", "response_time_ms"),
    "norm_request": first_copy(
        "can_request", "span_id", "start_time, end_time, duration_ms, endpoint"
    ),
    "norm_status": first_copy("can_status", "span_id", "status_code, error_message, is_error"),
    # ---- call graph
    "edges": """
        SELECT p.service_name AS caller_service, c.service_name AS callee_service,
          p.is_failure AS caller_failure, c.is_failure AS callee_failure,
          p.start_time_ts AS caller_start, c.start_time_ts AS callee_start,
          c.response_time_ms AS callee_latency
        FROM spans p JOIN spans c ON p.span_id = c.parent_span_id""",
    "pairs": """
        SELECT *, CASE WHEN callee_error_count > 0
          THEN CAST(co_failure_count AS DOUBLE) / callee_error_count ELSE 0.0 END
          AS propagation_score
        FROM (SELECT caller_service, callee_service, count(*) AS call_count,
            sum(caller_failure) AS caller_error_count, sum(callee_failure) AS callee_error_count,
            sum(CASE WHEN caller_failure = 1 AND callee_failure = 1 THEN 1 ELSE 0 END)
              AS co_failure_count,
            avg(callee_latency) AS avg_callee_latency_ms
          FROM edges GROUP BY ALL)""",
    "chains": """
        SELECT trace_id, service_name AS source_service, next_service AS target_service,
          start_time_ts AS source_timestamp, next_ts AS target_timestamp,
          CAST(floor(epoch(next_ts)) - floor(epoch(start_time_ts)) AS BIGINT)
            AS propagation_lag_sec,
          2 AS propagation_depth
        FROM (SELECT *, lead(service_name) OVER w AS next_service,
                lead(start_time_ts) OVER w AS next_ts
              FROM spans WHERE is_failure = 1
              WINDOW w AS (PARTITION BY trace_id ORDER BY start_time_ts, span_id))
        WHERE next_service <> service_name
          AND floor(epoch(next_ts)) - floor(epoch(start_time_ts)) <= 60""",
    "minute_rate": """
        SELECT service_name, time_bucket(INTERVAL 1 MINUTE, start_time_ts) AS minute_ts,
          CAST(sum(is_failure) AS DOUBLE) / count(*) AS error_rate
        FROM spans GROUP BY ALL""",
    "paired": """
        SELECT a.minute_ts, a.service_name AS service_a, a.error_rate AS error_rate_a,
          b.service_name AS service_b, b.error_rate AS error_rate_b
        FROM minute_rate a JOIN minute_rate b
          ON a.minute_ts = b.minute_ts AND a.service_name < b.service_name""",
    "correlations": """
        SELECT service_a, service_b, n AS sample_size,
          greatest(-1.0, least(1.0, cov / sqrt(va * vb))) AS error_correlation
        FROM (SELECT service_a, service_b, count(*) AS n,
            covar_pop(error_rate_a, error_rate_b) AS cov,
            var_pop(error_rate_a) AS va, var_pop(error_rate_b) AS vb
          FROM paired GROUP BY ALL)
        WHERE n >= 5 AND va > 0 AND vb > 0""",
    # ---- anomalies
    "series": """
        SELECT service_name, time_bucket(INTERVAL 15 MINUTE, start_time_ts) AS time_bucket,
          count(*) AS total_requests, sum(is_failure) AS error_count,
          avg(response_time_ms) AS avg_latency_ms, avg(cpu_usage_mcores) AS avg_cpu_mcores,
          avg(memory_usage_mb) AS avg_memory_mb,
          CAST(sum(is_failure) AS DOUBLE) / count(*) AS error_rate
        FROM telemetry GROUP BY service_name, time_bucket(INTERVAL 15 MINUTE, start_time_ts)""",
    "stats": """
        SELECT service_name, avg(error_rate) AS mean_error_rate,
          stddev_samp(error_rate) AS std_error_rate, avg(avg_latency_ms) AS mean_latency,
          stddev_samp(avg_latency_ms) AS std_latency, avg(avg_cpu_mcores) AS mean_cpu,
          stddev_samp(avg_cpu_mcores) AS std_cpu, avg(avg_memory_mb) AS mean_memory,
          stddev_samp(avg_memory_mb) AS std_memory
        FROM series GROUP BY ALL""",
    "zscores": """
        SELECT s.*, t.* EXCLUDE (service_name),
          CASE WHEN std_error_rate > 0 THEN (error_rate - mean_error_rate) / std_error_rate
            ELSE 0.0 END AS zscore_error_rate,
          CASE WHEN std_latency > 0 THEN (avg_latency_ms - mean_latency) / std_latency
            ELSE 0.0 END AS zscore_latency,
          CASE WHEN std_cpu > 0 THEN (avg_cpu_mcores - mean_cpu) / std_cpu ELSE 0.0 END
            AS zscore_cpu,
          CASE WHEN std_memory > 0 THEN (avg_memory_mb - mean_memory) / std_memory ELSE 0.0 END
            AS zscore_memory,
          CASE WHEN error_rate > 0.05::DOUBLE THEN 1 ELSE 0 END AS is_error_rate_slo_breach,
          CASE WHEN avg_latency_ms > 1000 THEN 1 ELSE 0 END AS is_latency_slo_breach
        FROM series s JOIN stats t USING (service_name)""",
    "flags": """
        SELECT *,
          CASE WHEN abs(zscore_error_rate) > 3 OR is_error_rate_slo_breach = 1 THEN 1 ELSE 0 END
            AS is_anomaly_error,
          CASE WHEN abs(zscore_latency) > 3 OR is_latency_slo_breach = 1 THEN 1 ELSE 0 END
            AS is_anomaly_latency,
          CASE WHEN abs(zscore_cpu) > 3 OR abs(zscore_memory) > 3 THEN 1 ELSE 0 END
            AS is_anomaly_resource
        FROM zscores""",
    "scored": """
        SELECT *, CASE WHEN anomaly_score >= 2 THEN 1 ELSE 0 END AS is_anomaly_overall
        FROM (SELECT service_name, time_bucket, is_anomaly_error, is_error_rate_slo_breach,
            is_anomaly_latency, is_latency_slo_breach, is_anomaly_resource,
            coalesce(zscore_error_rate, 0) AS zscore_error_rate,
            coalesce(zscore_latency, 0) AS zscore_latency,
            coalesce(zscore_cpu, 0) AS zscore_cpu, coalesce(zscore_memory, 0) AS zscore_memory,
            is_anomaly_error + is_anomaly_latency + is_anomaly_resource AS anomaly_score
          FROM flags)""",
    "patterns": """
        SELECT service_name, pattern_type, count(*) AS occurrence_count,
          avg(anomaly_score) AS avg_severity
        FROM (SELECT *, CASE WHEN anomaly_score = 3 THEN 'full_failure'
            WHEN is_anomaly_error = 1 AND is_anomaly_latency = 1 THEN 'cascading_failure'
            WHEN is_anomaly_latency = 1 AND is_anomaly_resource = 1 THEN 'resource_exhaustion'
            WHEN is_anomaly_error = 1 AND is_anomaly_resource = 1 THEN 'error_resource_link'
            WHEN is_anomaly_error = 1 THEN 'error_surge'
            WHEN is_anomaly_latency = 1 THEN 'latency_spike'
            WHEN is_anomaly_resource = 1 THEN 'resource_pressure' ELSE 'normal' END
            AS pattern_type FROM scored)
        WHERE pattern_type <> 'normal' GROUP BY ALL""",
    "slo": """
        SELECT service_name, sum(is_error_rate_slo_breach) AS error_slo_breaches,
          sum(is_latency_slo_breach) AS latency_slo_breaches,
          sum(is_anomaly_overall) AS overall_anomalies, count(*) AS buckets
        FROM scored GROUP BY ALL""",
    "anomalous": """
        SELECT service_name, count(*) AS anomaly_count FROM scored
        WHERE is_anomaly_overall = 1 GROUP BY ALL""",
    "pattern_sums": """
        SELECT pattern_type, sum(occurrence_count) AS occurrences,
          avg(avg_severity) AS avg_severity FROM patterns GROUP BY ALL""",
    "health": """
        SELECT service_name, count(*) AS requests, sum(is_failure) AS failures,
          avg(response_time_ms) AS avg_latency_ms, avg(cpu_usage_mcores) AS avg_cpu_mcores,
          avg(memory_usage_mb) AS avg_memory_mb,
          100.0::DOUBLE * sum(is_failure) / count(*) AS error_rate_pct
        FROM telemetry GROUP BY ALL""",
    # ---- benchmark runs
    "raw_runs": """
        SELECT CAST(data_size AS VARCHAR) || '_r' || CAST(repetition AS VARCHAR) AS label, *,
          groupby_agg_sec + window_fn_sec + join_sec + shuffle_sec AS total_sec
        FROM (SELECT l_linenumber * 100000 AS data_size, l_suppkey % 3 + 1 AS repetition,
            count(*) AS input_rows,
            floor(sum(l_quantity * l_linenumber) / 64.0::DOUBLE) / 64.0::DOUBLE AS groupby_agg_sec,
            floor(sum(l_quantity * l_linenumber * 2) / 64.0::DOUBLE) / 64.0::DOUBLE
              AS window_fn_sec,
            floor(sum(l_quantity * l_linenumber * 3) / 64.0::DOUBLE) / 64.0::DOUBLE AS join_sec,
            floor(sum(l_quantity * l_linenumber * 4) / 64.0::DOUBLE) / 64.0::DOUBLE AS shuffle_sec
          FROM lineitem GROUP BY l_linenumber, l_suppkey % 3)""",
    "first_run": """SELECT total_sec AS t0, data_size AS d0 FROM raw_runs
        ORDER BY data_size, repetition LIMIT 1""",
    "runs": """
        SELECT r.*, CASE WHEN total_sec > 0 THEN round(input_rows / total_sec, 1) ELSE 0.0 END
            AS throughput_rows_per_sec,
          t0 AS baseline_time_sec, d0 AS baseline_size,
          round(t0 / greatest(total_sec, 0.001), 3) AS speedup_vs_baseline
        FROM raw_runs r, first_run""",
    "by_size": """
        SELECT data_size, avg(total_sec) AS total_sec, stddev_samp(total_sec) AS std_total_sec,
          avg(groupby_agg_sec) AS groupby_agg_sec, avg(window_fn_sec) AS window_fn_sec,
          avg(join_sec) AS join_sec, avg(shuffle_sec) AS shuffle_sec,
          avg(throughput_rows_per_sec) AS throughput, count(*) AS repetitions,
          avg(speedup_vs_baseline) AS mean_speedup
        FROM runs GROUP BY ALL""",
    "smallest": "SELECT data_size AS s0, total_sec AS t0 FROM by_size ORDER BY data_size LIMIT 1",
    # ---- log lines
    "log": """
        SELECT event_id AS line_no, CASE WHEN event_id % 13 = 0 THEN '  at frame ' || body
          ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || ' [' || rpad(lvl, 8, ' ') || '] ' || body
          END AS line, lvl, body, ts, event_id % 13 = 0 AS bare
        FROM (SELECT *, 'User ' || CAST(user_id AS VARCHAR) || ' ' || props AS body,
            CASE WHEN event_id % 11 = 0 THEN 'DEBUG' WHEN event_type = 'error' THEN 'ERROR'
              WHEN event_type = 'click' THEN 'WARN' WHEN event_type = 'purchase' THEN 'CRIT'
              ELSE 'INFO' END AS lvl FROM events)""",
}

_WORD = re.compile(r"[a-z_][a-z0-9_]*")


def _needs(sql: str) -> list[str]:
    words = set(_WORD.findall(sql))
    return [name for name in VIEWS if name in words]


def with_views(sql: str) -> str:
    """`sql` preceded by the subqueries it uses, each after those it uses itself."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in _needs(VIEWS[name]):
            if other != name:
                visit(other)
        ordered.append(name)

    for name in _needs(sql):
        visit(name)
    if not ordered:
        return sql
    parts = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    return f"WITH {parts}\n{sql}"
