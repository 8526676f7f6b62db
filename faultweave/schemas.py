"""Declared schemas, as DDL strings. Nothing in the library infers a type."""

from __future__ import annotations

CANONICAL = {
    "trace_service_name": (
        "trace_id string, service_name string, span_id string, parent_span_id string, "
        "namespace string, pod_id string, node_id string"
    ),
    "trace_response_times": (
        "span_id string, response_time_ms double, wait_time_ms double, "
        "processing_time_ms double, network_latency_ms double"
    ),
    "trace_request_times": (
        "span_id string, start_time string, end_time string, duration_ms double, "
        "http_method string, endpoint string"
    ),
    # Byte counters are bigint: a node's counter passes 2^31 within hours.
    "resource_usage": (
        "pod_id string, timestamp string, cpu_usage_mcores double, memory_usage_mb double, "
        "network_rx_bytes bigint, network_tx_bytes bigint, "
        "disk_io_read_bytes bigint, disk_io_write_bytes bigint"
    ),
    "status_codes": "span_id string, status_code int, error_message string, is_error int",
}

# Header each kind of source file must carry.
SOURCE_COLUMNS = {
    "trace": (
        "TraceID", "SpanID", "ParentID", "PodName", "OperationName",
        "StartTimeUnixNano", "EndTimeUnixNano", "Duration",
    ),
    "log": (
        "Timestamp", "TimeUnixNano", "Node", "PodName", "Container", "TraceID", "SpanID", "Log",
    ),
    "metric": (
        "Time", "TimeStamp", "PodName", "CpuUsage(m)", "CpuUsageRate(%)",
        "MemoryUsage(Mi)", "MemoryUsageRate(%)",
    ),
}

INJECTIONS = (
    "array<struct<inject_time: string, inject_timestamp: string, "
    "inject_pod: string, inject_type: string>>"
)

RUNS = (
    "label string, input_rows bigint, data_size bigint, repetition int, "
    "groupby_agg_sec double, window_fn_sec double, join_sec double, shuffle_sec double, "
    "total_sec double"
)

ANOMALY_TABLE = (
    "service_name", "time_bucket", "is_anomaly_error", "is_anomaly_latency",
    "is_anomaly_resource", "is_error_rate_slo_breach", "is_latency_slo_breach",
    "anomaly_score", "is_anomaly_overall",
)
