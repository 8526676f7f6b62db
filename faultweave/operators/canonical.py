"""Projections of flagged traces and raw metrics onto the canonical tables.

Values the source does not measure stay NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultweave.config import NAMESPACES
from faultweave.functions import names, numbers

MILLIS = "yyyy-MM-dd HH:mm:ss.SSS"
SECONDS = "yyyy-MM-dd HH:mm:ss"


def _absent(type_name: str, name: str) -> Column:
    return F.lit(None).cast(type_name).alias(name)


def canonical_trace_service(
    traces: DataFrame, namespaces: Mapping[str, str] = NAMESPACES
) -> DataFrame:
    return traces.select(
        "trace_id", "service_name", "span_id", "parent_span_id",
        names.namespace_of(F.col("capture_date"), namespaces).alias("namespace"),
        "pod_id",
        _absent("string", "node_id"),
    )


def canonical_response_times(traces: DataFrame) -> DataFrame:
    return traces.select(
        "span_id",
        F.col("duration_ms").alias("response_time_ms"),
        _absent("double", "wait_time_ms"),
        F.col("duration_ms").alias("processing_time_ms"),
        _absent("double", "network_latency_ms"),
    )


def canonical_request_times(traces: DataFrame) -> DataFrame:
    def text(nanos: str) -> Column:
        return F.date_format(numbers.nanos_to_timestamp(F.col(nanos)), MILLIS)

    return traces.select(
        "span_id",
        text("start_ns").alias("start_time"),
        text("end_ns").alias("end_time"),
        "duration_ms",
        _absent("string", "http_method"),
        "endpoint",
    )


def canonical_status_codes(traces: DataFrame) -> DataFrame:
    degraded = F.col("is_degraded") == 1
    # Wording of the error message.
    message = F.concat(
        F.lit("Self time "), F.round("self_time_ms", 2).cast("string"),
        F.lit(" ms exceeded the fault-free p99 of "),
        F.round("baseline_p99_ms", 2).cast("string"),
        F.lit(" ms for this operation"),
    )
    return traces.select(
        "span_id",
        F.when(degraded, 503).otherwise(200).alias("status_code"),
        F.when(degraded, message).otherwise("").alias("error_message"),
        F.col("is_degraded").alias("is_error"),
    )


def canonical_resource_usage(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "pod_id",
        F.date_format(F.timestamp_seconds("epoch_sec"), SECONDS).alias("timestamp"),
        "cpu_usage_mcores", "memory_usage_mb",
        F.col("network_rx_bytes").try_cast("bigint").alias("network_rx_bytes"),
        F.col("network_tx_bytes").try_cast("bigint").alias("network_tx_bytes"),
        _absent("bigint", "disk_io_read_bytes"),
        _absent("bigint", "disk_io_write_bytes"),
    )


def canonical_tables(
    flagged: DataFrame, metrics: DataFrame, namespaces: Mapping[str, str] = NAMESPACES
) -> dict[str, DataFrame]:
    return {
        "trace_service_name": canonical_trace_service(flagged, namespaces),
        "trace_response_times": canonical_response_times(flagged),
        "trace_request_times": canonical_request_times(flagged),
        "resource_usage": canonical_resource_usage(metrics),
        "status_codes": canonical_status_codes(flagged),
    }
