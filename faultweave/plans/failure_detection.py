"""Anomalous time buckets and the failure patterns they form."""

from __future__ import annotations

from pyspark.sql import DataFrame

from faultweave.config import DEFAULTS, Settings
from faultweave.operators import anomalies
from faultweave.schemas import ANOMALY_TABLE
from faultweave.sources.canonical import write_parquet
from faultweave.sources.tables import TableStore


def failure_detection(
    telemetry: DataFrame, settings: Settings = DEFAULTS
) -> dict[str, DataFrame]:
    series = anomalies.error_rate_timeseries(telemetry, settings.bucket_minutes)
    unified = anomalies.score_anomalies(series, settings)
    return {"anomalies": unified, "failure_patterns": anomalies.failure_patterns(unified)}


def run_failure_detection(
    telemetry: DataFrame, store: TableStore, out: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """Write scores and patterns; return the summary over what was written.

    The scored buckets are written first and everything else reads them back, so
    telemetry is scanned once.
    """
    write_parquet(failure_detection(telemetry, settings)["anomalies"], out)
    unified = telemetry.sparkSession.read.parquet(out)
    store.write(unified.select(*ANOMALY_TABLE), "anomaly_scores")
    store.write(anomalies.failure_patterns(unified), "failure_patterns")
    return anomalies.rq2_summary(unified, store.read("failure_patterns"))
