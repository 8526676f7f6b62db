from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))
os.environ.setdefault("TZ", "UTC")

from moments import at  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("faultweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def spans(spark):
    """Builds telemetry from (trace, span, parent, service, second, failed[, latency]) rows."""

    def build(rows):
        full = [(*r, 10.0) if len(r) == 6 else r for r in rows]
        data = [
            (t, s, p, svc, at(sec) if sec is not None else None, f, 503 if f else 200, float(ms))
            for t, s, p, svc, sec, f, ms in full
        ]
        return spark.createDataFrame(
            data,
            "trace_id string, span_id string, parent_span_id string, service_name string, "
            "start_time_ts timestamp, is_failure int, status_code int, response_time_ms double",
        )

    return build
