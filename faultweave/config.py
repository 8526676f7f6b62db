"""Thresholds shared by the operators and the plans built from them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # anomaly scoring
    zscore: float = 3.0
    error_rate_slo: float | None = 0.05
    latency_slo_ms: float | None = 1000.0
    bucket_minutes: int = 15
    # failure propagation
    chain_window_sec: int = 60
    min_correlation: float = 0.3
    min_samples: int = 5
    # fault-free latency ceilings
    ceiling_percentile: float = 0.99
    ceiling_min_samples: int = 30
    # labelled fault windows
    fault_window_sec: int = 300
    # dataset checks and serving tables
    null_threshold: float = 0.5
    min_rows: int = 10_000
    sample_mod: int = 10


DEFAULTS = Settings()

# Application captured on each known date.
NAMESPACES = {
    "2022-08-22": "hipstershop",
    "2022-08-23": "hipstershop",
    "2023-01-29": "trainticket",
    "2023-01-30": "trainticket",
}

# Directory holding the fault-free capture, and the fault capture.
BASELINE_ROOT = "construct_data"
FAULT_ROOT = "rca_data"
ROOTS = (BASELINE_ROOT, FAULT_ROOT)

# Pipeline stages and the table each one fills.
STAGES = (
    ("1 - Ingestion", "raw_telemetry"),
    ("2 - Preprocessing", "processed_telemetry"),
    ("3 - Cross-service (RQ1)", "cross_service_pairs"),
    ("4 - Failure detection (RQ2)", "anomaly_scores"),
    ("5 - Scalability (RQ3)", "scalability_metrics"),
)
