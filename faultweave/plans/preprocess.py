"""Canonical tables to unified telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultweave.config import DEFAULTS, Settings
from faultweave.operators import cleaning, spans
from faultweave.sources import canonical as canonical_files
from faultweave.sources.tables import TableStore


def preprocess(tables: dict[str, DataFrame], keep_roots: bool = False) -> DataFrame:
    cleaned = cleaning.clean_all(tables, keep_roots)
    joined = spans.join_resources(spans.join_spans(cleaned), cleaned["resource_usage"])
    return spans.engineer_features(joined)


def run_preprocess(
    spark: SparkSession,
    path: str,
    out: str,
    store: TableStore,
    settings: Settings = DEFAULTS,
    keep_roots: bool = False,
) -> DataFrame:
    """Write telemetry under `out` and to the store, and return it as read back.

    A hash sample for quick looks goes beside it, under a name of its own.
    """
    unified = preprocess(canonical_files.read_canonical(spark, path), keep_roots)
    canonical_files.write_parquet(unified, out)
    written = canonical_files.read_parquet(spark, out)
    store.write(written, "processed_telemetry")
    store.write(
        written, "processed_telemetry_sample", sample_key="span_id", sample_mod=settings.sample_mod
    )
    return written
