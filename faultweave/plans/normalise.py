"""Raw captures to the canonical tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from faultweave.config import DEFAULTS, NAMESPACES, ROOTS, Settings
from faultweave.operators import canonical, selftime
from faultweave.sources import canonical as canonical_files
from faultweave.sources import labels, raw
from faultweave.sources.tables import TableStore
from faultweave.sources.workspace import materialise


def normalise(
    traces: DataFrame,
    metrics: DataFrame,
    settings: Settings = DEFAULTS,
    namespaces: Mapping[str, str] = NAMESPACES,
) -> dict[str, DataFrame]:
    """Canonical tables from typed traces and metrics.

    Runs jobs: the typed traces are written once, since six passes read some of their
    columns; the fault-free self times (three columns) before the ceilings are learned from
    them in several passes, and the ceilings (a row per endpoint) before they are joined.
    """
    traces = materialise(traces, "traces")
    timed = selftime.add_self_time(traces)
    ceilings = selftime.latency_ceiling(
        materialise(selftime.baseline_self_time(timed), "baseline"),
        settings.ceiling_percentile,
        settings.ceiling_min_samples,
    )
    judged = selftime.join_latency_ceiling(timed, materialise(ceilings, "ceilings"))
    return canonical.canonical_tables(selftime.flag_degraded(judged), metrics, namespaces)


def run_normalise(
    spark: SparkSession,
    path: str,
    out: str,
    store: TableStore | None = None,
    roots: Sequence[str] = ROOTS,
    settings: Settings = DEFAULTS,
) -> dict[str, int]:
    """Read captures under `path`, write the canonical tables under `out`, return row counts.

    Fault labels, where there are any, go to the store as ``fault_injections``.
    """
    tables = normalise(
        raw.read_traces(spark, path, roots), raw.read_metrics(spark, path, roots), settings
    )
    counts = canonical_files.write_canonical(tables, out)
    if store is not None:
        truth = labels.ground_truth(labels.read_fault_labels(spark, path))
        store.write(truth, "fault_injections")
    return counts
