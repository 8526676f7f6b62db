"""Failure propagation between services."""

from __future__ import annotations

from pyspark.sql import DataFrame

from faultweave.config import DEFAULTS, Settings
from faultweave.operators import callgraph
from faultweave.sources.canonical import write_parquet
from faultweave.sources.tables import TableStore


def cross_service(telemetry: DataFrame, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    return {
        "cross_service_pairs": callgraph.service_dependency_graph(telemetry),
        "propagation_chains": callgraph.propagation_chains(
            telemetry, settings.chain_window_sec
        ),
        "error_correlations": callgraph.error_correlation(
            telemetry, settings.min_correlation, settings.min_samples
        ),
    }


def run_cross_service(
    telemetry: DataFrame, store: TableStore, out: str, settings: Settings = DEFAULTS
) -> DataFrame:
    """Write the result tables and all chains; return the summary over what was written."""
    found = cross_service(telemetry, settings)
    write_parquet(found["propagation_chains"], out)
    chains = telemetry.sparkSession.read.parquet(out)
    store.write(found["cross_service_pairs"], "cross_service_pairs")
    store.write(chains, "propagation_chains")
    store.write(found["error_correlations"], "error_correlations")
    return callgraph.propagation_metrics(store.read("cross_service_pairs"), chains)
