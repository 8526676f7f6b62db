"""Named Spark SQL reports over telemetry and, where present, fault labels."""

from __future__ import annotations

import re
from collections.abc import Callable, Collection, Iterable
from functools import cache
from importlib import resources

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultweave.config import DEFAULTS, Settings
from faultweave.operators.faults import join_fault_window
from faultweave.operators.quantiles import bucket_counts, grouped_percentiles
from faultweave.sources.tables import TableStore

MARKER = re.compile(r"^--\s*@name\s+(\w+)\s*$", re.MULTILINE)
NEEDS_LABELS = frozenset({"ground_truth_evaluation"})


def split_statements(text: str) -> dict[str, str]:
    """``{name: statement}`` of a marked SQL text; a name without a body is skipped."""
    _, *pieces = MARKER.split(text)
    if not pieces:
        raise ValueError("no '-- @name' marker in the SQL text")
    found = zip(pieces[0::2], pieces[1::2], strict=True)
    return {name: body.strip() for name, body in found if body.strip()}


def load_queries(path: str | None = None) -> dict[str, str]:
    """Statements of a file, by default the reports shipped with the package."""
    if path is None:
        text = resources.files("faultweave.plans").joinpath("reports.sql").read_text("utf-8")
    else:
        with open(path, encoding="utf-8") as file:
            text = file.read()
    return split_statements(text)


def _views(
    telemetry: DataFrame, ground_truth: DataFrame | None, settings: Settings
) -> dict[str, Callable[[], DataFrame]]:
    """How each view is made, once a statement names it."""
    counts = cache(lambda: bucket_counts(telemetry, ["service_name", "endpoint"], "response_time_ms"))

    def cuts(groups: list[str], shares: dict[str, float]) -> DataFrame:
        return grouped_percentiles(telemetry, groups, "response_time_ms", shares, counts())

    made = {
        "telemetry": lambda: telemetry,
        "service_cuts": lambda: cuts(["service_name"], {"p50": 0.5, "p95": 0.95, "p99": 0.99}),
        "endpoint_cuts": lambda: cuts(["service_name", "endpoint"], {"p95": 0.95}),
    }
    if ground_truth is not None:
        made["ground_truth"] = lambda: ground_truth
        made["fault_windows"] = lambda: join_fault_window(telemetry, ground_truth, settings.fault_window_sec)
    return made


def register_views(
    telemetry: DataFrame,
    ground_truth: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    statements: Iterable[str] | None = None,
) -> None:
    """Temporary views for the reports; with `statements`, only those that they name."""
    words = None if statements is None else set(re.findall(r"\w+", " ".join(statements)))
    for name, make in _views(telemetry, ground_truth, settings).items():
        if words is None or name in words:
            make().createOrReplaceTempView(name)


def run_queries(
    spark: SparkSession,
    queries: dict[str, str],
    has_ground_truth: bool,
    settings: Settings = DEFAULTS,
    failures: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Lazy result per statement.

    Statements on labels are skipped where there are none. A statement that does
    not analyse is left out, its message put in `failures`; the others still run.
    """
    results = {}
    for name, statement in queries.items():
        if name in NEEDS_LABELS and not has_ground_truth:
            continue
        named = {"window": settings.fault_window_sec} if ":window" in statement else None
        try:
            results[name] = spark.sql(statement, args=named)
        except PySparkException as error:
            if failures is not None:
                failures[name] = str(error)
    return results


def run_reports(
    spark: SparkSession,
    telemetry: DataFrame,
    ground_truth: DataFrame | None = None,
    settings: Settings = DEFAULTS,
    only: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """All reports, or `only` the named ones, over the views that they need."""
    queries = {name: text for name, text in load_queries().items() if only is None or name in only}
    register_views(telemetry, ground_truth, settings, queries.values())
    return run_queries(spark, queries, ground_truth is not None, settings)


def run_sql_reports(
    spark: SparkSession, telemetry: DataFrame, store: TableStore, settings: Settings = DEFAULTS
) -> dict[str, int]:
    """Run every report, store each result, and return its row count.

    An empty label table counts as no labels. Rows are counted while they are written. A
    report whose write fails ends the run with its error; those before it are stored.
    """
    truth = store.read_optional("fault_injections")
    if truth is not None and truth.isEmpty():
        truth = None
    counts = {}
    for name, result in run_reports(spark, telemetry, truth, settings).items():
        seen = Observation()
        store.write(result.observe(seen, F.count("*").alias("rows")), name)
        counts[name] = seen.get["rows"]
    return counts
