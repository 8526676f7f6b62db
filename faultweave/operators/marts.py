"""Serving tables over telemetry and over the result tables.

Every function takes the table it serves; `services` narrows to some services, and
an empty selection means all. Rankings end in key columns, so ties are stable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultweave.functions import features, names, numbers



def service_filter(
    df: DataFrame, services: Sequence[str] = (), column: str = "service_name"
) -> DataFrame:
    return df.filter(names.in_services(F.col(column), services)) if services else df


def _top(df: DataFrame, k: int | None, measure: Column, *keys: str) -> DataFrame:
    ranked = df.orderBy(measure.desc(), *keys)
    return ranked if k is None else ranked.limit(k)


# ---- telemetry -------------------------------------------------------------


def mart_service_names(telemetry: DataFrame) -> DataFrame:
    known = telemetry.filter(F.col("service_name").isNotNull())
    return known.select("service_name").distinct().orderBy("service_name")


def mart_telemetry_summary(telemetry: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    failures = F.coalesce(F.sum("is_failure"), F.lit(0))
    return service_filter(telemetry, services).agg(
        F.count("*").alias("total_records"),
        failures.alias("failures"),
        F.avg("response_time_ms").alias("avg_latency"),
        F.count_distinct("service_name").alias("services"),
        F.count_distinct("trace_id").alias("traces"),
        numbers.percent(failures, F.count("*")).alias("error_rate"),
    )


def mart_hourly(telemetry: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    """Traffic per hour of day."""
    failures = F.coalesce(F.sum("is_failure"), F.lit(0))
    return (
        service_filter(telemetry, services)
        .filter(F.col("hour_of_day").isNotNull())
        .groupBy("hour_of_day")
        .agg(
            F.count("*").alias("requests"),
            failures.alias("failures"),
            (F.count("*") - failures).alias("successes"),
            numbers.percent(failures, F.count("*")).alias("error_rate_pct"),
        )
        .orderBy("hour_of_day")
    )


def mart_service_health(telemetry: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    failures = F.coalesce(F.sum("is_failure"), F.lit(0))
    health = (
        service_filter(telemetry, services)
        .groupBy("service_name")
        .agg(
            F.count("*").alias("requests"),
            failures.alias("failures"),
            F.avg("response_time_ms").alias("avg_latency_ms"),
            F.avg("cpu_usage_mcores").alias("avg_cpu_mcores"),
            F.avg("memory_usage_mb").alias("avg_memory_mb"),
            F.round(numbers.percent(failures, F.count("*")), 2).alias("error_rate_pct"),
        )
    )
    return _top(health, None, F.col("requests"), "service_name")


def top_failing_services(health: DataFrame, k: int = 12) -> DataFrame:
    return _top(health, k, F.col("failures"), "service_name")


def mart_worst_service(health: DataFrame) -> DataFrame:
    """The service with the highest error rate, and how it is rated."""
    exact = health.withColumn(
        "error_rate_pct", numbers.percent(F.col("failures"), F.col("requests"))
    )
    return _top(exact, 1, F.col("error_rate_pct"), "service_name").select(
        "service_name", "requests", "error_rate_pct",
        features.error_rate_status(F.col("error_rate_pct")).alias("status"),
    )


def rate_services(health: DataFrame) -> DataFrame:
    return health.select(
        "service_name", "error_rate_pct",
        features.error_rate_status(F.col("error_rate_pct")).alias("status"),
    )


def order_latency_bands(bands: DataFrame) -> DataFrame:
    return bands.orderBy(features.band_rank(F.col("latency_bucket")))


def mart_latency_distribution(telemetry: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    bands = (
        service_filter(telemetry, services)
        .filter(F.col("latency_bucket").isNotNull())
        .groupBy("latency_bucket")
        .agg(F.count("*").alias("requests"))
    )
    return order_latency_bands(bands)


def mart_error_categories(telemetry: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    counted = (
        service_filter(telemetry, services)
        .filter(F.col("error_category").isNotNull())
        .groupBy("error_category")
        .agg(F.count("*").alias("requests"))
    )
    return _top(counted, None, F.col("requests"), "error_category")


# ---- call graph and chains -------------------------------------------------


def mart_pairs(pairs: DataFrame, min_score: float = 0.0, k: int | None = None) -> DataFrame:
    strong = pairs.filter(F.col("propagation_score") >= min_score)
    return _top(strong, k, F.col("propagation_score"), "caller_service", "callee_service")


def mart_report_pairs(pairs: DataFrame, k: int = 10) -> DataFrame:
    spreading = pairs.filter(F.col("propagation_score") > 0)
    return _top(
        spreading, k, F.col("propagation_score"), "caller_service", "callee_service"
    ).select(
        "caller_service", "callee_service",
        F.round("propagation_score", 4).alias("score"),
        "call_count", "co_failure_count",
    )


def mart_strong_pairs(pairs: DataFrame, chains: DataFrame, min_score: float = 0.5) -> DataFrame:
    """One row: pairs, strong pairs, and cascades seen."""
    cascades = chains.agg(F.count("*")).scalar()
    return pairs.agg(
        F.count("*").alias("service_pairs"),
        F.count_if(F.col("propagation_score") >= min_score).alias("strong_pairs"),
    ).withColumn("cascades", cascades)


def mart_chain_paths(chains: DataFrame, k: int = 15) -> DataFrame:
    paths = chains.groupBy("source_service", "target_service").agg(
        F.count("*").alias("chain_count"), F.avg("propagation_lag_sec").alias("avg_lag_sec")
    )
    return _top(paths, k, F.col("chain_count"), "source_service", "target_service")


def mart_lag_profile(chains: DataFrame) -> DataFrame:
    """Chains per source and lag; whole-second lags keep this small."""
    return (
        chains.filter(F.col("propagation_lag_sec").isNotNull())
        .groupBy("source_service", "propagation_lag_sec")
        .agg(F.count("*").alias("chain_count"))
    )


def median_lag(chains: DataFrame) -> DataFrame:
    """Exact median lag. The aggregate keeps a count per distinct lag, at most window + 1 of them."""
    return chains.agg(F.median("propagation_lag_sec").alias("median_lag_sec"))


def mart_correlations(correlations: DataFrame, k: int = 15) -> DataFrame:
    return _top(correlations, k, F.abs("error_correlation"), "service_a", "service_b")


def top_axis(pairs: DataFrame, axis: str, k: int = 14) -> DataFrame:
    """The services with the highest score on one axis of the matrix."""
    best = pairs.groupBy(axis).agg(F.max("propagation_score").alias("_best"))
    return _top(best, k, F.col("_best"), axis).select(axis)


def mart_propagation_matrix(
    pairs: DataFrame, callers: Sequence[str], how: str = "max", k: int | None = None
) -> DataFrame:
    """Callee rows by caller columns, 0 where a pair is missing.

    `callers` names the columns, so the schema is known before the data is. With
    `k`, only the k highest-scoring callees and callers contribute.
    """
    kept = pairs
    if k is not None:
        for axis in ("callee_service", "caller_service"):
            # The broadcast side holds at most k names.
            kept = kept.join(F.broadcast(top_axis(pairs, axis, k)), axis, "left_semi")
    score = F.max("propagation_score") if how == "max" else F.avg("propagation_score")
    return (
        kept.groupBy("callee_service")
        .pivot("caller_service", list(callers))
        .agg(score)
        .fillna(0.0)
        .orderBy("callee_service")
    )


def mart_blast_radius(pairs: DataFrame, k: int = 10) -> DataFrame:
    """For every service, its k strongest downstream and upstream neighbours."""
    score = F.col("propagation_score")

    def side(direction: str, service: str, neighbour: str) -> DataFrame:
        order = Window.partitionBy(service).orderBy(score.desc(), neighbour)
        return (
            pairs.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k)
            .select(
                F.col(service).alias("service_name"),
                F.lit(direction).alias("direction"),
                F.col(neighbour).alias("neighbour"),
                "propagation_score",
                "rank",
            )
        )

    return side("downstream", "caller_service", "callee_service").unionByName(
        side("upstream", "callee_service", "caller_service")
    )


# ---- anomalies and patterns ------------------------------------------------


def _signals() -> list[Column]:
    renamed = {
        "error_signal": "is_anomaly_error",
        "latency_signal": "is_anomaly_latency",
        "resource_signal": "is_anomaly_resource",
    }
    return [F.coalesce(F.sum(c), F.lit(0)).alias(a) for a, c in renamed.items()]


def mart_anomaly_summary(anomalies: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    overall = F.coalesce(F.sum("is_anomaly_overall"), F.lit(0))
    return service_filter(anomalies, services).agg(
        F.count("*").alias("total_buckets"),
        overall.alias("overall"),
        *_signals(),
        numbers.percent(overall, F.count("*")).alias("anomaly_rate"),
    )


def mart_normal_vs_anomalous(anomalies: DataFrame) -> DataFrame:
    overall = F.coalesce(F.sum("is_anomaly_overall"), F.lit(0))
    rate = overall * F.lit(100.0) / F.greatest(F.count("*"), F.lit(1))
    return anomalies.agg(
        (F.count("*") - overall).alias("normal"),
        overall.alias("anomalous"),
        rate.alias("anomaly_rate_pct"),
    )


def mart_slo_breaches(anomalies: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    per_service = (
        service_filter(anomalies, services)
        .groupBy("service_name")
        .agg(
            F.sum("is_error_rate_slo_breach").alias("error_slo_breaches"),
            F.sum("is_latency_slo_breach").alias("latency_slo_breaches"),
            F.sum("is_anomaly_overall").alias("overall_anomalies"),
            F.count("*").alias("buckets"),
        )
    )
    return _top(per_service, None, F.col("overall_anomalies"), "service_name")


def top_slo_breaches(breaches: DataFrame, k: int = 12) -> DataFrame:
    total = F.col("error_slo_breaches") + F.col("latency_slo_breaches")
    hit = breaches.withColumn("slo_breaches", total).filter(F.col("slo_breaches") > 0)
    return _top(hit, k, F.col("slo_breaches"), "service_name")


def mart_anomalies_by_service(
    anomalies: DataFrame, services: Sequence[str] = (), k: int = 15
) -> DataFrame:
    counted = (
        service_filter(anomalies, services)
        .filter(F.col("is_anomaly_overall") == 1)
        .groupBy("service_name")
        .agg(F.count("*").alias("anomaly_count"))
    )
    return _top(counted, k, F.col("anomaly_count"), "service_name")


def mart_anomaly_timeline(anomalies: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    return (
        service_filter(anomalies, services)
        .groupBy("time_bucket")
        .agg(*_signals(), F.sum("is_anomaly_overall").alias("multi_signal"))
        .orderBy("time_bucket")
    )


def mart_top4_timeline(anomalies: DataFrame, k: int = 4) -> DataFrame:
    """Every bucket of the k services with the most anomalies."""
    # The broadcast side holds at most k names.
    worst = mart_anomalies_by_service(anomalies, k=k).select("service_name")
    return (
        anomalies.join(F.broadcast(worst), "service_name", "left_semi")
        .select("service_name", "time_bucket", "is_anomaly_overall", "anomaly_score")
        .orderBy("time_bucket", "service_name")
    )


def mart_signal_mix(anomalies: DataFrame) -> DataFrame:
    # Wording of the signals.
    return (
        anomalies.agg(*_signals())
        .select(
            F.col("error_signal").alias("Error rate"),
            F.col("latency_signal").alias("Latency"),
            F.col("resource_signal").alias("Resources"),
        )
        .unpivot([], ["Error rate", "Latency", "Resources"], "signal", "buckets")
    )


def mart_patterns(patterns: DataFrame, services: Sequence[str] = ()) -> DataFrame:
    """Occurrences per pattern; the severity is the plain mean over services."""
    totals = (
        service_filter(patterns, services)
        .groupBy("pattern_type")
        .agg(
            F.sum("occurrence_count").alias("occurrences"),
            F.avg("avg_severity").alias("avg_severity"),
        )
    )
    return _top(totals, None, F.col("occurrences"), "pattern_type")


def label_patterns(patterns: DataFrame) -> DataFrame:
    return patterns.withColumn("label", names.pattern_label(F.col("pattern_type")))


def mart_patterns_detail(
    patterns: DataFrame, services: Sequence[str] = (), k: int | None = None
) -> DataFrame:
    return _top(
        service_filter(patterns, services), k,
        F.col("occurrence_count"), "service_name", "pattern_type",
    )


def mart_exec_summary(
    telemetry: DataFrame, anomalies: DataFrame, pairs: DataFrame, runs: DataFrame
) -> DataFrame:
    """One row of headline numbers."""
    whole = telemetry.agg(
        F.count("*").alias("records"),
        F.round(numbers.percent(F.sum("is_failure"), F.count("*")), 2).alias("error_rate_pct"),
    )
    buckets = anomalies.agg(
        F.coalesce(F.sum("is_anomaly_overall"), F.lit(0)).alias("n"),
        F.round(numbers.percent(F.sum("is_anomaly_overall"), F.count("*")), 2).alias("pct"),
    )
    return whole.select(
        "records",
        buckets.select("n").scalar().alias("anomalies"),
        pairs.agg(F.count_if(F.col("propagation_score") > 0)).scalar().alias("propagation_pairs"),
        runs.agg(F.count_distinct("data_size")).scalar().alias("sizes_tested"),
        "error_rate_pct",
        buckets.select("pct").scalar().alias("anomaly_rate_pct"),
    )
