"""Derived span, bucket and run attributes.

Every builder sends NULL to its last branch: a NULL status is a success and a
NULL latency is in the slowest band.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latency bands, fastest first; their bounds in ms are 100, 500 and 2000.
BAND_ORDER = ("low", "medium", "high", "critical")

# Error-rate budget, in percent, and its status.
ERROR_BUDGET = ((1, "good"), (5, "warning"), (15, "serious"))

# Lower bound of scaling efficiency, status and wording.
EFFICIENCY_BANDS = (
    (0.9, "good", "near-linear scaling"),
    (0.7, "warning", "sub-linear, acceptable"),
    (0.5, "serious", "overhead dominating"),
)


def is_failure(status: Column) -> Column:
    return F.when(status >= 500, 1).otherwise(0)


def is_latency_spike(response_ms: Column) -> Column:
    return F.when(response_ms > 2000, 1).otherwise(0)


def latency_bucket(response_ms: Column) -> Column:
    return (
        F.when(response_ms < 100, "low")
        .when(response_ms < 500, "medium")
        .when(response_ms < 2000, "high")
        .otherwise("critical")
    )


def band_rank(band: Column) -> Column:
    """Ordinal of a latency band, for sorting."""
    return F.array_position(F.array(*[F.lit(b) for b in BAND_ORDER]), band)


def error_category(status: Column) -> Column:
    return (
        F.when(status >= 500, "server_error").when(status >= 400, "client_error").otherwise("success")
    )


def cpu_memory_ratio(cpu: Column, memory: Column) -> Column:
    return F.when(memory > 0, cpu / memory).otherwise(F.lit(0.0))


def is_degraded(self_time: Column, ceiling: Column) -> Column:
    """Strictly slower than a known ceiling."""
    return F.when(self_time > ceiling, 1).otherwise(0)


def error_rate_status(percent: Column) -> Column:
    ladder = F.when(percent.isNull(), "neutral")
    for bound, status in ERROR_BUDGET:
        ladder = ladder.when(percent < bound, status)
    return ladder.otherwise("critical")


def pattern_type(error: Column, latency: Column, resource: Column) -> Column:
    """Name of the combination of signals that fired."""
    e, l, r = error == 1, latency == 1, resource == 1
    # The names of the combinations.
    return (
        F.when(e & l & r, "full_failure")
        .when(e & l, "cascading_failure")
        .when(l & r, "resource_exhaustion")
        .when(e & r, "error_resource_link")
        .when(e, "error_surge")
        .when(l, "latency_spike")
        .when(r, "resource_pressure")
        .otherwise("normal")
    )


def scaling_class(efficiency: Column) -> Column:
    return (
        F.when(efficiency < 0.8, "sub-linear")
        .when(efficiency < 1.1, "near-linear")
        .otherwise("super-linear")
    )


def efficiency_status(efficiency: Column) -> Column:
    ladder = F.when(efficiency > 1.1, "good")
    for bound, status, _ in EFFICIENCY_BANDS:
        ladder = ladder.when(efficiency >= bound, status)
    return ladder.otherwise("critical")


def efficiency_note(efficiency: Column) -> Column:
    ladder = F.when(efficiency > 1.1, "super-linear - overhead amortised")
    for bound, _, note in EFFICIENCY_BANDS:
        ladder = ladder.when(efficiency >= bound, note)
    return ladder.otherwise("scaling has broken down")
