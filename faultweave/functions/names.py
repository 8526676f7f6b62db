"""Names, lookups and text parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the two trailing segments a replica set adds to a service name.
REPLICA_SUFFIX = r"-[^-]+-[^-]+$"

# Fixed value: a capture-date directory inside a file path.
CAPTURE_DATE = r"/(\d{4}-\d{2}-\d{2})/"

# Wording shown for each failure pattern.
PATTERN_LABELS = {
    "full_failure": "Full failure (all three signals)",
    "cascading_failure": "Cascading failure (errors + latency)",
    "resource_exhaustion": "Resource exhaustion (latency + resources)",
    "error_resource_link": "Error/resource link",
    "error_surge": "Error surge",
    "latency_spike": "Latency spike",
    "resource_pressure": "Resource pressure",
}

# Log line layout, level aliases and level order.
LOG_LINE = (
    r"^(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}\.\d{3})\s+"
    r"\[(DEBUG|INFO|WARN|WARNING|ERROR|CRIT|CRITICAL)\s*\]\s+(.*)"
)
LEVEL_ALIASES = {"WARN": "WARNING", "CRIT": "CRITICAL"}
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


def service_from_pod(pod: Column) -> Column:
    return F.regexp_replace(pod, REPLICA_SUFFIX, "")


def capture_date(path: Column) -> Column:
    return F.regexp_extract(path, CAPTURE_DATE, 1)


def capture_root(path: Column, fault_root: str) -> Column:
    return F.when(path.contains(fault_root), "fault").otherwise("baseline")


def lookup(key: Column, mapping: Mapping[str, str], default: Column) -> Column:
    """``mapping[key]``, or `default` where the key is unknown or NULL."""
    if not mapping:
        return default
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)


def namespace_of(date: Column, namespaces: Mapping[str, str]) -> Column:
    return lookup(date, namespaces, F.lit("unknown"))


def pattern_label(pattern: Column) -> Column:
    return lookup(pattern, PATTERN_LABELS, pattern)


def in_services(column: Column, services: Sequence[str]) -> Column:
    """Membership test in which an empty selection means "no filter"."""
    return column.isin(list(services)) if services else F.lit(True)


def log_level(line: Column) -> Column:
    """Normalised level of a log line, NULL where the line does not parse."""
    found = F.nullif(F.regexp_extract(line, LOG_LINE, 2), F.lit(""))
    return lookup(found, LEVEL_ALIASES, found)


def level_rank(level: Column) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in LEVELS]), level).cast("int") - 1


def hashed_one_in(key: Column, modulus: int) -> Column:
    """True for about one key in `modulus`, whatever the partitioning."""
    digest = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return digest % modulus == 0
