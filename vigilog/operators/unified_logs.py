"""The log tables as one relation with common columns.

Detectors group by ``log_type`` instead of looping over tables: one job covers all.
Columns a detector does not use are pruned through the union down to each scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.config import ALL_FAMILIES, AUDIT, FEEDS, Span
from vigilog.functions import text, times
from vigilog.sources.tables import LOG_DATE


def _common(df: DataFrame, key: str) -> DataFrame:
    """Audit rows are served by their transaction and know no trails."""
    audit = FEEDS[key].family == AUDIT
    service = F.col("transaction_name") if audit else F.col("service")
    elapsed = F.col("response_time_ms") if audit else F.col("total_elapsed_ms")
    failure = F.col("is_failure") if audit else F.lit(None).cast("boolean")
    incomplete = F.lit(None).cast("boolean") if audit else F.col("has_incomplete_trails")
    return df.select(
        F.lit(key).alias("log_type"),
        F.lit(audit).alias("is_audit"),
        service.alias("service"),
        F.col("instance_name"),
        F.col("cluster"),
        F.col("log_timestamp"),
        failure.alias("is_failure"),
        elapsed.cast("bigint").alias("elapsed_ms"),
        incomplete.alias("has_incomplete_trails"),
    )


def unified_logs(
    logs: Mapping[str, DataFrame],
    spans: list[Span],
    families: frozenset[str] = ALL_FAMILIES,
) -> DataFrame:
    """Rows of the given feeds inside at least one span.

    Feeds that are absent from ``logs`` are skipped; an unknown key is an error.
    """
    unknown = sorted(set(logs) - set(FEEDS))
    if unknown:
        raise KeyError(f"unknown log types: {unknown}")
    parts = [
        _common(times.in_any(logs[key], "log_timestamp", spans, LOG_DATE), key)
        for key in FEEDS
        if key in logs and FEEDS[key].family in families
    ]
    if not parts:
        raise ValueError("none of the given log types belongs to this detector")
    return reduce(DataFrame.unionByName, parts)


def table_name(log_type: Column) -> Column:
    return text.constant_map({key: feed.table for key, feed in FEEDS.items()}, log_type)
