"""Rows → counters per time range: the shared input of four baseline detectors.

Current window and baseline are told apart by a flag per row, so one scan and one
aggregation give both sides of every comparison; nothing is joined. A row on the edge
of both ranges counts in both.

The counters add up. Detectors take either the per-row counters of ``row_counters`` or
the pre-summed ones of ``counter_rollup`` and give the same answer.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.config import ALL_FAMILIES, DetectorConfig, TimeWindows
from vigilog.functions import times
from vigilog.operators.unified_logs import unified_logs

COUNTERS = (
    "current_rows",
    "current_failures",
    "current_timed",
    "current_elapsed",
    "baseline_rows",
    "baseline_failures",
    "baseline_timed",
    "baseline_elapsed",
    "heartbeat_rows",
)
ENTITY_KEYS = ["log_type", "is_audit", "service", "instance_name", "cluster"]
BUCKET_KEYS = ["log_type", "is_audit", "service", "time_bucket"]


def sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def row_counters(
    logs: Mapping[str, DataFrame],
    config: DetectorConfig,
    windows: TimeWindows,
    families: frozenset[str] = ALL_FAMILIES,
) -> DataFrame:
    rows = unified_logs(logs, [windows.medium, windows.baseline, windows.heartbeat], families)
    current = times.within(rows, "log_timestamp", windows.medium)
    baseline = times.within(rows, "log_timestamp", windows.baseline)
    heartbeat = times.within(rows, "log_timestamp", windows.heartbeat)
    failed = F.coalesce("is_failure", F.lit(False))
    timed = F.col("elapsed_ms").isNotNull()
    elapsed = F.coalesce("elapsed_ms", F.lit(0)).cast("double")

    def ones(condition: Column) -> Column:
        return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")

    return rows.select(
        *ENTITY_KEYS,
        times.bucket(F.col("log_timestamp"), config.bucket_seconds).alias("time_bucket"),
        ones(current).alias("current_rows"),
        ones(current & failed).alias("current_failures"),
        ones(current & timed).alias("current_timed"),
        F.when(current, elapsed).otherwise(F.lit(0.0)).alias("current_elapsed"),
        ones(baseline).alias("baseline_rows"),
        ones(baseline & failed).alias("baseline_failures"),
        ones(baseline & timed).alias("baseline_timed"),
        F.when(baseline, elapsed).otherwise(F.lit(0.0)).alias("baseline_elapsed"),
        ones(heartbeat).alias("heartbeat_rows"),
    )


def counter_rollup(counters: DataFrame) -> DataFrame:
    """One aggregation at the two grains the detectors need.

    ``by_entity`` rows sum over time; the others sum over instances and clusters but keep
    the time bucket. Keeping both keys at once would hardly reduce the rows where
    instances are many.
    """
    keys = [*ENTITY_KEYS, "time_bucket"]
    return counters.groupingSets([ENTITY_KEYS, BUCKET_KEYS], *keys).agg(
        (F.grouping("time_bucket") == 1).alias("by_entity"), *sums(*COUNTERS)
    )
