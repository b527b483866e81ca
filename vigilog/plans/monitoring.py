"""Monitors: which metrics are kept for which table, and how they are refreshed."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.config import FEEDS
from vigilog.functions.times import instant, utc_date, utc_day
from vigilog.operators.profiles import (
    Metric,
    distinct,
    maximum,
    mean,
    merged_state,
    percentile,
    profile,
    profile_from_state,
    profile_state,
    total,
)
from vigilog.plans.maintenance import broadcast_few, newest_batches
from vigilog.session import Files, materialize, scratch
from vigilog.sources.tables import INGEST_BATCH, INGEST_QUERY, LOG_DATE, replace_dates, scan
from vigilog.sources.versions import (
    MARK,
    begin,
    commit,
    live_items,
    read_items,
    read_state,
    replace_items,
)

WINDOW_DATE = "window_date"


@dataclass(frozen=True)
class Monitor:
    time_column: str
    slices: tuple[str, ...]
    metrics: tuple[Metric, ...]
    refresh_every: str


# The custom metrics of each monitored table.
AUDIT_MONITOR = Monitor(
    "log_timestamp",
    ("transaction_name", "cluster"),
    (
        mean("hourly_failure_rate", "is_failure"),
        mean("avg_response_time_ms", "response_time_ms"),
        percentile("p95_response_time_ms", "response_time_ms", 0.95),
        total(
            "high_response_time_count", "case when response_time_ms > 30000 then 1 else 0 end"
        ),
        distinct("unique_services", "transaction_name"),
        mean("error_rate", "is_error"),
    ),
    "6 hours",
)
TRACK_MDC_MONITOR = Monitor(
    "log_timestamp",
    ("service", "cluster"),
    (
        mean("timeout_rate", "is_timeout"),
        mean("avg_total_elapsed_ms", "total_elapsed_ms"),
        mean("incomplete_trails_rate", "has_incomplete_trails"),
        mean("high_response_rate", "is_high_response_time"),
    ),
    "6 hours",
)
# Tracking tables hold the response time as total_elapsed_ms; very high means over 60 s.
TRACK_CTX_MONITOR = Monitor(
    "log_timestamp",
    ("service", "cluster", "application"),
    (
        mean("avg_response_time_ms", "total_elapsed_ms"),
        maximum("max_response_time_ms", "total_elapsed_ms"),
        mean("incomplete_operations_rate", "has_incomplete_trails"),
        mean("very_high_response_rate", "total_elapsed_ms > 60000"),
        mean("avg_trail_marks_count", "trail_marks_count"),
    ),
    "6 hours",
)
ANOMALY_MONITOR = Monitor(
    "detected_at",
    ("anomaly_type", "severity", "affected_service"),
    (
        mean("critical_anomaly_rate", "case when severity = 'CRITICAL' then 1.0 else 0.0 end"),
        mean("high_anomaly_rate", "case when severity = 'HIGH' then 1.0 else 0.0 end"),
        distinct("unique_anomaly_types", "anomaly_type"),
        mean("avg_metric_value", "metric_value"),
        mean("avg_threshold_breach_ratio", "metric_value / nullif(threshold_value, 0)"),
    ),
    "1 hour",
)


def run_monitor(df: DataFrame, monitor: Monitor) -> DataFrame:
    return profile(df, monitor.time_column, list(monitor.metrics), list(monitor.slices))


def family_logs(logs: Mapping[str, DataFrame], family: str) -> DataFrame:
    """The feeds of a family as one table, with the key of the feed as ``log_type``.

    Columns that only some of the feeds have are null in the others.
    """
    own = [df.withColumn("log_type", F.lit(k)) for k, df in logs.items() if FEEDS[k].family == family]
    if not own:
        raise ValueError(f"none of the given logs belongs to {family}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), own)


def _with_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn(WINDOW_DATE, utc_day(F.col("window.start")))


def _marks_path(path: str) -> str:
    """Inside the table, below a name that scans skip."""
    return f"{path.rstrip('/')}/_marks"


def read_marks(spark: SparkSession, path: str) -> dict[str, int]:
    """The last batch of each stream that a profile table has seen."""
    folders = Files(spark, path).folders(_marks_path(path))
    if not folders:
        return {}
    rows = spark.read.parquet(f"{_marks_path(path)}/{folders[-1]}").collect()
    return {r["stream"]: r["batch"] for r in rows}


def _write_marks(spark: SparkSession, path: str, marks: dict[str, int]) -> None:
    files = Files(spark, path)
    old = files.folders(_marks_path(path))
    number = int(old[-1]) + 1 if old else 0
    rows = spark.createDataFrame(sorted(marks.items()), "stream string, batch bigint")
    rows.coalesce(1).write.parquet(f"{_marks_path(path)}/{number:012d}")
    for name in old:
        files.delete(f"{_marks_path(path)}/{name}")


def create_profile_table(df: DataFrame, monitor: Monitor, path: str) -> None:
    """The first, complete refresh. Of an ingested table it notes the batches it has seen."""
    marks = newest_batches(df) if INGEST_BATCH in df.columns else None
    store_profile(run_monitor(df, monitor), path)
    if marks:
        _write_marks(df.sparkSession, path, marks)


def store_profile(rows: DataFrame, path: str) -> None:
    """Replace the days of a profile table that occur in ``rows``."""
    replace_dates(_with_date(rows), path, [WINDOW_DATE])


def refresh_profile_table(
    df: DataFrame, monitor: Monitor, path: str, since: datetime | None = None
) -> None:
    """Recompute only the days (in UTC) that received rows since the last refresh.

    What is new is told by the batches that the table has not seen: a batch that began before
    the last refresh and was committed after it is new. For a table without batches ``since``
    says from which ingestion time on rows are new.

    Late rows may belong to any day, so the touched days are looked up, and all rows of
    these days are read again. Days hold whole windows of every granularity. Only their
    partitions of the profile are replaced. Parquet statistics of the batch (or the ingestion
    time) skip files without new rows.
    """
    marks = None
    if since is not None:
        new = F.col("ingestion_timestamp") > instant(since)
    else:
        seen, marks = read_marks(df.sparkSession, path), newest_batches(df)
        new = F.lit(False)
        for stream, last in marks.items():
            batch = F.col(INGEST_BATCH)
            later = (batch > seen.get(stream, -1)) & (batch <= last)
            new = new | ((F.col(INGEST_QUERY) == stream) & later)
    day = utc_date(df, monitor.time_column)
    touched = df.filter(new).select(day.alias("touched")).distinct()
    own_date = F.col(LOG_DATE) if LOG_DATE in df.columns else day
    stale = df.join(broadcast_few(touched), own_date == F.col("touched"), "left_semi")
    store_profile(run_monitor(stale, monitor), path)
    if marks:
        _write_marks(df.sparkSession, path, marks)


# --- refresh from a stored state -----------------------------------------------------

STATE_DATE, STATE_PART = "state_date", "state_part"


def _state_path(path: str) -> str:
    """Inside the table, below a name that scans skip."""
    return f"{path.rstrip('/')}/_state"


def unseen_rows(spark: SparkSession, table: str, notes: dict) -> tuple[DataFrame | None, list[str]]:
    """The rows of batches that ``notes`` have not seen, and the rewritten folders there are now.

    Only folders of newer batches are read, and folders that a rewrite made since, which
    may hold batches that were merged before anybody saw them: of these the newer batches' rows.
    """
    marks, seen = notes.get("marks", {}), set(notes.get("folders", []))
    fresh, rewritten = [], []
    for item in live_items(spark, table):
        if MARK in item.leaf:
            rewritten.append(item.path)
            if item.path not in seen:
                fresh.append(item)
            continue
        stream, _, number = item.value.rpartition("-")
        if int(number) > marks.get(stream, -1):
            fresh.append(item)
    rows = read_items(spark, table, fresh)
    if rows is None:
        return None, rewritten
    old = F.lit(False)
    for stream, last in marks.items():
        old = old | ((F.col(INGEST_QUERY) == stream) & (F.col(INGEST_BATCH) <= last))
    return rows.filter(~F.coalesce(old, F.lit(False))), rewritten


def refresh_from_state(spark: SparkSession, table: str, monitor: Monitor, path: str) -> list[str]:
    """Bring a profile table up to date with an ingested ``table``; returns the days it renewed.

    Beside the profile stands its state: partial sums, counts, maxima and counts of values for each
    hour and combination of slices. Rows of new batches are reduced to such a state and merged with
    the stored one of the days they belong to, and these days' profile is made from the state. No
    batch is read twice, however old the days are that late rows belong to. The first refresh
    reads everything.

    The state switches versions together with the notes of what it has seen, so a failure neither
    loses a batch nor counts one twice; days whose profile was not stored any more are renewed by
    the next refresh. What retention takes from the log table stays in the profile. One refresh of a
    table runs at a time; a second one fails with ``Conflict``. Its intermediate copies are deleted.
    """
    with scratch(spark):
        return _refreshed(spark, table, monitor, path)


def _refreshed(spark: SparkSession, table: str, monitor: Monitor, path: str) -> list[str]:
    store, metrics, slices = _state_path(path), list(monitor.metrics), list(monitor.slices)
    before = begin(spark, store)
    rows, rewritten = unseen_rows(spark, table, before.notes)
    days = set(before.notes.get("stale", []))
    if rows is not None:
        new = profile_state(rows, monitor.time_column, metrics, slices)
        new = materialize(new.withColumn(STATE_DATE, utc_day(F.col("_moment"))), "state")
        marks = dict(before.notes.get("marks", {}))
        found = rows.groupBy(INGEST_QUERY).agg(F.max(INGEST_BATCH).alias("n")).collect()
        marks |= {r[INGEST_QUERY]: r["n"] for r in found if r[INGEST_QUERY] is not None}
        touched = {str(r[0]) for r in new.select(STATE_DATE).distinct().collect()}
        days |= touched
        stored = [i for i in live_items(spark, store, before) if i.date.partition("=")[2] in touched]
        known = read_items(spark, store, stored)
        both = new if known is None else new.unionByName(known.drop(STATE_PART), allowMissingColumns=True)
        merged = merged_state(both, [*metrics], [STATE_DATE, *slices])
        name = f"refresh{MARK}{uuid.uuid4().hex}"
        notes = {"marks": marks, "folders": rewritten, "stale": sorted(days)}
        replace_items(
            merged.withColumn(STATE_PART, F.lit(name)), store, stored, name, [STATE_DATE, STATE_PART],
            on=before, notes=notes,
        )
    if not days:
        return []
    now = read_state(spark, store)
    current = read_items(spark, store, [i for i in live_items(spark, store, now) if i.date.partition("=")[2] in days])
    if current is not None:
        store_profile(profile_from_state(current, metrics, slices, keep=materialize), path)
    commit(spark, store, [], [], on=now, notes=now.notes | {"stale": []})
    return sorted(days)


def read_profile_table(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path)
