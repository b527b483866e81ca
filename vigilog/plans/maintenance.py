"""Upkeep of the tables: acknowledging, retention and compaction.

Rewrites keep all columns, leave other partitions alone and take effect in one step (see
``vigilog.sources.versions``); ``vacuum`` there deletes what they replaced.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.config import utc
from vigilog.functions.times import instant, is_zoneless
from vigilog.sources.tables import (
    INGEST_BATCH,
    INGEST_QUERY,
    LOG_BATCH,
    LOG_DATE,
    log_acknowledgements,
    replace_dates,
)
from vigilog.sources.versions import (
    MARK,
    VERSION,
    Item,
    commit,
    live_items,
    read_items,
    replace_items,
)

# What the folders of rewrites are called.
COMPACTED, RETAINED = "compacted", "retained"
#: Days or runs that may be broadcast to prune folders; beyond it the same join is shuffled.
FEW_FOLDERS = 20_000


def acknowledged(anomalies: DataFrame, ids: DataFrame, as_of: datetime) -> DataFrame:
    """Mark the anomalies whose id is in ``ids`` (a column ``anomaly_id``).

    The three columns are added where missing. Who acknowledged stays empty, and
    acknowledging again renews the time.
    """
    if "acknowledged" not in anomalies.columns:
        anomalies = anomalies.select(
            "*",
            F.lit(False).alias("acknowledged"),
            F.lit(None).cast("timestamp").alias("acknowledged_at"),
            F.lit(None).cast("string").alias("acknowledged_by"),
        )
    marks = ids.select("anomaly_id").distinct().withColumn("_hit", F.lit(True))
    hit = F.coalesce("_hit", F.lit(False))
    return (
        anomalies.join(marks, "anomaly_id", "left")
        .withColumn("acknowledged", F.when(hit, True).otherwise(F.col("acknowledged")))
        .withColumn(
            "acknowledged_at", F.when(hit, instant(as_of)).otherwise(F.col("acknowledged_at"))
        )
        .select(*anomalies.columns)
    )


def acknowledge(
    spark: SparkSession,
    table: str,
    ids: list[str] | DataFrame,
    as_of: datetime,
    by: str | None = None,
) -> None:
    """Acknowledge anomalies by id: entries in the table's log, no row is read or rewritten.

    ``ids`` is a list, or a DataFrame with a column ``anomaly_id`` where there are many. Ids
    that the table does not have change nothing.
    """
    if isinstance(ids, DataFrame):
        log_acknowledgements(ids, table, as_of, by)
    elif ids:
        wanted = spark.createDataFrame([(i,) for i in ids], "anomaly_id string")
        log_acknowledgements(wanted.coalesce(1), table, as_of, by)


def broadcast_few(keys: DataFrame) -> DataFrame:
    """Broadcast calendar days or runs, which prunes folders at run time, if they are few.

    Garbage in a time column can make days many; then it is an ordinary join.
    """
    return F.broadcast(keys) if keys.count() <= FEW_FOLDERS else keys


def expired(df: DataFrame, time_column: str, as_of: datetime, keep: timedelta):
    """Condition: strictly older than the retention period."""
    return F.col(time_column) < instant(utc(as_of) - keep, is_zoneless(df, time_column))


def retained(
    df: DataFrame, time_column: str, as_of: datetime, keep: timedelta = timedelta(days=90)
) -> DataFrame:
    """What a retention delete leaves. Rows without a time are not older than anything."""
    return df.filter(~F.coalesce(expired(df, time_column, as_of, keep), F.lit(False)))


def compacted(df: DataFrame, time_column: str, date_column: str = LOG_DATE) -> DataFrame:
    """Regroup rows by date into evenly sized parts.

    REBALANCE lets the adaptive planner merge small parts and split a date that holds
    far more rows than the others, so file sizes follow
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. Sorting by time inside each
    file gives range filters tight statistics to skip row groups with.
    """
    return df.hint("rebalance", date_column).sortWithinPartitions(date_column, time_column)


def compact_table(
    spark: SparkSession,
    source: str,
    target: str,
    dates: list | None = None,
    time_column: str = "log_timestamp",
    date_column: str = LOG_DATE,
) -> None:
    """Rewrite partitions of ``source`` with few large files into ``target``.

    ``target`` may be the same path: then the new folders replace exactly the items that were
    read, in one step. What streams add meanwhile stays, a failure leaves the table as it was, and
    replaced items stay on disk until ``vacuum``. Of a table that streams write, the newest batch of
    each stream is left as it is. Compacted runs of an anomalies table lose their names: a run that
    is repeated later adds only ids that the table does not have.
    """
    items = live_items(spark, source)
    open_ = open_batches(items)
    if dates is not None:
        wanted = {f"{date_column}={d}" for d in dates}
        items = [i for i in items if i.date in wanted]
    closed = [i for i in items if i.value not in open_]
    name = f"{COMPACTED}{MARK}{uuid.uuid4().hex}"
    column = second_column(items)
    rows = read_items(spark, source, closed)
    merged = None
    if rows is not None:
        merged = compacted(rows, time_column, date_column).withColumn(column, F.lit(name))
    if source == target:
        if merged is not None:
            replace_items(merged, target, closed, name, [date_column, column])
        return
    rest = read_items(spark, source, [i for i in items if i.value in open_])
    if merged is not None:
        copied = merged.drop(VERSION) if column == VERSION else merged.withColumn(column, F.lit(COMPACTED))
        folders = [date_column] if column == VERSION else [date_column, column]
        whole = copied if rest is None else copied.unionByName(rest, allowMissingColumns=True)
        replace_dates(whole, target, folders)
    elif rest is not None:
        replace_dates(rest, target, [date_column, column])


def second_column(items: list[Item]) -> str:
    """The partition column below the date, ``VERSION`` where a table has none of its own."""
    found = {i.leaf.partition("=")[0] for i in items if i.is_folder} - {VERSION}
    return found.pop() if found else VERSION


def open_batches(items: list[Item]) -> set[str]:
    """The newest batch of each stream, by the names of folders: only that may be repeated."""
    newest: dict[str, str] = {}
    for item in items:
        stream, dash, _ = item.value.rpartition("-")
        if item.leaf.startswith(f"{LOG_BATCH}=") and dash and MARK not in item.value:
            newest[stream] = max(newest.get(stream, ""), item.value)
    return set(newest.values())


def newest_batches(table: DataFrame) -> dict[str, int]:
    """Last batch of each stream that wrote into a table: one number a stream."""
    found = table.groupBy(INGEST_QUERY).agg(F.max(INGEST_BATCH).alias("n")).collect()
    return {r[INGEST_QUERY]: r["n"] for r in found if r[INGEST_QUERY] is not None}


def apply_retention(
    spark: SparkSession,
    table: str,
    as_of: datetime,
    keep: timedelta = timedelta(days=90),
    time_column: str = "log_timestamp",
    date_column: str = LOG_DATE,
) -> list[str]:
    """Delete old rows in place, all in one step; returns the dates that were dropped whole.

    Dates are days in UTC. Expired days are dropped without reading a row, and only the day the
    limit falls into is rewritten. A batch that a stream adds meanwhile stays until the next time.
    What was dropped is off the table at once and off the disk after ``vacuum``.
    """
    limit = utc(as_of) - keep
    day = f"{date_column}={limit.date().isoformat()}"
    items = live_items(spark, table)
    dated = [i for i in items if i.date.startswith(f"{date_column}=")]
    gone = [i for i in dated if i.date < day]
    boundary = [i for i in dated if i.date == day]
    dropped = {i.date for i in gone}
    rows = read_items(spark, table, boundary)
    if rows is not None and not rows.filter(expired(rows, time_column, as_of, keep)).isEmpty():
        column, name = second_column(items), f"{RETAINED}{MARK}{uuid.uuid4().hex}"
        kept = compacted(retained(rows, time_column, as_of, keep), time_column, date_column)
        kept = kept.withColumn(column, F.lit(name))
        if not replace_items(kept, table, [*gone, *boundary], name, [date_column, column]):
            dropped.add(day)
    elif gone:
        commit(spark, table, [], gone)
    return sorted(date.partition("=")[2] for date in dropped)
