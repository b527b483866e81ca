"""Date-partitioned Parquet tables.

A table has one folder per date, and below it either files or one folder per batch of an
ingestion (``log_batch``). Columns may be added from one write to the next: a scan merges the
schemas of all files, and no rewrite may lose a column. Rewrites switch versions (see
``vigilog.sources.versions``), so a table is read by ``scan``.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.config import utc
from vigilog.functions.times import instant, utc_date
from vigilog.schemas import ACKNOWLEDGEMENT, ANOMALIES
from vigilog.session import Files
from vigilog.sources.versions import (
    MARK,
    Conflict,
    Item,
    begin,
    live_items,
    read_items,
    read_live,
    replace_items,
)

LOG_DATE = "log_date"
DETECTED_DATE = "detected_date"
#: Partition of a batch, and which batch of which stream a row came with.
LOG_BATCH = "log_batch"
INGEST_QUERY, INGEST_BATCH = "ingest_query", "ingest_batch"
RUN = "detection_run"
#: Log of acknowledgements, below a name that scans skip.
ACKNOWLEDGED = "_acknowledgements"
SAVE_TRIES = 5


def batch_name(stream: str, number: int) -> str:
    return f"{stream}-{number:012d}"


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch scan with the columns of all files; a declared schema spares reading footers."""
    return read_live(spark, path, schema)


def replace_dates(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Overwrite only the partitions that occur in ``df``; others stay untouched.

    Dynamic partition overwrite stages its files first and swaps directories when the
    job commits, so ``df`` may itself be read from ``path``. A frame without one of the
    table's columns is refused.
    """
    spark = df.sparkSession
    if any("=" in name for name in Files(spark, path).folders(path)):
        lost = [c for c in scan(spark, path).columns if c not in df.columns]
        if lost:
            raise ValueError(f"rewriting {path} would lose the columns {lost}")
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _tagged(anomalies: DataFrame, run: str) -> DataFrame:
    return anomalies.withColumns({DETECTED_DATE: utc_date(anomalies, "detected_at"), RUN: F.lit(run)})


def append_anomalies(anomalies: DataFrame, path: str, run: str | None = None) -> None:
    """Add the rows of a detection run, one folder per detection date and run.

    A run that is named replaces its own earlier rows, all at once; one without a name only adds.
    """
    if run is None:
        rows = _tagged(anomalies, f"run-{uuid.uuid4().hex}")
        rows.write.mode("append").partitionBy(DETECTED_DATE, RUN).parquet(path)
        return
    name = f"{run}{MARK}{uuid.uuid4().hex}"
    own = [i for i in live_items(anomalies.sparkSession, path) if of_run(i, run)]
    replace_items(_tagged(anomalies, name), path, own, name, [DETECTED_DATE, RUN])


def of_run(item: Item, run: str) -> bool:
    return item.value.partition(MARK)[0] == run


def save_anomalies(anomalies: DataFrame, path: str, run: str, as_of: datetime) -> None:
    """Save a named run of one instant: it replaces its own earlier rows, and of its anomalies
    that other runs of the day have saved none is added again, so an id is in the table once.

    Runs that save at the same time check again: only one of them commits on a state.
    """
    spark, date = anomalies.sparkSession, f"{DETECTED_DATE}={utc(as_of).date()}"
    for _ in range(SAVE_TRIES):
        state = begin(spark, path)
        items = live_items(spark, path, state)
        others = [i for i in items if i.date == date and not of_run(i, run)]
        known = read_items(spark, path, others)
        rows = anomalies
        if known is not None:
            rows = anomalies.join(known.select("anomaly_id"), "anomaly_id", "left_anti")
            rows = rows.select(*anomalies.columns)
        name = f"{run}{MARK}{uuid.uuid4().hex}"
        own = [i for i in items if of_run(i, run)]
        try:
            replace_items(_tagged(rows, name), path, own, name, [DETECTED_DATE, RUN], on=state)
            return
        except Conflict:
            continue
    raise Conflict(f"{path} was rewritten during each of {SAVE_TRIES} tries to save {run}")


def log_acknowledgements(ids: DataFrame, path: str, as_of: datetime, by: str | None) -> None:
    """Note that the anomalies in ``ids`` (a column ``anomaly_id``) were acknowledged; only adds."""
    marks = ids.select("anomaly_id").distinct().select(
        "anomaly_id", instant(as_of).alias("acknowledged_at"), F.lit(by).cast("string").alias("acknowledged_by")
    )
    marks.write.mode("append").parquet(f"{path}/{ACKNOWLEDGED}")


def read_anomalies(spark: SparkSession, path: str, declared: bool = False) -> DataFrame:
    """All columns of all files; known ones that no file has yet are null.

    ``declared`` reads the known columns only and no footers. Whether an anomaly is acknowledged
    comes from the log beside the table, where the latest entry of an id counts, whatever was
    rewritten or run again since. What files from before the log say counts where the log has none.
    """
    schema = None
    if declared:
        folders = [T.StructField(DETECTED_DATE, T.DateType()), T.StructField(RUN, T.StringType())]
        schema = T.StructType([*ANOMALIES.fields, *ACKNOWLEDGEMENT.fields, *folders])
    table = scan(spark, path, schema)
    for known in [*ANOMALIES.fields, *ACKNOWLEDGEMENT.fields]:
        if known.name not in table.columns:
            table = table.withColumn(known.name, F.lit(None).cast(known.dataType))
    table = table.withColumn("acknowledged", F.coalesce("acknowledged", F.lit(False)))
    if not Files(spark, path).exists(f"{path}/{ACKNOWLEDGED}"):
        return table
    log = T.StructType([ANOMALIES["anomaly_id"], *ACKNOWLEDGEMENT.fields[1:]])
    latest = spark.read.schema(log).parquet(f"{path}/{ACKNOWLEDGED}").groupBy("anomaly_id")
    latest = latest.agg(
        F.max("acknowledged_at").alias("_at"), F.max_by("acknowledged_by", "acknowledged_at").alias("_by")
    )
    noted = F.col("_at").isNotNull()
    return (
        table.join(latest, "anomaly_id", "left")
        .withColumns(
            {
                "acknowledged": noted | F.col("acknowledged"),
                "acknowledged_at": F.coalesce("_at", "acknowledged_at"),
                "acknowledged_by": F.when(noted, F.col("_by")).otherwise(F.col("acknowledged_by")),
            }
        )
        .select(*table.columns)
    )
