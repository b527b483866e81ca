"""Continuous ingestion: JSON-lines feed → normalised, date-partitioned log table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilog.config import FEEDS
from vigilog.operators.normalize import normalize
from vigilog.schemas import CORRUPT
from vigilog.sources.json_feeds import is_corrupt_line, stream_feed
from vigilog.sources.tables import INGEST_BATCH, INGEST_QUERY, LOG_BATCH, LOG_DATE, batch_name

# Trigger interval and rate limit.
TRIGGER = "10 seconds"
MAX_FILES = 10


def start_ingest(
    spark: SparkSession,
    feed: str,
    source: str,
    table: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    max_files: int = MAX_FILES,
    rescue: bool = False,
) -> StreamingQuery:
    """Append a feed to its log table.

    Rows of a micro-batch are shuffled once, to write few files. Each batch writes a folder of its own below each date,
    named by the stream's id (kept in its checkpoint) and the batch's number, so a batch that
    is repeated after a failure replaces itself. The table keeps no log of its files: it can be
    compacted, trimmed and read like any other. ``trigger=None`` takes everything that is there,
    in batches of ``max_files``, and stops.

    Lines that are not JSON keep their text in the corrupt column. They have no time, so
    they land in the partition without a date, which no time range ever reads; see
    ``quarantined``. With ``rescue`` fields that a feed adds are kept in a map; a table may begin to
    have that column at any time.
    """
    family = FEEDS[feed].family
    rows = normalize(stream_feed(spark, family, source, max_files, rescue), family)

    def save(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        save_batch(batch, table, stream, number)

    writer = (
        rows.writeStream.queryName(f"ingest_{feed}")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def save_batch(batch: DataFrame, table: str, stream: str, number: int) -> None:
    """Write one batch; the same batch again replaces its rows.

    Rows are gathered by date first, or every task would write a file for every date. REBALANCE
    merges small dates' parts and splits a date that holds most of the batch.
    """
    tagged = batch.withColumns(
        {
            INGEST_QUERY: F.lit(stream),
            INGEST_BATCH: F.lit(number).cast("bigint"),
            LOG_BATCH: F.lit(batch_name(stream, number)),
        }
    )
    (
        tagged.hint("rebalance", LOG_DATE)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LOG_DATE, LOG_BATCH)
        .parquet(table)
    )


def quarantined(table: DataFrame, family: str) -> DataFrame:
    """Lines of a log table that could not be read."""
    return table.filter(F.col(LOG_DATE).isNull() & is_corrupt_line(family)).select(
        "ingestion_timestamp", F.col(CORRUPT).alias("line")
    )
