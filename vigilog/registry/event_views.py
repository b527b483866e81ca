"""Log-shaped views over an ``events`` table, with deterministic anomalies.

``events`` is uniform in time, so nothing in it looks unusual. The views replay it with
a few services disturbed during one window: one repeats its rows, one loses most of
them, one slows down, two fail more often.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.config import Span
from vigilog.functions.times import instant, is_zoneless

# The disturbed window (start excluded, end included).
DISTURBED = Span(datetime(2024, 1, 26), datetime(2024, 1, 29))


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame, parts: int) -> DataFrame:
    """The same rows in parts for all cores, for what costs many times their shuffle.

    A file is read by as many tasks as it has row groups, which may be one.
    """
    return events.repartition(max(parts, events.sparkSession.sparkContext.defaultParallelism), "event_id")


def log_events(events: DataFrame) -> DataFrame:
    zoneless = is_zoneless(events, "ts")
    kind = F.col("event_type")
    disturbed = (F.col("ts") > instant(DISTURBED.start, zoneless)) & (
        F.col("ts") <= instant(DISTURBED.end, zoneless)
    )
    base = events.select(
        "event_id",
        F.col("ts").alias("log_timestamp"),
        F.concat(F.lit("svc_"), (F.col("user_id") % 5).cast("string")).alias("svc"),
        F.concat(F.lit("inst_"), F.col("user_id").cast("string")).alias("inst"),
        F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("cluster"),
        "event_type",
        disturbed.alias("disturbed"),
        F.floor(F.col("value") * 200).cast("bigint").alias("ms"),
    )

    def hit(service: str) -> Column:
        return F.col("disturbed") & (F.col("svc") == service)

    copies = F.when(hit("svc_0"), F.sequence(F.lit(0), F.lit(4))).otherwise(F.array(F.lit(0)))
    failed = (
        F.when(hit("svc_3"), kind.isin("error", "click", "view"))
        .when(F.col("svc") == "svc_2", F.col("disturbed") & (kind == "error"))
        .otherwise(kind == "error")
    )
    return (
        base.filter(~(hit("svc_4") & (F.col("event_id") % 5 != 0)))
        .withColumn("copy", F.explode(copies))
        .select(
            (F.col("event_id") * 10 + F.col("copy")).alias("log_id"),
            "event_id",
            "log_timestamp",
            "svc",
            "inst",
            "cluster",
            "event_type",
            failed.alias("is_failure"),
            F.when(hit("svc_1"), F.col("ms") * 5).otherwise(F.col("ms")).alias("ms"),
            ((kind == "signup") & (F.col("event_id") % 2 == 0)).alias("has_incomplete"),
        )
    )


def audit_logs(events: DataFrame) -> DataFrame:
    """The view with the column names of an audit log table."""
    return log_events(events).select(
        "log_id",
        "log_timestamp",
        F.col("svc").alias("transaction_name"),
        F.col("inst").alias("instance_name"),
        "cluster",
        "is_failure",
        (F.col("event_type") == "error").alias("is_error"),
        F.col("ms").alias("response_time_ms"),
    )


def track_logs(events: DataFrame) -> DataFrame:
    """The view with the column names of a tracking log table."""
    return log_events(events).select(
        "log_id",
        "log_timestamp",
        F.col("svc").alias("service"),
        F.col("inst").alias("instance_name"),
        "cluster",
        F.col("event_type").alias("application"),
        F.col("ms").alias("total_elapsed_ms"),
        F.col("has_incomplete").alias("has_incomplete_trails"),
        F.col("has_incomplete").alias("is_timeout"),
        (F.col("ms") > 30_000).alias("is_high_response_time"),
        (F.col("event_id") % 3 + 1).alias("trail_marks_count"),
    )
