"""Tiny log tables and plan inspection."""

from __future__ import annotations

from datetime import timezone

AUDIT_DDL = (
    "log_timestamp timestamp, transaction_name string, instance_name string, cluster string, "
    "is_failure boolean, response_time_ms bigint"
)
TRACK_DDL = (
    "log_timestamp timestamp, service string, instance_name string, cluster string, "
    "total_elapsed_ms bigint, has_incomplete_trails boolean"
)


def utc(moment):
    return moment.replace(tzinfo=timezone.utc)


def audit(spark, rows):
    """Rows of (time, service, failed, ms) with optional (instance, cluster)."""
    full = []
    for time, service, failed, ms, *place in rows:
        instance, cluster = place if place else ("i", "c")
        full.append((utc(time), service, instance, cluster, failed, ms))
    return spark.createDataFrame(full, AUDIT_DDL)


def track(spark, rows):
    """Rows of (time, service, ms, incomplete) with optional (instance, cluster)."""
    full = []
    for time, service, ms, incomplete, *place in rows:
        instance, cluster = place if place else ("i", "c")
        full.append((utc(time), service, instance, cluster, ms, incomplete))
    return spark.createDataFrame(full, TRACK_DDL)


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
