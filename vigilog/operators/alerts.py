"""Anomalies → summaries, messages, routes and notification payloads."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.config import SEVERITY_RANK, Span, utc
from vigilog.functions.text import filled, fixed, moment, shown
from vigilog.functions.times import in_any, instant
from vigilog.sources.tables import DETECTED_DATE

# Severities that raise an alert and who receives it.
ROUTES = {"CRITICAL": "on-call", "HIGH": "operations", "MEDIUM": "dashboard", "LOW": "dashboard"}


def severity_rank(severity: Column) -> Column:
    """1 is worst; anything unknown ranks with INFO."""
    rank = F.lit(SEVERITY_RANK["INFO"])
    for name, value in SEVERITY_RANK.items():
        rank = F.when(severity == name, F.lit(value)).otherwise(rank)
    return rank


def since(anomalies: DataFrame, as_of: datetime, back: timedelta) -> DataFrame:
    """Detected in the time before ``as_of``. The upper bound lets the past be replayed."""
    span = Span(utc(as_of) - back, utc(as_of))
    return in_any(anomalies, "detected_at", [span], DETECTED_DATE)


def recent_anomalies(anomalies: DataFrame, as_of: datetime, hours_back: int = 1) -> DataFrame:
    return since(anomalies, as_of, timedelta(hours=hours_back))


# --- summaries ---------------------------------------------------------------------


def by_severity(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(severity_rank(F.col("severity")), "severity")
    )


def by_type(anomalies: DataFrame) -> DataFrame:
    return (
        anomalies.groupBy("anomaly_type", "severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("severity", "anomaly_type")
    )


def top_services(anomalies: DataFrame, limit: int = 10) -> DataFrame:
    """``max_severity`` is the alphabetical maximum (MEDIUM beats CRITICAL);
    ``worst_severity`` goes by rank. Equal counts are ordered by name.
    """
    return (
        anomalies.filter(F.col("affected_service").isNotNull())
        .groupBy("affected_service")
        .agg(
            F.count(F.lit(1)).alias("anomaly_count"),
            F.count_distinct("anomaly_type").alias("anomaly_types"),
            F.max("severity").alias("max_severity"),
            F.min_by("severity", severity_rank(F.col("severity"))).alias("worst_severity"),
        )
        .orderBy(F.desc("anomaly_count"), "affected_service")
        .limit(limit)
    )


def critical_detail(anomalies: DataFrame) -> DataFrame:
    return anomalies.filter(F.col("severity") == "CRITICAL").select(
        "anomaly_type",
        "affected_service",
        "metric_name",
        "metric_value",
        "threshold_value",
        "details",
    )


# --- messages ----------------------------------------------------------------------


def alert_messages(anomalies: DataFrame) -> DataFrame:
    """One message per anomaly of an alerting severity, as columns."""
    value = F.col("metric_value")
    return anomalies.filter(F.col("severity").isin(*ROUTES)).select(
        F.col("anomaly_id").alias("id"),
        F.col("anomaly_type").alias("type"),
        "severity",
        F.col("affected_service").alias("service"),
        F.col("affected_instance").alias("instance"),
        F.col("affected_cluster").alias("cluster"),
        F.when(
            shown(value),
            F.concat(F.coalesce("metric_name", F.lit("None")), F.lit("="), fixed(value, 2)),
        ).alias("metric"),
        F.col("threshold_value").alias("threshold"),
        F.col("baseline_value").alias("baseline"),
        "details",
        F.concat(
            F.coalesce(moment(F.col("time_window_start")), F.lit("None")),
            F.lit(" to "),
            F.coalesce(moment(F.col("time_window_end")), F.lit("None")),
        ).alias("time_window"),
        "detected_at",
    )


def rendered(messages: DataFrame) -> DataFrame:
    """Messages as text (the labels are fixed values). Lines without a value are left out; the text ends in a newline."""

    def line(label: str, value: Column, present: Column | None = None) -> Column:
        text = F.concat(F.lit(f"  {label}: "), value)
        return text if present is None else F.when(present, text)

    def or_none(value: Column) -> Column:
        return F.coalesce(value, F.lit("None"))

    service = F.when(filled(F.col("service")), F.col("service")).otherwise("N/A")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("["), F.col("severity"), F.lit("] "), or_none(F.col("type"))),
        line("Service", service),
        line("Instance", F.col("instance"), filled(F.col("instance"))),
        line("Cluster", F.col("cluster"), filled(F.col("cluster"))),
        line("Metric", F.col("metric"), filled(F.col("metric"))),
        line("Threshold", fixed(F.col("threshold"), 2), shown(F.col("threshold"))),
        line("Baseline", fixed(F.col("baseline"), 2), shown(F.col("baseline"))),
        line("Details", or_none(F.col("details"))),
        line("Time Window", F.col("time_window")),
        line("Detected At", or_none(moment(F.col("detected_at")))),
        F.lit(""),
    )
    return messages.select("id", "severity", text.alias("text"))


# --- notifications -----------------------------------------------------------------


def routed(messages: DataFrame) -> DataFrame:
    route = F.lit(None).cast("string")
    for severity, target in ROUTES.items():
        route = F.when(F.col("severity") == severity, F.lit(target)).otherwise(route)
    return messages.withColumn("route", route)


def route_counts(messages: DataFrame) -> DataFrame:
    return (
        routed(messages)
        .groupBy("severity", "route")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(severity_rank(F.col("severity")))
    )


def notification_payloads(messages: DataFrame, as_of: datetime) -> DataFrame:
    """JSON for a webhook: a header with both counts, and a line for every CRITICAL alert.

    Columns ``part`` (``header`` or ``alert``), ``id`` of the alert and ``payload``. The form is
    the same for one alert and for millions, and no row holds more than one. Nothing if
    nothing is critical or high.
    """
    # The summary sentence and the keys of the JSON.
    header = F.struct(
        F.date_format(instant(as_of), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.concat(
            F.lit("Log Anomaly Detection: "),
            F.col("critical_count").cast("string"),
            F.lit(" CRITICAL, "),
            F.col("high_count").cast("string"),
            F.lit(" HIGH alerts"),
        ).alias("summary"),
        F.col("critical_count"),
        F.col("high_count"),
    )
    counts = messages.agg(
        F.count_if(F.col("severity") == "CRITICAL").alias("critical_count"),
        F.count_if(F.col("severity") == "HIGH").alias("high_count"),
    ).filter((F.col("critical_count") > 0) | (F.col("high_count") > 0))
    alert = F.struct("severity", "type", "service", "details")

    def line(part: str, id_: Column, payload: Column) -> list[Column]:
        text = F.to_json(payload, {"ignoreNullFields": "false"})
        return [F.lit(part).alias("part"), id_.alias("id"), text.alias("payload")]

    critical = messages.filter(F.col("severity") == "CRITICAL")
    return counts.select(*line("header", F.lit(None).cast("string"), header)).unionByName(
        critical.select(*line("alert", F.col("id"), alert))
    )


# --- latest rows -------------------------------------------------------------------


def latest(
    df: DataFrame, time_column: str, limit: int, tiebreak: str, date_column: str | None = None
) -> DataFrame:
    """Newest rows first; Spark keeps ``limit`` rows per task, not a global sort.

    Of a table partitioned by date only the newest partitions are read: as many as it
    takes to hold ``limit`` rows, and the one without a date. Counting rows per partition reads file footers only.
    """
    if date_column is not None:
        newest_first = Window.orderBy(F.desc(date_column)).rowsBetween(
            Window.unboundedPreceding, -1
        )
        per_date = df.filter(F.col(date_column).isNotNull()).groupBy(date_column).count()
        needed = per_date.select(
            date_column, F.coalesce(F.sum("count").over(newest_first), F.lit(0)).alias("newer")
        ).filter(F.col("newer") < limit)
        oldest = needed.agg(F.min(date_column)).scalar()
        df = df.filter((F.col(date_column) >= oldest) | F.col(date_column).isNull())
    return df.orderBy(F.desc(time_column), tiebreak).limit(limit)
