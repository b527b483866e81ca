"""Registered queries: every operator run over the given tables.

The log tables are the event views of ``vigilog.registry``: the whole ``events`` table
serves once as an audit feed and once as a tracking feed. Windows are as long as that
table needs (it spans a month); all thresholds are the defaults.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.config import AUDIT, FEEDS, TRACK_CTX, TRACK_MDC, DetectorConfig, WindowConfig
from vigilog.operators import alerts, detectors
from vigilog.operators.normalize import normalize
from vigilog.functions.times import utc_date
from vigilog.operators.profiles import (
    SKETCH_ERROR,
    composed,
    custom,
    distinct,
    distinct_sketch,
    drift,
    profile,
)
from vigilog.plans import dashboards, detection, maintenance, monitoring
from vigilog.session import fresh_path, pin_utc
from vigilog.registry import event_views, raw_views
from vigilog.schemas import CORRUPT, RAW_SCHEMAS
from vigilog.sources.json_feeds import parse_lines, split_corrupt, write_feed, write_lines
from vigilog.sources.tables import (
    DETECTED_DATE,
    LOG_DATE,
    RUN,
    append_anomalies,
    read_anomalies,
    scan,
)
from vigilog.streaming.ingest import MAX_FILES, save_batch, start_ingest

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 29)
# Detection runs that fill the anomalies table.
RUNS = (datetime(2024, 1, 28), datetime(2024, 1, 28, 12), AS_OF)
CONFIG = DetectorConfig(
    heartbeat_minutes=24 * 60,
    windows=WindowConfig(
        medium=timedelta(hours=72),
        long=timedelta(hours=120),
        baseline=timedelta(days=21),
        baseline_gap=timedelta(hours=72),
    ),
)
# At this moment a retention of 90 days ends in the middle of the table's month.
RETENTION_AS_OF = datetime(2024, 4, 15, 6)


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Types and precision that any SQL engine can reproduce."""
    columns = []
    for field in df.schema:
        value: Column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            value = F.round(value, digits)
        elif isinstance(field.dataType, T.IntegerType):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(field.name))
    return df.select(*columns)


# --- inputs ------------------------------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_views.read_events(pin_utc(spark), sf_dir)


def _logs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = _events(spark, sf_dir)
    return {
        "bpm_audit": event_views.audit_logs(events),
        "m2e_perf": event_views.track_logs(events),
    }


def _normalized(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    lines = raw_views.feed_lines(_events(spark, sf_dir), family)
    good, _ = split_corrupt(parse_lines(lines, family, F.col("value")), family)
    return normalize(good, family)


_anomaly_tables: dict[tuple[str, str], str] = {}


def _anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The anomalies table as the detection job leaves it: one append per run.

    Alerting reads a table another job has written, so it is written once per session.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _anomaly_tables:
        path = fresh_path(spark, "anomaly-table")
        logs = _logs(spark, sf_dir)
        for as_of in RUNS:
            append_anomalies(detection.run_detection(logs, CONFIG, as_of), path)
        _anomaly_tables[key] = path
    return read_anomalies(pin_utc(spark), _anomaly_tables[key], declared=True)


def _recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.recent_anomalies(_anomalies(spark, sf_dir), AS_OF)


# --- detectors ---------------------------------------------------------------------

RECORD = (
    "anomaly_id",
    "anomaly_type",
    "severity",
    "detected_at",
    "time_window_start",
    "time_window_end",
    "affected_service",
    "affected_instance",
    "affected_cluster",
    "metric_name",
    "metric_value",
    "threshold_value",
    "baseline_value",
    "log_count",
)


def _detector(detect: detection.Detector, **metadata: str) -> Query:
    """The record and its metadata entries as typed columns."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = detect(_logs(spark, sf_dir), CONFIG, AS_OF)
        entries = [F.col("metadata")[k].try_cast(t).alias(k) for k, t in metadata.items()]
        return comparable(found.select(*RECORD, *entries))

    return query


def anomalies_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detection.run_detection(_logs(spark, sf_dir), CONFIG, AS_OF)
    return comparable(found.select(*RECORD))


def anomaly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fresh_path(spark, "saved-anomalies")
    return detection.detect_and_save(_logs(spark, sf_dir), CONFIG, AS_OF, table)


def anomaly_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentence of each anomaly."""
    found = detection.run_separately(_logs(spark, sf_dir), CONFIG, AS_OF)
    return found.select("anomaly_id", "details")


# --- normalisation -----------------------------------------------------------------

AUDIT_COLUMNS = (
    "log_timestamp",
    "log_date",
    "transaction_name",
    "transaction_status",
    "response_code",
    "host_name",
    "host_ip",
    "cluster",
    "instance_name",
    "conversation_id",
    "unique_transaction_id",
    "application_id",
    "origination_system_name",
    "elapsed_time_ms",
    "initiated_timestamp",
    "fault_timestamp",
    "is_error",
    "is_failure",
    "is_success",
    "response_time_calculated_ms",
    "response_time_ms",
    "service_name",
    "span_id",
    "trace_id",
    "trace_flags",
)
TRACK_COLUMNS = (
    "log_timestamp",
    "log_date",
    "conversation_id",
    "service",
    "custom_tag",
    "cluster",
    "vtier",
    "transaction_id",
    "instance_name",
    "host_ip",
    "host_name",
    "client_id",
    "application",
    "req_msg_size",
    "resp_msg_size",
    "trail_marks_count",
    "has_incomplete_trails",
    "total_elapsed_ms",
    "operation_start_timestamp",
    "operation_end_timestamp",
    "is_error",
    "is_timeout",
    "is_high_response_time",
    "service_name",
    "span_id",
    "trace_id",
    "trace_flags",
)
FAULT_COLUMNS = (
    "response_code",
    "is_failure",
    "external_fault_code",
    "external_fault_description",
    "fault_entity",
)


def _normalizer(family: str, *columns: str) -> Query:
    return lambda spark, sf_dir: comparable(_normalized(spark, sf_dir, family).select(*columns))


def corrupt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = raw_views.feed_lines(_events(spark, sf_dir), AUDIT)
    _, bad = split_corrupt(parse_lines(lines, AUDIT, F.col("value")), AUDIT)
    return bad


# --- alerts ------------------------------------------------------------------------


def _alert(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: comparable(operator(_recent(spark, sf_dir)))


def _dashboard(text: str) -> Query:
    return lambda spark, sf_dir: comparable(
        dashboards.dashboard(text, AS_OF, anomalies=_anomalies(spark, sf_dir))
    )


def _payload_alerts(anomalies: DataFrame) -> DataFrame:
    """The JSON lines taken apart again."""
    schema = (
        "timestamp string, summary string, critical_count bigint, high_count bigint, "
        "severity string, type string, service string, details string"
    )
    lines = alerts.notification_payloads(alerts.alert_messages(anomalies), AS_OF)
    return lines.select("part", F.from_json("payload", schema).alias("body")).select(
        "part", "body.*"
    )


def acknowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In place, on a copy of the anomalies table; all rows and columns are compared."""
    path = fresh_path(spark, "acknowledged")
    anomalies = _anomalies(spark, sf_dir)
    anomalies.write.partitionBy(DETECTED_DATE, RUN).parquet(path)
    critical = anomalies.filter(F.col("severity") == "CRITICAL").select("anomaly_id")
    maintenance.acknowledge(spark, path, critical, AS_OF)
    return comparable(read_anomalies(spark, path).select(*ACKNOWLEDGED_RECORD))


ACKNOWLEDGED_RECORD = (*RECORD, "details", "acknowledged", "acknowledged_at", "acknowledged_by")


def rerun_acknowledged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed is run and its anomalies are acknowledged; then both feeds are run, twice.

    Each id is in the table once, and what was acknowledged still is.
    """
    path, logs = fresh_path(spark, "rerun"), _logs(spark, sf_dir)
    detection.detect_and_save({"bpm_audit": logs["bpm_audit"]}, CONFIG, AS_OF, path)
    first = read_anomalies(spark, path).select("anomaly_id")
    maintenance.acknowledge(spark, path, first, AS_OF, by="operator")
    for _ in range(2):
        detection.detect_and_save(logs, CONFIG, AS_OF, path)
    saved = read_anomalies(spark, path, declared=True)
    return comparable(saved.select(*ACKNOWLEDGED_RECORD))


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of each detector for each of three feeds, of which one can't be read."""
    logs = _logs(spark, sf_dir)
    torn = F.raise_error(F.lit("a torn file")).cast("string")
    lost = logs["bpm_audit"].withColumn("transaction_name", torn)
    table = fresh_path(spark, "isolated")
    status = detection.detect_isolated_and_save(logs | {"m2e_audit": lost}, CONFIG, AS_OF, table)
    saved = read_anomalies(spark, table, declared=True).groupBy("anomaly_type").count()
    return comparable(
        status.select("detector", "feed", "status", "row_count").unionByName(
            saved.select(
                F.lit("saved").alias("detector"), F.col("anomaly_type").alias("feed"),
                F.lit("ok").alias("status"), F.col("count").alias("row_count"),
            )
        )
    )


def dash_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text of one's own reaches as far back as it says."""
    text = """SELECT affected_service, count(*) AS anomaly_count FROM {anomalies}
    WHERE detected_at >= :as_of - INTERVAL 30 DAYS GROUP BY affected_service"""
    return dashboards.dashboard(text, AS_OF, anomalies=_anomalies(spark, sf_dir))


def latest_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows than the whole table has, of which some have no time."""
    path = fresh_path(spark, "track-table")
    logs = _normalized(spark, sf_dir, TRACK_MDC)
    logs.select("conversation_id", "log_timestamp", LOG_DATE).write.partitionBy(LOG_DATE).parquet(path)
    table = scan(spark, path)
    found = alerts.latest(table, "log_timestamp", table.count() + 1, "conversation_id", LOG_DATE)
    return comparable(found.select("conversation_id", "log_timestamp"))


def latest_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole track table, rows without a time too: as many rows as it has."""
    path = fresh_path(spark, "track-table")
    logs = _normalized(spark, sf_dir, TRACK_MDC)
    logs.select("conversation_id", "log_timestamp", LOG_DATE).write.partitionBy(LOG_DATE).parquet(path)
    table = scan(spark, path)
    found = alerts.latest(table, "log_timestamp", table.count(), "conversation_id", LOG_DATE)
    return comparable(found.select("conversation_id", "log_timestamp"))


def latest_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_views.audit_logs(_events(spark, sf_dir))
    return comparable(alerts.latest(logs, "log_timestamp", 100, "log_id"))


def latest_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    anomalies = _anomalies(spark, sf_dir)
    found = alerts.latest(anomalies, "detected_at", 50, "anomaly_id", DETECTED_DATE)
    return comparable(found.select(*RECORD))


# --- monitoring --------------------------------------------------------------------


def _flat(profile: DataFrame) -> DataFrame:
    """The window struct as two columns."""
    rest = [c for c in profile.columns if c not in ("window", monitoring.WINDOW_DATE)]
    return comparable(
        profile.select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *rest,
        )
    )


def _profile_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_views.audit_logs(_events(spark, sf_dir))
    return monitoring.run_monitor(logs, monitoring.AUDIT_MONITOR)


def _profile_track_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_views.track_logs(_events(spark, sf_dir))
    return monitoring.run_monitor(logs, monitoring.TRACK_MDC_MONITOR)


def _profile_track_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = event_views.track_logs(_events(spark, sf_dir))
    return monitoring.run_monitor(logs, monitoring.TRACK_CTX_MONITOR)


def _profile_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.run_monitor(_anomalies(spark, sf_dir), monitoring.ANOMALY_MONITOR)


_profile_tables: dict[tuple[str, str, str], str] = {}


def _stored(build: Query) -> Query:
    """The profile as the monitor's refresh stores it: written once per session, then pruned."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if key not in _profile_tables:
            path = fresh_path(spark, "profile-table")
            monitoring.store_profile(build(spark, sf_dir), path)
            _profile_tables[key] = path
        return monitoring.read_profile_table(spark, _profile_tables[key])

    return query


def _profiled(build: Query) -> Query:
    return lambda spark, sf_dir: _flat(build(spark, sf_dir))


def _profile_dashboard(text: str, build: Query) -> Query:
    return lambda spark, sf_dir: comparable(
        dashboards.dashboard(text, AS_OF, profile=_stored(build)(spark, sf_dir))
    )


def drift_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = drift(_stored(_profile_audit)(spark, sf_dir), list(monitoring.AUDIT_MONITOR.metrics))
    return comparable(
        changes.select(
            "granularity",
            F.col("window.start").alias("window_start"),
            F.col("window_cmp.start").alias("previous_start"),
            "slice_key",
            "slice_value",
            "metric_name",
            "value",
            "previous_value",
            "absolute_change",
            "relative_change",
        ),
        digits=9,
    )


def profile_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile table made from an early part of the logs, then refreshed.

    The later part holds new days and late rows of an old day.
    """
    logs = event_views.audit_logs(_events(spark, sf_dir))
    first, second = datetime(2024, 1, 20), datetime(2024, 2, 1)
    late = (F.to_date("log_timestamp") == F.lit("2024-01-05").cast("date")) & F.col("is_error")
    early = (F.col("log_timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")) & ~late
    logs = logs.withColumn(
        "ingestion_timestamp",
        F.when(early, F.lit(first.isoformat())).otherwise(second.isoformat()).cast("timestamp"),
    )
    path = fresh_path(spark, "profile")
    monitor = monitoring.AUDIT_MONITOR
    monitoring.create_profile_table(logs.filter(early), monitor, path)
    monitoring.refresh_profile_table(logs, monitor, path, since=first)
    return _flat(monitoring.read_profile_table(spark, path))


def profile_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile kept up to date from its stored state: four batches, each with rows of every day;
    the second is merged by a compaction before a refresh sees it.
    """
    logs, table, path = event_views.audit_logs(_events(spark, sf_dir)), fresh_path(spark, "logs"), fresh_path(spark, "profile")
    dated, part = _dated(logs), F.pmod(F.xxhash64("log_id"), F.lit(4))
    for number in range(4):
        save_batch(dated.filter(part == number), table, "stream", number)
        if number == 2:
            maintenance.compact_table(spark, table, table)
        if number != 1:
            monitoring.refresh_from_state(spark, table, monitoring.AUDIT_MONITOR, path)
    return _flat(monitoring.read_profile_table(spark, path))


OWN_METRICS = [
    composed(
        "slow_failure_share", "slow_failures / greatest(failures, 1)",
        failures="count(case when is_failure then 1 end)",
        slow_failures="sum(case when is_failure and response_time_ms > 10000 then 1.0d else 0 end)",
    ),
    composed("ms_range", "most - least", "bigint", most="max(response_time_ms)", least="min(response_time_ms)"),
    custom("ms_deviation", "stddev_pop(response_time_ms)"),
    distinct("instances", "instance_name"),
    distinct_sketch("instances_about", "instance_name"),
]


def profile_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of one's own, and a sketch that stays within five standard errors."""
    logs = event_views.audit_logs(_events(spark, sf_dir))
    made = profile(logs, "log_timestamp", OWN_METRICS, ["transaction_name", "cluster"])
    near = F.abs(F.col("instances_about") - F.col("instances")) <= 5 * SKETCH_ERROR * F.col("instances")
    return _flat(made.withColumn("instances_about", near))


# --- streaming and upkeep ----------------------------------------------------------


def _start(spark: SparkSession, feed: str, source: str, table: str, checkpoint: str) -> None:
    start_ingest(spark, feed, source, table, checkpoint, trigger=None).awaitTermination()


def _ingested(feed: str, family: str, *columns: str) -> Query:
    """Lines in many files → stream → log table, in several batches and with a restart."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(_ingest_twice(spark, sf_dir, feed, family)[1].select(*columns))

    return query


def _ingest_twice(
    spark: SparkSession, sf_dir: str, feed: str, family: str
) -> tuple[str, DataFrame]:
    source, table = fresh_path(spark, f"{feed}-files"), fresh_path(spark, f"{feed}-table")
    checkpoint = fresh_path(spark, f"{feed}-checkpoint")
    events = _events(spark, sf_dir)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for part in range(2):
        # Events are dealt to the files before they become lines, which are ten times as long.
        rows = event_views.spread(events.filter(half == part), MAX_FILES + 2)
        write_lines(raw_views.feed_lines(rows, family), source)
        _start(spark, feed, source, table, checkpoint)
    good, _ = split_corrupt(scan(spark, table), family)
    return table, good


def stream_written_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as a feed in two batches, and ingested by a stream with a trigger."""
    source, table = fresh_path(spark, "written-files"), fresh_path(spark, "written-table")
    lines = raw_views.feed_lines(_events(spark, sf_dir), AUDIT)
    records, _ = split_corrupt(parse_lines(lines, AUDIT, F.col("value")), AUDIT)
    records = records.select(*RAW_SCHEMAS[AUDIT].fieldNames()).drop(CORRUPT)
    half = F.pmod(F.xxhash64("timeMillis", "message.ConversationId"), F.lit(2))
    write_feed(records.filter(half == 0).repartition(MAX_FILES + 2), source)
    stream = start_ingest(spark, "bpm_audit", source, table, fresh_path(spark, "written-checkpoint"), trigger="1 second")
    try:
        stream.processAllAvailable()
        write_feed(records.filter(half == 1).repartition(2), source)
        stream.processAllAvailable()
    finally:
        stream.stop()
    return comparable(scan(spark, table).select(*AUDIT_COLUMNS))


def stream_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that begins to send two fields more: what the log table has of them."""
    source, table = fresh_path(spark, "rescue-files"), fresh_path(spark, "rescue-table")
    lines = raw_views.feed_lines(event_views.spread(_events(spark, sf_dir), 4), AUDIT)
    own = F.get_json_object("value", "$.message.ConversationId")
    added = F.concat(F.lit('{"added":{"of":"'), own, F.lit('"},'), F.substring("value", 2, 2**31 - 1))
    added = F.regexp_replace(added, r'"message":\{', '"message":{"Added":[1,"x"],')
    write_lines(lines.select(F.coalesce(added, "value").alias("value")), source)
    checkpoint = fresh_path(spark, "rescue-checkpoint")
    start_ingest(spark, "bpm_audit", source, table, checkpoint, trigger=None, rescue=True).awaitTermination()
    good, _ = split_corrupt(scan(spark, table), AUDIT)
    fields = F.col("rescued")
    return good.filter("conversation_id is not null").select(
        "conversation_id", F.get_json_object(fields["added"], "$.of").alias("added"),
        fields["message.Added"].alias("message_added"), F.size(fields).cast("bigint").alias("n_unknown"),
    )


def ingest_retain_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ingested table after in-place compaction, retention, and a run with nothing new."""
    table, _ = _ingest_twice(spark, sf_dir, "bpm_audit", AUDIT)
    maintenance.compact_table(spark, table, table)
    maintenance.apply_retention(spark, table, RETENTION_AS_OF)
    maintenance.compact_table(spark, table, table)
    good, _ = split_corrupt(scan(spark, table), AUDIT)
    return comparable(good.filter(F.col("log_timestamp").isNotNull()).select(*AUDIT_COLUMNS))


#: Feed → the remainder of the event id that it gets.
SIXTHS = {"bpm_audit": 0, "m2e_audit": 1, "bpm_adapter": 2, "bpm_perf": 3, "m2e_perf": 4, "maf_perf": 5}


def detect_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all six feeds → normalised logs → all six detectors."""
    logs = {}
    for feed, sixth in SIXTHS.items():
        family = FEEDS[feed].family
        lines = raw_views.feed_lines(_events(spark, sf_dir).filter(F.col("event_id") % 6 == sixth), family)
        good, _ = split_corrupt(parse_lines(lines, family, F.col("value")), family)
        logs[feed] = normalize(good, family)
    found = detection.run_detection(logs, CONFIG, AS_OF)
    return comparable(found.select(*RECORD, "details"))


def profile_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit monitor over both audit feeds as one table; only one has a column more."""
    logs = event_views.audit_logs(_events(spark, sf_dir))
    feeds = {"bpm_audit": logs, "m2e_audit": logs.withColumn("extra", F.lit(1))}
    return monitoring.run_monitor(monitoring.family_logs(feeds, AUDIT), monitoring.AUDIT_MONITOR)


def profile_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit monitor over two whole audit feeds as one table."""
    logs = event_views.audit_logs(_events(spark, sf_dir))
    feeds = {"bpm_audit": logs, "m2e_audit": logs}
    return monitoring.run_monitor(monitoring.family_logs(feeds, AUDIT), monitoring.AUDIT_MONITOR)


def _log_table(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_path(spark, "log-table")
    _dated(event_views.audit_logs(_events(spark, sf_dir))).write.partitionBy(LOG_DATE).parquet(path)
    return path


def _dated(logs: DataFrame) -> DataFrame:
    return logs.withColumn(LOG_DATE, utc_date(logs, "log_timestamp"))


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _log_table(spark, sf_dir)
    maintenance.apply_retention(spark, path, RETENTION_AS_OF)
    return comparable(scan(spark, path))


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _log_table(spark, sf_dir)
    maintenance.compact_table(spark, path, path)
    return comparable(scan(spark, path))


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of files, the later with one more column, after all upkeep."""
    path = fresh_path(spark, "log-table")
    logs = _dated(event_views.audit_logs(_events(spark, sf_dir)))
    late = F.col("log_timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz")
    for part in (logs.filter(~late), logs.filter(late).withColumn("added", F.col("log_id") % 7)):
        part.write.mode("append").partitionBy(LOG_DATE).parquet(path)
    maintenance.compact_table(spark, path, path)
    maintenance.apply_retention(spark, path, RETENTION_AS_OF)
    return comparable(scan(spark, path))


QUERIES: dict[str, Query] = {
    "d1_failure_rate_spike": _detector(
        detectors.detect_failure_rate_spikes,
        rate_multiplier="double",
        failure_count="bigint",
        baseline_total="bigint",
        source_table="string",
    ),
    "d2_missing_heartbeat": _detector(detectors.detect_missing_heartbeats, log_type="string"),
    "d3_high_response_time": _detector(
        detectors.detect_high_response_times, p95="double", p99="double", source_table="string"
    ),
    "d4_transaction_timeout": _detector(
        detectors.detect_transaction_timeouts,
        avg_elapsed_before_timeout_ms="double",
        source_table="string",
    ),
    "d5_volume_anomaly": _detector(
        detectors.detect_volume_anomalies, volume_ratio="double", source_table="string"
    ),
    "d6_service_degradation": _detector(
        detectors.detect_service_degradation,
        degradation_percent="double",
        baseline_count="bigint",
        source_table="string",
    ),
    "anomalies_union": anomalies_union,
    "anomaly_summary": anomaly_summary,
    "anomaly_details": anomaly_details,
    "normalize_audit": _normalizer(AUDIT, *AUDIT_COLUMNS),
    "normalize_track_mdc": _normalizer(TRACK_MDC, *TRACK_COLUMNS),
    "normalize_track_ctx": _normalizer(TRACK_CTX, *TRACK_COLUMNS, *FAULT_COLUMNS),
    "trail_metrics": _normalizer(
        TRACK_MDC,
        "conversation_id",
        "trail_marks_count",
        "has_incomplete_trails",
        "total_elapsed_ms",
        "operation_start_timestamp",
        "operation_end_timestamp",
    ),
    "failure_classify": _normalizer(
        TRACK_CTX,
        "conversation_id",
        "response_code",
        "is_error",
        "is_failure",
        "is_timeout",
        "is_high_response_time",
    ),
    "response_time_derive": _normalizer(
        AUDIT,
        "conversation_id",
        "elapsed_time_ms",
        "initiated_timestamp",
        "fault_timestamp",
        "response_time_calculated_ms",
        "response_time_ms",
    ),
    "corrupt_rows": corrupt_rows,
    "alert_recent": _alert(lambda a: a.select(*RECORD)),
    "alert_by_severity": _alert(alerts.by_severity),
    "alert_by_type": _alert(alerts.by_type),
    "alert_top_services": _alert(alerts.top_services),
    "alert_critical_detail": _alert(alerts.critical_detail),
    "alert_messages": _alert(alerts.alert_messages),
    "alert_rendered": _alert(lambda a: alerts.rendered(alerts.alert_messages(a))),
    "alert_routing": _alert(lambda a: alerts.route_counts(alerts.alert_messages(a))),
    "alert_payload": _alert(_payload_alerts),
    "dash_over_time": _dashboard(dashboards.ANOMALIES_OVER_TIME),
    "dash_top_services": _dashboard(dashboards.TOP_SERVICES),
    "dash_recent_critical": _dashboard(dashboards.RECENT_CRITICAL),
    "anomalies_24h_by_severity": _dashboard(dashboards.LAST_DAY_BY_SEVERITY),
    "top_services_7d": _dashboard(dashboards.LAST_WEEK_TOP_SERVICES),
    "acknowledge": acknowledge,
    "rerun_acknowledged": rerun_acknowledged,
    "run_status": run_status,
    "latest_logs": latest_logs,
    "latest_anomalies": latest_anomalies,
    "profile_audit": _profiled(_profile_audit),
    "profile_track_a": _profiled(_profile_track_a),
    "profile_track_b": _profiled(_profile_track_b),
    "profile_anomalies": _profiled(_profile_anomalies),
    "drift_audit": drift_audit,
    "sample_metrics": _profile_dashboard(dashboards.SAMPLE_METRICS, _profile_audit),
    "dash_response_trend": _profile_dashboard(dashboards.RESPONSE_TREND, _profile_audit),
    "dash_timeout_pct": _profile_dashboard(dashboards.TIMEOUT_PERCENT, _profile_track_a),
    "dash_severity_pct": _profile_dashboard(dashboards.SEVERITY_PERCENT, _profile_anomalies),
    "profile_incremental": profile_incremental,
    "profile_state": profile_state,
    "profile_custom": profile_custom,
    "stream_ingest_audit": _ingested("bpm_audit", AUDIT, *AUDIT_COLUMNS),
    "stream_ingest_track": _ingested("bpm_adapter", TRACK_MDC, *TRACK_COLUMNS),
    "stream_ingest_track_ctx": _ingested(
        "m2e_perf", TRACK_CTX, *TRACK_COLUMNS, *FAULT_COLUMNS
    ),
    "stream_written_feed": stream_written_feed,
    "stream_rescue": stream_rescue,
    "retention": retention,
    "compaction": compaction,
    "schema_evolution": schema_evolution,
    "ingest_retain_compact": ingest_retain_compact,
    "detect_from_lines": detect_from_lines,
    "profile_family": _profiled(profile_family),
    "profile_feeds": _profiled(profile_feeds),
    "dash_month": dash_month,
    "latest_undated": latest_undated,
    "latest_track": latest_track,
}
