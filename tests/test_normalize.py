import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigilog.config import AUDIT, TRACK_CTX, TRACK_MDC
from vigilog.operators.normalize import normalize
from vigilog.schemas import RAW_SCHEMAS
from vigilog.sources.json_feeds import parse_lines, read_feed, split_corrupt, write_feed


def one(spark, family, record):
    line = record if isinstance(record, str) else json.dumps(record)
    df = spark.createDataFrame([(line,)], "line string")
    return normalize(parse_lines(df, family, F.col("line")), family).first()


def mark(**fields):
    return {"Name": "n", "Complete": True, "ElapsedDuration": 5, **fields}


def track(spark, family=TRACK_MDC, **message):
    return one(spark, family, {"message": message})


@pytest.mark.parametrize("family", [AUDIT, TRACK_MDC, TRACK_CTX])
def test_raw_columns_are_kept(spark, family):
    row = one(spark, family, {"level": "INFO", "message": {"Cluster": "c1"}})
    assert set(RAW_SCHEMAS[family].fieldNames()) <= set(row.asDict())
    assert row["cluster"] == "c1" and row["ingestion_timestamp"] is not None


def test_missing_and_empty_marks(spark):
    missing = track(spark)
    assert missing.trail_marks_count is None
    assert missing.has_incomplete_trails is False and missing.total_elapsed_ms is None
    empty = track(spark, TrailMarks=[])
    assert empty.trail_marks_count == 0
    assert empty.has_incomplete_trails is False and empty.total_elapsed_ms is None
    assert empty.operation_start_timestamp is None


def test_incomplete_is_three_valued(spark):
    unknown = track(spark, TrailMarks=[mark(Complete=None)])
    assert unknown.has_incomplete_trails is None and unknown.is_timeout is None
    assert track(spark, TrailMarks=[mark(Complete=None), mark(Complete=False)]).is_timeout is True
    assert track(spark, TrailMarks=[mark()]).is_timeout is False


def test_elapsed_counts_missing_as_zero_and_survives_overflow(spark):
    marks = [mark(ElapsedDuration=None), mark(ElapsedDuration=7)]
    assert track(spark, TrailMarks=marks).total_elapsed_ms == 7
    huge = [mark(ElapsedDuration=2**63 - 1), mark(ElapsedDuration=2**63 - 1)]
    assert track(spark, TrailMarks=huge).total_elapsed_ms is None


@pytest.mark.parametrize(("ms", "high"), [(30000, False), (30001, True), (None, False)])
def test_high_response_time_is_strict(spark, ms, high):
    marks = [mark(ElapsedDuration=ms)] if ms is not None else None
    assert track(spark, TrailMarks=marks).is_high_response_time is high


def test_first_mark_gives_both_times(spark):
    marks = [
        mark(StartTime="2024-01-01T00:00:00.1234Z", EndTime="2024-01-01T00:00:01.0000Z"),
        mark(StartTime="2024-01-01T05:00:00.0000Z", EndTime="2024-01-01T06:00:00.0000Z"),
    ]
    row = track(spark, TrailMarks=marks)
    assert row.operation_start_timestamp == datetime(2024, 1, 1, 0, 0, 0, 123400)
    assert row.operation_end_timestamp == datetime(2024, 1, 1, 0, 0, 1)
    bad = track(spark, TrailMarks=[mark(StartTime="soon")])
    assert bad.operation_start_timestamp is None


@pytest.mark.parametrize(
    ("code", "failed"),
    [("399", False), ("400", True), ("599", True), ("600", False), ("E500", False), (None, False)],
)
def test_failure_codes(spark, code, failed):
    row = track(spark, TRACK_CTX, ResponseCode=code, FaultEntity="f")
    assert row.is_failure is failed and row.fault_entity == "f"


def test_audit_elapsed_time(spark):
    times = {
        "InitiatedTimestamp": "2024-01-01T00:00:00.9000Z",
        "FaultTimestamp": "2024-01-01T00:00:02.1000Z",
    }
    given = one(spark, AUDIT, {"message": {**times, "ElapsedTime": "12"}})
    assert (given.elapsed_time_ms, given.response_time_ms) == (12, 12)
    derived = one(spark, AUDIT, {"message": {**times, "ElapsedTime": "abc"}})
    assert derived.elapsed_time_ms is None
    assert derived.response_time_calculated_ms == derived.response_time_ms == 2000
    broken = one(spark, AUDIT, {"message": {**times, "FaultTimestamp": "never"}})
    assert broken.fault_timestamp is None and broken.response_time_ms is None


@pytest.mark.parametrize(
    ("status", "failure", "success"),
    [
        ("FAILED", True, False),
        ("ERROR", True, False),
        ("TIMEOUT", True, False),
        ("COMPLETE", False, True),
        (None, False, False),
    ],
)
def test_audit_status(spark, status, failure, success):
    row = one(spark, AUDIT, {"message": {"TransactionStatus": status}})
    assert (row.is_failure, row.is_success) == (failure, success)


@pytest.mark.parametrize(("level", "error"), [("ERROR", True), ("FATAL", True), (None, False)])
def test_levels(spark, level, error):
    assert one(spark, AUDIT, {"level": level}).is_error is error


def test_milliseconds_are_dropped_and_nonsense_is_null(spark):
    assert one(spark, AUDIT, {"timeMillis": 1704067200987}).log_timestamp == datetime(2024, 1, 1)
    assert one(spark, AUDIT, {"timeMillis": 2**62}).log_timestamp is None


def test_tracing_keys(spark):
    tags = {"service.name": "s", "span_id": "1", "trace_id": "2", "trace_flags": "00"}
    row = one(spark, TRACK_MDC, {"mdc": tags})
    assert (row.service_name, row.span_id, row.trace_id, row.trace_flags) == ("s", "1", "2", "00")
    assert one(spark, AUDIT, {"contextMap": {"a": "b"}}).service_name is None


def test_session_zone_does_not_move_instants(spark):
    record = {
        "timestamp": "2024-01-01T00:00:00.123+0000",
        "message": {"TrailMarks": [mark(StartTime="2024-01-01T00:00:00.1230Z")]},
    }
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        line = spark.createDataFrame([(json.dumps(record),)], "line string")
        rows = normalize(parse_lines(line, TRACK_MDC, F.col("line")), TRACK_MDC)
        start, logged = rows.select(
            F.unix_millis("operation_start_timestamp"), F.unix_millis("log_timestamp")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert start == logged == 1704067200123


def test_corrupt_lines_are_split_off(spark, tmp_path):
    lines = [
        '{"level": "INFO"}',
        "not json",
        '{"level": "WARN", "threadId": "many"}',
        '{"level": "HALF", "message": {"ClientApp": "a", "Cluster": [1]}}',
    ]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    table = read_feed(spark, AUDIT, str(tmp_path))
    good, bad = split_corrupt(table, AUDIT)
    assert [r.line for r in bad.collect()] == ["not json"]
    kept = {r.level: r for r in good.collect()}
    assert kept.keys() == {"INFO", "WARN", "HALF"}
    assert kept["WARN"].threadId is None and kept["HALF"].message.ClientApp == "a"
    broken = normalize(table, AUDIT).filter("level is null").first()
    assert broken.log_timestamp is None and broken.log_date is None


def test_feed_writer_appends_files(spark, tmp_path):
    df = spark.createDataFrame([("INFO",)], "level string")
    write_feed(df, str(tmp_path / "feed"))
    write_feed(df, str(tmp_path / "feed"))
    assert read_feed(spark, AUDIT, str(tmp_path / "feed")).select("level", "thread").count() == 2
