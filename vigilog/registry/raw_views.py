"""Raw JSON feeds derived from an ``events`` table, with deterministic outcomes.

Fixtures of the registered queries. Every event becomes one JSON line of the wanted family. How
it went is chosen by arithmetic on the event id, and some fields are damaged on purpose:
numbers that are no numbers, times that are no times, lines that are no JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.config import AUDIT, TRACK_CTX, TRACK_MDC

# One line in seven is odd, in one of these ways.
ODD = ("slow", "refused", "stuck")


def draw(event_id: Column, salt: int, size: int) -> Column:
    """A repeatable number in [0, size) for an event."""
    mixed = event_id % F.lit(999_983) * F.lit(104_729 * (2 * salt + 1)) + F.lit(15_485_863 * salt)
    return mixed % F.lit(1_000_003) % F.lit(size)


def with_outcomes(events: DataFrame) -> DataFrame:
    """Adds how each event went, as both kinds of feed tell it."""
    i = F.col("event_id")
    odd = F.get(F.array(*[F.lit(x) for x in ODD]), draw(i, 1, len(ODD)).cast("int"))
    outcome = F.col("outcome")
    code = (draw(i, 2, 60) + 500).cast("string")
    slow, stuck = draw(i, 3, 7000) + 31_000, draw(i, 4, 9000) + 45_000
    return events.withColumn("outcome", F.when(draw(i, 0, 7) == 0, odd)).select(
        "*",
        F.when(outcome == "refused", "FAILED")
        .when(outcome == "stuck", "TIMEOUT")
        .otherwise("COMPLETE")
        .alias("audit_status"),
        F.when(outcome == "refused", code)
        .when(outcome == "stuck", "499")
        .otherwise("200")
        .alias("audit_code"),
        F.when(outcome.isNull(), draw(i, 5, 900) + 20)
        .when(outcome == "refused", draw(i, 6, 1000) + 400)
        .when(outcome == "slow", slow)
        .when(outcome == "stuck", stuck)
        .alias("audit_elapsed"),
        F.when(outcome == "refused", code).alias("track_code"),
        F.when(outcome == "stuck", stuck)
        .when(outcome == "slow", slow)
        .otherwise(draw(i, 7, 60) + 5)
        .alias("track_elapsed"),
        F.coalesce(outcome != "stuck", F.lit(True)).alias("track_complete"),
    )


def _service() -> Column:
    """Missing in one line of 19, but after the 26th only in one of 95."""
    i = F.col("event_id")
    late = F.col("ts") > F.lit("2024-01-26").cast("timestamp_ntz")
    named = (i % 19 != 0) | (late & (i % 95 != 0))
    return F.when(named, _labelled("svc_", F.col("user_id") % 5))


def _stamp(moment: Column, pattern: str) -> Column:
    return F.date_format(moment, pattern)


def _zulu(moment: Column) -> Column:
    return _stamp(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSS'Z'")


def _labelled(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def _level() -> Column:
    kind = F.col("event_type")
    return (
        F.when((kind == "error") & (F.col("event_id") % 2 == 0), "FATAL")
        .when(kind == "error", "ERROR")
        .when(kind == "click", "WARN")
        .when(kind == "view", "INFO")
    )


def _tags() -> Column:
    i = F.col("event_id")
    return F.when(
        i % 2 == 0,
        F.create_map(
            F.lit("service.name"),
            _labelled("app-", F.col("user_id") % 5),
            F.lit("span_id"),
            _labelled("span-", i),
            F.lit("trace_id"),
            _labelled("trace-", i % 1000),
        ),
    )


def _place() -> dict[str, Column]:
    user, i = F.col("user_id"), F.col("event_id")
    return {
        "Cluster": F.when(i % 43 != 0, _labelled("c", user % 3)),
        "InstanceName": F.when(i % 41 != 0, _labelled("inst_", user)),
        "HostName": _labelled("host-", user % 50),
        "HostIPAddress": _labelled("10.0.0.", user % 50),
        "ConversationId": _labelled("conv-", F.col("event_id")),
    }


def _struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[value.alias(name) for name, value in fields.items()])


def _millis() -> Column:
    return F.call_function("div", F.unix_micros(F.col("ts").cast("timestamp")), F.lit(1000))


def _audit_record() -> Column:
    i = F.col("event_id")
    later = F.timestamp_seconds(F.unix_timestamp("ts") + i % 7)
    message = _struct(
        {
            **_place(),
            "ApplicationId": F.col("event_type"),
            "UniqueTransactionId": _labelled("txn-", i),
            "OriginationSystemName": F.lit("portal"),
            "TransactionName": _service(),
            "TransactionStatus": F.col("audit_status"),
            "ResponseCode": F.col("audit_code"),
            "InitiatedTimestamp": F.when(i % 13 == 0, "not-a-time").otherwise(_zulu(F.col("ts"))),
            "FaultTimestamp": F.when(F.col("event_type") == "error", _zulu(later)),
            "ElapsedTime": F.when(i % 11 == 0, "abc").otherwise(
                F.col("audit_elapsed").cast("string")
            ),
        }
    )
    return _struct(
        {
            "contextMap": _tags(),
            "level": _level(),
            "message": message,
            "timeMillis": _millis(),
        }
    )


def _track_message(extra: dict[str, Column]) -> Column:
    """Between none and three marks; their list is missing for some lines."""
    i = F.col("event_id")
    marks = F.transform(
        F.sequence(F.lit(1).cast("bigint"), i % 4),
        lambda n: _struct(
            {
                "Name": _labelled("step-", n),
                "StartTime": F.when(i % 17 == 0, "soon").otherwise(_zulu(F.col("ts"))),
                "EndTime": F.when(
                    F.col("track_complete"),
                    _zulu(F.timestamp_seconds(F.unix_timestamp("ts") + n)),
                ),
                "Complete": F.when(i % 23 != 0, F.col("track_complete")),
                "ElapsedDuration": F.when((i + n) % 5 != 0, F.col("track_elapsed") + n),
            }
        ),
    )
    return _struct(
        {
            **_place(),
            "Service": _service(),
            "CustomTag": F.col("event_type"),
            "TrailMarks": F.when(i % 4 == 0, F.when(i % 8 == 0, F.slice(marks, 1, 0))).otherwise(
                marks
            ),
            "Vtier": _labelled("v", i % 2),
            "TransactionId": _labelled("txn-", i),
            "ClientId": F.col("event_type"),
            "Application": _labelled("app-", F.col("user_id") % 7),
            "ReqMsgSize": i % 5000,
            "RespMsgSize": i % 1000,
            **extra,
        }
    )


def _track_mdc_record() -> Column:
    return _struct(
        {
            "level": _level(),
            "mdc": _tags(),
            "message": _track_message({}),
            "timestamp": F.when(F.col("event_id") % 29 == 0, "yesterday").otherwise(
                _stamp(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'")
            ),
        }
    )


def _track_ctx_record() -> Column:
    failed = F.col("track_code").isNotNull()
    odd = F.when(F.col("event_id") % 31 == 0, "E500").when(F.col("event_id") % 37 == 0, "399")
    fault = {
        "ResponseCode": F.coalesce(odd, F.col("track_code")),
        "ExternalFaultCode": F.when(failed, "1"),
        "ExternalFaultDescription": F.when(failed, "BackendRefused"),
        "FaultEntity": F.when(failed, "backend"),
    }
    return _struct(
        {
            "contextMap": _tags(),
            "level": _level(),
            "message": _track_message(fault),
            "timeMillis": _millis(),
        }
    )


_RECORDS = {
    AUDIT: _audit_record,
    TRACK_MDC: _track_mdc_record,
    TRACK_CTX: _track_ctx_record,
}


def feed_lines(events: DataFrame, family: str) -> DataFrame:
    """One text column ``value``: the feed as it would lie in files."""
    broken = F.col("event_id") % 97 == 0
    line = F.when(broken, _labelled("not json ", F.col("event_id"))).otherwise(
        F.to_json(_RECORDS[family]())
    )
    return with_outcomes(events).select(line.alias("value"))
