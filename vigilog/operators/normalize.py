"""Raw feed rows → log-table rows.

One ``select`` per family. Every raw column is kept and the derived ones are added.
The functions take and return DataFrames, so batch and stream share them. Casts and
parses are the ``try_`` kind: one bad field gives NULL, never a failed job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.config import AUDIT, TRACK_CTX, TRACK_MDC
from vigilog.functions import times, trails

# Levels, statuses and limits that classify a row.
ERROR_LEVELS = ("ERROR", "FATAL")
FAILED_STATUSES = ("FAILED", "ERROR", "TIMEOUT")
SUCCESS_STATUS = "COMPLETE"
FAILURE_CODES = (400, 599)
HIGH_RESPONSE_MS = 30_000

# Derived column → field of the message.
AUDIT_FIELDS = {
    "transaction_name": "TransactionName",
    "transaction_status": "TransactionStatus",
    "response_code": "ResponseCode",
    "host_name": "HostName",
    "host_ip": "HostIPAddress",
    "cluster": "Cluster",
    "instance_name": "InstanceName",
    "conversation_id": "ConversationId",
    "unique_transaction_id": "UniqueTransactionId",
    "application_id": "ApplicationId",
    "origination_system_name": "OriginationSystemName",
}
TRACK_FIELDS = {
    "conversation_id": "ConversationId",
    "service": "Service",
    "custom_tag": "CustomTag",
    "cluster": "Cluster",
    "vtier": "Vtier",
    "transaction_id": "TransactionId",
    "instance_name": "InstanceName",
    "host_ip": "HostIPAddress",
    "host_name": "HostName",
    "client_id": "ClientId",
    "application": "Application",
    "req_msg_size": "ReqMsgSize",
    "resp_msg_size": "RespMsgSize",
}
FAULT_FIELDS = {
    "external_fault_code": "ExternalFaultCode",
    "external_fault_description": "ExternalFaultDescription",
    "fault_entity": "FaultEntity",
}
TRACING_KEYS = {
    "service_name": "service.name",
    "span_id": "span_id",
    "trace_id": "trace_id",
    "trace_flags": "trace_flags",
}


def _flag(condition: Column) -> Column:
    """Two-valued: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def _flatten(fields: dict[str, str]) -> dict[str, Column]:
    return {name: F.col("message")[source] for name, source in fields.items()}


def _tracing(tags: str) -> dict[str, Column]:
    return {name: F.col(tags)[key] for name, key in TRACING_KEYS.items()}


def _assemble(df: DataFrame, log_timestamp: Column, derived: dict[str, Column]) -> DataFrame:
    head = {
        "ingestion_timestamp": F.current_timestamp(),
        "log_timestamp": log_timestamp,
        "log_date": times.utc_day(log_timestamp),
        "is_error": _flag(F.col("level").isin(*ERROR_LEVELS)),
    }
    columns = [value.alias(name) for name, value in {**head, **derived}.items()]
    return df.select("*", *columns)


def normalize_audit(df: DataFrame) -> DataFrame:
    message = F.col("message")
    status = message["TransactionStatus"]
    initiated = times.parse_zulu(message["InitiatedTimestamp"])
    fault = times.parse_zulu(message["FaultTimestamp"])
    elapsed = message["ElapsedTime"].try_cast("bigint")
    calculated = (F.unix_timestamp(fault) - F.unix_timestamp(initiated)) * 1000
    return _assemble(
        df,
        times.epoch_millis(F.col("timeMillis")),
        {
            **_flatten(AUDIT_FIELDS),
            "elapsed_time_ms": elapsed,
            "initiated_timestamp": initiated,
            "fault_timestamp": fault,
            "is_failure": _flag(status.isin(*FAILED_STATUSES)),
            "is_success": _flag(status == SUCCESS_STATUS),
            "response_time_calculated_ms": calculated,
            "response_time_ms": F.coalesce(elapsed, calculated),
            **_tracing("contextMap"),
        },
    )


def _track_columns() -> dict[str, Column]:
    marks = F.col("message")["TrailMarks"]
    incomplete = trails.any_incomplete(marks)
    elapsed = trails.total_elapsed(marks)
    return {
        **_flatten(TRACK_FIELDS),
        "trail_marks_count": trails.mark_count(marks),
        "has_incomplete_trails": incomplete,
        "total_elapsed_ms": elapsed,
        "operation_start_timestamp": trails.first_mark_time(marks, "StartTime"),
        "operation_end_timestamp": trails.first_mark_time(marks, "EndTime"),
        "is_timeout": incomplete,
        "is_high_response_time": _flag(elapsed > HIGH_RESPONSE_MS),
    }


def normalize_track_mdc(df: DataFrame) -> DataFrame:
    return _assemble(
        df, times.parse_offset(F.col("timestamp")), {**_track_columns(), **_tracing("mdc")}
    )


def normalize_track_ctx(df: DataFrame) -> DataFrame:
    code = F.col("message")["ResponseCode"]
    return _assemble(
        df,
        times.epoch_millis(F.col("timeMillis")),
        {
            **_track_columns(),
            "response_code": code,
            "is_failure": _flag(code.try_cast("int").between(*FAILURE_CODES)),
            **_tracing("contextMap"),
            **_flatten(FAULT_FIELDS),
        },
    )


NORMALIZERS = {
    AUDIT: normalize_audit,
    TRACK_MDC: normalize_track_mdc,
    TRACK_CTX: normalize_track_ctx,
}


def normalize(df: DataFrame, family: str) -> DataFrame:
    return NORMALIZERS[family](df)
