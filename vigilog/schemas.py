"""Declared schemas. Nothing is ever inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

from vigilog.config import AUDIT, TRACK_CTX, TRACK_MDC

CORRUPT = "_corrupt_record"
TAGS = T.MapType(T.StringType(), T.StringType())


def _texts(names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names.split()]


# Field names and order of the audit message.
AUDIT_MESSAGE = T.StructType(
    _texts(
        """
        Description InstanceName ApplicationId OriginalMessageId UniqueTransactionId
        OriginatorId Subject ConversationId OriginationSystemId OriginationSystemVersion
        OriginationSystemName SourceClass SourceMethod TransactionName TransactionStatus
        HostIPAddress HostName ResponseCode ResponseDescription FaultTimestamp
        FaultSequenceNumber FaultLevel FaultCode FaultDescription ExternalFaultCode
        ExternalFaultDescription FaultEntity InitiatedTimestamp ElapsedTime Mode
        ServiceKeyData1 ServiceKeyData2 Cluster ClientApp Vtier ClientIP HttpMethod
        RequestURL
        """
    )
)

# One step of a tracked operation.
TRAIL_MARK = T.StructType(
    _texts("Name Detail StartTime EndTime")
    + [
        T.StructField("Complete", T.BooleanType()),
        T.StructField("ElapsedDuration", T.LongType()),
    ]
)

# Field names and order of the tracking message.
TRACK_MESSAGE = T.StructType(
    _texts("ConversationId ClientApp ClientDME2Lookup Mode Service CustomTag")
    + [T.StructField("TrailMarks", T.ArrayType(TRAIL_MARK))]
    + _texts(
        """
        Cluster Token Vtier TransactionId InstanceName HostIPAddress ClientId
        StartTimeStamp Application
        """
    )
    + [T.StructField("ReqMsgSize", T.LongType()), T.StructField("RespMsgSize", T.LongType())]
    + _texts("HostName")
)

# The fault fields that context-map feeds add to the tracking message.
TRACK_FAULT_FIELDS = _texts("ResponseCode ExternalFaultCode ExternalFaultDescription FaultEntity")


def _context_envelope(message: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("contextMap", TAGS), T.StructField("endOfBatch", T.BooleanType())]
        + _texts("filename level log_uuid loggerFqcn loggerName")
        + [T.StructField("message", message)]
        + _texts("thread")
        + [
            T.StructField("threadId", T.LongType()),
            T.StructField("threadPriority", T.LongType()),
            T.StructField("timeMillis", T.LongType()),
        ]
    )


RAW_SCHEMAS = {
    AUDIT: _context_envelope(AUDIT_MESSAGE),
    TRACK_MDC: T.StructType(
        _texts("context filename level log_uuid logger")
        + [T.StructField("mdc", TAGS), T.StructField("message", TRACK_MESSAGE)]
        + _texts("raw-message thread timestamp")
    ),
    TRACK_CTX: _context_envelope(T.StructType(TRACK_MESSAGE.fields + TRACK_FAULT_FIELDS)),
}


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The same schema with room for the text of a line that is not JSON."""
    return T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])


# Columns and types of the anomalies table.
ANOMALIES = T.StructType(
    [
        T.StructField("anomaly_id", T.StringType(), False),
        T.StructField("anomaly_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("detected_at", T.TimestampType()),
        T.StructField("time_window_start", T.TimestampType()),
        T.StructField("time_window_end", T.TimestampType()),
        T.StructField("affected_service", T.StringType()),
        T.StructField("affected_instance", T.StringType()),
        T.StructField("affected_cluster", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("threshold_value", T.DoubleType()),
        T.StructField("baseline_value", T.DoubleType()),
        T.StructField("details", T.StringType()),
        T.StructField("log_count", T.LongType()),
        T.StructField("metadata", TAGS),
    ]
)

# Columns that exist once anomalies have been acknowledged.
ACKNOWLEDGEMENT = T.StructType(
    [
        T.StructField("acknowledged", T.BooleanType()),
        T.StructField("acknowledged_at", T.TimestampType()),
        T.StructField("acknowledged_by", T.StringType()),
    ]
)
