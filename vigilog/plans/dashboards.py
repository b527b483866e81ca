"""Dashboard queries as SQL text over a DataFrame handed to ``spark.sql``.

``as_of`` replaces the wall clock and bounds each range from above, so a past moment
can be shown again. Every ORDER BY ends in a total order. The texts are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from vigilog.config import Span, utc
from vigilog.functions.times import prune_dates
from vigilog.plans.monitoring import WINDOW_DATE
from vigilog.sources.tables import DETECTED_DATE


@dataclass(frozen=True)
class Dashboard:
    """``reach``: how far before ``as_of`` the text looks; None where it looks at everything."""

    reach: timedelta | None
    text: str


ANOMALIES_OVER_TIME = Dashboard(
    timedelta(hours=24),
    """
SELECT date_trunc('hour', detected_at) AS hour, anomaly_type, severity, count(*) AS count
FROM {anomalies}
WHERE detected_at BETWEEN :as_of - INTERVAL 24 HOURS AND :as_of
GROUP BY date_trunc('hour', detected_at), anomaly_type, severity
ORDER BY hour DESC, count DESC, anomaly_type, severity
""",
)

TOP_SERVICES = Dashboard(
    timedelta(days=7),
    """
SELECT affected_service,
       count(*) AS total_anomalies,
       count_if(severity = 'CRITICAL') AS critical,
       count_if(severity = 'HIGH') AS high,
       count_if(severity = 'MEDIUM') AS medium,
       max(detected_at) AS last_anomaly
FROM {anomalies}
WHERE detected_at BETWEEN :as_of - INTERVAL 7 DAYS AND :as_of
GROUP BY affected_service
ORDER BY total_anomalies DESC, affected_service NULLS FIRST
LIMIT 20
""",
)

RECENT_CRITICAL = Dashboard(
    timedelta(hours=24),
    """
SELECT detected_at, anomaly_type, affected_service, affected_cluster,
       metric_name, metric_value, threshold_value, details
FROM {anomalies}
WHERE severity = 'CRITICAL' AND detected_at BETWEEN :as_of - INTERVAL 24 HOURS AND :as_of
ORDER BY detected_at DESC, anomaly_type, affected_service
""",
)

LAST_DAY_BY_SEVERITY = Dashboard(
    timedelta(hours=24),
    """
SELECT severity, anomaly_type, count(*) AS count
FROM {anomalies}
WHERE detected_at BETWEEN :as_of - INTERVAL 24 HOURS AND :as_of
GROUP BY severity, anomaly_type
ORDER BY severity, count DESC, anomaly_type
""",
)

LAST_WEEK_TOP_SERVICES = Dashboard(
    timedelta(days=7),
    """
SELECT affected_service, count(*) AS anomaly_count
FROM {anomalies}
WHERE detected_at BETWEEN :as_of - INTERVAL 7 DAYS AND :as_of
GROUP BY affected_service
ORDER BY anomaly_count DESC, affected_service NULLS FIRST
LIMIT 10
""",
)

# Queries over profile tables. ``window`` holds the start and end of each period.
RESPONSE_TREND = Dashboard(
    timedelta(days=7),
    """
SELECT window.start AS time_window, granularity, slice_key, slice_value,
       avg_response_time_ms, p95_response_time_ms, high_response_time_count
FROM {profile}
WHERE window.start BETWEEN :as_of - INTERVAL 7 DAYS AND :as_of
ORDER BY window.start, granularity, slice_key, slice_value
""",
)

TIMEOUT_PERCENT = Dashboard(
    timedelta(days=7),
    """
SELECT window.start AS time_window, granularity, slice_key, slice_value,
       timeout_rate * 100 AS timeout_rate_percent,
       incomplete_trails_rate * 100 AS incomplete_rate_percent,
       avg_total_elapsed_ms
FROM {profile}
WHERE window.start BETWEEN :as_of - INTERVAL 7 DAYS AND :as_of
ORDER BY window.start, granularity, slice_key, slice_value
""",
)

SEVERITY_PERCENT = Dashboard(
    timedelta(days=7),
    """
SELECT window.start AS time_window, granularity, slice_key, slice_value,
       critical_anomaly_rate * 100 AS critical_percent,
       high_anomaly_rate * 100 AS high_percent,
       unique_anomaly_types
FROM {profile}
WHERE window.start BETWEEN :as_of - INTERVAL 7 DAYS AND :as_of
ORDER BY window.start, granularity, slice_key, slice_value
""",
)

SAMPLE_METRICS = Dashboard(
    timedelta(days=7),
    """
SELECT window.start AS time_window, granularity, slice_key, slice_value,
       avg_response_time_ms, p95_response_time_ms, hourly_failure_rate, error_rate,
       high_response_time_count, unique_services
FROM {profile}
WHERE window.start BETWEEN :as_of - INTERVAL 7 DAYS AND :as_of
ORDER BY window.start DESC, granularity, slice_key, slice_value
LIMIT 10
""",
)


def dashboard(query: Dashboard | str, as_of: datetime, **tables: DataFrame) -> DataFrame:
    """Run one of the above or a text, e.g. ``dashboard(TOP_SERVICES, now, anomalies=df)``.

    Tables partitioned by date are narrowed to the dates that the query reaches. A plain text
    reads everything it asks for.
    """
    now = utc(as_of)
    if isinstance(query, str):
        query = Dashboard(None, query)
    if query.reach is not None:
        reach = [Span(now - query.reach, now)]
        for name, table in tables.items():
            for column in (DETECTED_DATE, WINDOW_DATE):
                table = prune_dates(table, column, reach)
            tables[name] = table
    spark = next(iter(tables.values())).sparkSession
    return spark.sql(query.text, args={"as_of": now}, **tables)
