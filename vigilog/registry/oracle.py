"""The registered queries again, as plain SQL over the base tables.

Written independently of the Spark plans: windows are cross-joined, percentiles and
joins are the engine's own, and nothing is pre-aggregated.
"""

from __future__ import annotations

LOG_EVENTS = """
base AS (
  SELECT event_id, ts, 'svc_' || (user_id % 5) AS svc, 'inst_' || user_id AS inst,
         'c' || (user_id % 3) AS cluster, event_type,
         (ts > TIMESTAMP '2024-01-26' AND ts <= TIMESTAMP '2024-01-29') AS inj,
         CAST(floor(value * 200) AS BIGINT) AS ms
  FROM events
),
log_events AS (
  SELECT event_id * 10 + k AS log_id, event_id, ts AS log_timestamp, svc, inst, cluster,
         event_type,
         CASE WHEN inj AND svc = 'svc_3' THEN event_type IN ('error', 'click', 'view')
              WHEN svc = 'svc_2' THEN inj AND event_type = 'error'
              ELSE event_type = 'error' END AS is_failure,
         CASE WHEN inj AND svc = 'svc_1' THEN ms * 5 ELSE ms END AS ms,
         event_type = 'signup' AND event_id % 2 = 0 AS has_incomplete
  FROM base, generate_series(0, 4) g(k)
  WHERE (k = 0 OR (inj AND svc = 'svc_0'))
    AND NOT (inj AND svc = 'svc_4' AND event_id % 5 <> 0)
)
"""

FEEDS = """
feeds AS (
  SELECT 'bpm_audit' AS log_type, 'bpm_audit_logs' AS source_table, TRUE AS is_audit, * FROM log_events
  UNION ALL
  SELECT 'm2e_perf', 'm2e_perf_logs', FALSE, * FROM log_events
)
"""

ONE_RUN = "runs AS (SELECT TIMESTAMP '2024-01-29' AS now)"
THREE_RUNS = """
runs AS (
  SELECT unnest([TIMESTAMP '2024-01-28', TIMESTAMP '2024-01-28 12:00:00', TIMESTAMP '2024-01-29']) AS now
)
"""

CURRENT = "log_timestamp BETWEEN now - INTERVAL 72 HOUR AND now"
LONG = "log_timestamp BETWEEN now - INTERVAL 120 HOUR AND now"
BASELINE = "log_timestamp BETWEEN now - INTERVAL 21 DAY AND now - INTERVAL 72 HOUR"
HEARTBEAT = "log_timestamp >= now - INTERVAL 24 HOUR"

NAMED = "CASE WHEN is_audit THEN coalesce(svc, '{}') ELSE svc END"

DETECTORS = f"""
d1_now AS (
  SELECT now, log_type, source_table, svc, count(*) AS n,
         count(*) FILTER (WHERE is_failure) AS failures
  FROM runs, feeds WHERE is_audit AND {CURRENT} GROUP BY ALL
),
d1_then AS (
  SELECT now, log_type, svc, count(*) AS n, count(*) FILTER (WHERE is_failure) AS failures
  FROM runs, feeds WHERE is_audit AND {BASELINE} GROUP BY ALL
),
d1 AS (
  SELECT a.*, b.n AS baseline_total, 100.0 * a.failures / a.n AS cur,
         100.0 * b.failures / b.n AS base,
         (100.0 * a.failures / a.n) / (100.0 * b.failures / b.n + 0.01) AS ratio
  FROM d1_now a JOIN d1_then b USING (now, log_type, svc)
  WHERE a.n >= 10 AND (100.0 * a.failures / a.n) / (100.0 * b.failures / b.n + 0.01) >= 2.0
),
d2 AS (
  SELECT DISTINCT now, log_type, {NAMED.format('unknown')} AS svc, inst, cluster FROM runs, feeds
  WHERE {BASELINE} AND (is_audit OR svc IS NOT NULL)
  EXCEPT
  SELECT DISTINCT now, log_type, {NAMED.format('unknown')}, inst, cluster FROM runs, feeds WHERE {HEARTBEAT}
),
d3_all AS (
  SELECT now, log_type, source_table, svc, count(*) AS n, avg(ms) AS mean,
         quantile_cont(ms, 0.95) AS p95, quantile_cont(ms, 0.99) AS p99
  FROM runs, feeds WHERE {LONG} AND ms IS NOT NULL GROUP BY ALL
),
d3 AS (
  SELECT *, p99 > 60000 AS worst FROM d3_all WHERE n >= 10 AND (p95 > 30000 OR p99 > 60000)
),
d4 AS (
  SELECT now, log_type, source_table, svc, cluster, count(*) AS n, avg(ms) AS mean
  FROM runs, feeds WHERE NOT is_audit AND {LONG} AND has_incomplete
  GROUP BY ALL HAVING count(*) >= 3
),
d5_now AS (
  SELECT now, log_type, {NAMED.format('audit_service')} AS svc, count(*) AS n FROM runs, feeds
  WHERE {CURRENT} AND (is_audit OR svc IS NOT NULL) GROUP BY ALL
),
d5_buckets AS (
  SELECT now, log_type, {NAMED.format('audit_service')} AS svc, floor(epoch(log_timestamp) / (72 * 3600)) AS bucket, count(*) AS n
  FROM runs, feeds WHERE {BASELINE} GROUP BY ALL
),
d5_then AS (
  SELECT now, log_type, svc, avg(n) AS mean FROM d5_buckets GROUP BY ALL
),
d5 AS (
  SELECT a.*, mean, a.n / (mean + 0.1) AS ratio, a.n / (mean + 0.1) > 3.0 AS spike
  FROM d5_now a JOIN d5_then b USING (now, log_type, svc)
  WHERE a.n / (mean + 0.1) > 3.0 OR a.n / (mean + 0.1) < 1 / 3.0::DOUBLE
),
d6_now AS (
  SELECT now, log_type, source_table, svc, inst, avg(ms) AS mean, count(*) AS n
  FROM runs, feeds WHERE NOT is_audit AND {CURRENT} AND ms IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 5
),
d6_then AS (
  SELECT now, log_type, svc, inst, avg(ms) AS mean, count(*) AS n
  FROM runs, feeds WHERE NOT is_audit AND {BASELINE} AND ms IS NOT NULL
  GROUP BY ALL HAVING count(*) >= 10
),
d6 AS (
  SELECT a.*, b.mean AS base, b.n AS baseline_count,
         (a.mean - b.mean) / nullif(b.mean, 0) * 100 AS pct
  FROM d6_now a JOIN d6_then b USING (now, log_type, svc, inst)
  WHERE (a.mean - b.mean) / nullif(b.mean, 0) * 100 >= 50
)
"""


def _record(
    kind: str,
    severity: str,
    hours: int,
    service: str,
    metric: str,
    value: str,
    threshold: str,
    details: str,
    instance: str = "NULL",
    cluster: str = "NULL",
    baseline: str = "NULL",
    log_count: str = "NULL",
) -> str:
    """The columns of an anomaly; ``kind`` and the others are SQL expressions."""
    parts = [
            kind,
            "CAST(CAST(epoch(now) AS BIGINT) AS VARCHAR)",
            "log_type",
            service,
            instance,
            cluster,
    ]
    parts = ", ".join(f"coalesce(length({p}) || ':' || ({p}), '~')" for p in parts)
    return f"""
    md5(concat_ws('|', {parts})) AS anomaly_id,
    {kind} AS anomaly_type,
    {severity} AS severity,
    now AS detected_at,
    now - INTERVAL {hours} HOUR AS time_window_start,
    now AS time_window_end,
    {service} AS affected_service,
    CAST({instance} AS VARCHAR) AS affected_instance,
    CAST({cluster} AS VARCHAR) AS affected_cluster,
    {metric} AS metric_name,
    CAST({value} AS DOUBLE) AS metric_value,
    CAST({threshold} AS DOUBLE) AS threshold_value,
    CAST({baseline} AS DOUBLE) AS baseline_value,
    CAST({log_count} AS BIGINT) AS log_count,
    {details} AS details
    """


RECORDS = {
    "d1": _record(
        "'FAILURE_RATE_SPIKE'",
        "CASE WHEN ratio >= 5 THEN 'CRITICAL' ELSE 'HIGH' END",
        72,
        "svc",
        "'failure_rate_percent'",
        "cur",
        "base * 2.0",
        "printf('Failure rate spike detected in %s: %.2f%% vs baseline %.2f%%', "
        "source_table, cur::DOUBLE, base::DOUBLE)",
        baseline="base",
        log_count="n",
    ),
    "d2": _record(
        "'MISSING_HEARTBEAT'",
        "'HIGH'",
        24,
        "svc",
        "'minutes_since_last_log'",
        "1440",
        "1440",
        "'No logs received from ' || svc || ' in the last 1440 minutes'",
        instance="inst",
        cluster="cluster",
    ),
    "d3": _record(
        "'HIGH_RESPONSE_TIME'",
        "CASE WHEN worst THEN 'CRITICAL' ELSE 'HIGH' END",
        120,
        "svc",
        "CASE WHEN worst THEN 'p99_response_time_ms' ELSE 'p95_response_time_ms' END",
        "CASE WHEN worst THEN p99 ELSE p95 END",
        "CASE WHEN worst THEN 60000 ELSE 30000 END",
        "printf('High response time detected in %s: %s=%.0fms (avg: %.0fms)', source_table, "
        "CASE WHEN worst THEN 'p99_response_time_ms' ELSE 'p95_response_time_ms' END, "
        "CASE WHEN worst THEN p99 ELSE p95 END, mean)",
        baseline="mean",
        log_count="n",
    ),
    "d4": _record(
        "'TRANSACTION_TIMEOUT'",
        "'HIGH'",
        120,
        "svc",
        "'timeout_count'",
        "n",
        "3",
        "'Multiple incomplete transactions detected in ' || source_table || ': ' || n || ' timeouts'",
        cluster="cluster",
        log_count="n",
    ),
    "d5": _record(
        "CASE WHEN spike THEN 'VOLUME_SPIKE' ELSE 'VOLUME_DROP' END",
        "CASE WHEN spike THEN 'MEDIUM' ELSE 'HIGH' END",
        72,
        "svc",
        "'log_count'",
        "n",
        "mean * 3.0",
        "printf('Log volume %s in %s: %d logs vs baseline %.0f', "
        "CASE WHEN spike THEN 'spike' ELSE 'drop' END, log_type, n, mean)",
        baseline="mean",
        log_count="n",
    ),
    "d6": _record(
        "'SERVICE_DEGRADATION'",
        "CASE WHEN pct >= 100 THEN 'CRITICAL' ELSE 'HIGH' END",
        72,
        "svc",
        "'avg_response_time_ms'",
        "mean",
        "base * 1.5",
        "printf('Performance degradation in %s: %.1f%% slower than baseline (%.0fms vs %.0fms)', "
        "source_table, pct, mean, base)",
        instance="inst",
        baseline="base",
        log_count="n",
    ),
}

RECORD = (
    "anomaly_id, anomaly_type, severity, detected_at, time_window_start, time_window_end, "
    "affected_service, affected_instance, affected_cluster, metric_name, "
    "round(metric_value, 6) AS metric_value, round(threshold_value, 6) AS threshold_value, "
    "round(baseline_value, 6) AS baseline_value, log_count"
)


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(cte.strip() for cte in ctes) + "\n" + body


def _detector(name: str, **metadata: str) -> str:
    """The record and the metadata entries, given as alias=expression."""
    entries = ", ".join(f"{value} AS {alias}" for alias, value in metadata.items())
    body = (
        f"SELECT {RECORD}, {', '.join(metadata)} "
        f"FROM (SELECT {RECORDS[name]}, {entries} FROM {name})"
    )
    return _with(LOG_EVENTS, FEEDS, ONE_RUN, DETECTORS, body=body)


ALL_ANOMALIES = (
    "anomalies AS ("
    + "\nUNION ALL\n".join(f"SELECT {RECORDS[name]} FROM {name}" for name in RECORDS)
    + ")"
)


#: The same with the feed that each was found in, and the detector's name.
BY_FEED = (
    "by_feed AS ("
    + "\nUNION ALL\n".join(
        f"SELECT '{detector}' AS detector, log_type AS feed, {RECORDS[name]} FROM {name}"
        for name, detector in zip(
            RECORDS,
            (
                "failure_rate_spikes", "missing_heartbeats", "high_response_times",
                "transaction_timeouts", "volume_anomalies", "service_degradation",
            ),
            strict=True,
        )
    )
    + ")"
)


def _over_run(body: str) -> str:
    """Over the anomalies of the last run."""
    return _with(LOG_EVENTS, FEEDS, ONE_RUN, DETECTORS, ALL_ANOMALIES, body=body)


def _over_table(body: str) -> str:
    """Over the anomalies table: the rows of all runs."""
    return _with(LOG_EVENTS, FEEDS, THREE_RUNS, DETECTORS, ALL_ANOMALIES, body=body)


RANK = "CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'LOW' THEN 4 ELSE 5 END"

MESSAGES = """
messages AS (
  SELECT anomaly_id AS id, anomaly_type AS type, severity, affected_service AS service,
         affected_instance AS instance, affected_cluster AS cluster,
         CASE WHEN metric_value <> 0 THEN metric_name || '=' || printf('%.2f', metric_value) END AS metric,
         threshold_value AS threshold, baseline_value AS baseline, details,
         strftime(time_window_start, '%Y-%m-%d %H:%M:%S') || ' to ' ||
         strftime(time_window_end, '%Y-%m-%d %H:%M:%S') AS time_window,
         detected_at
  FROM anomalies WHERE severity IN ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW')
)
"""


def _over_messages(body: str) -> str:
    return _with(LOG_EVENTS, FEEDS, ONE_RUN, DETECTORS, ALL_ANOMALIES, MESSAGES, body=body)


# --- raw feeds ---------------------------------------------------------------------


def _draw(salt: int, size: int) -> str:
    mixed = f"(event_id % 999983 * {104729 * (2 * salt + 1)} + {15485863 * salt})"
    return f"({mixed} % 1000003 % {size})"


OUTCOMES = f"""
outcomes AS (
  SELECT *, CASE WHEN {_draw(0, 7)} = 0 THEN (['slow', 'refused', 'stuck'])[{_draw(1, 3)} + 1] END
    AS outcome, CAST({_draw(2, 60)} + 500 AS VARCHAR) AS code,
    {_draw(3, 7000)} + 31000 AS slow, {_draw(4, 9000)} + 45000 AS stuck
  FROM events
),
told AS (
  SELECT event_id, ts, user_id, event_type,
    CASE outcome WHEN 'refused' THEN 'FAILED' WHEN 'stuck' THEN 'TIMEOUT' ELSE 'COMPLETE' END AS audit_status,
    CASE outcome WHEN 'refused' THEN code WHEN 'stuck' THEN '499' ELSE '200' END AS audit_code,
    CASE WHEN outcome IS NULL THEN {_draw(5, 900)} + 20 WHEN outcome = 'refused' THEN {_draw(6, 1000)} + 400
         WHEN outcome = 'slow' THEN slow ELSE stuck END AS audit_elapsed,
    CASE WHEN outcome = 'refused' THEN code END AS track_code,
    CASE WHEN outcome = 'stuck' THEN stuck WHEN outcome = 'slow' THEN slow ELSE {_draw(7, 60)} + 5 END
      AS track_elapsed,
    outcome IS DISTINCT FROM 'stuck' AS track_complete,
    CASE WHEN event_id % 19 <> 0 OR (ts > TIMESTAMP '2024-01-26' AND event_id % 95 <> 0)
      THEN 'svc_' || (user_id % 5) END AS service,
    CASE WHEN event_id % 43 <> 0 THEN 'c' || (user_id % 3) END AS cluster,
    CASE WHEN event_id % 41 <> 0 THEN 'inst_' || user_id END AS instance_name
  FROM outcomes
),
lines AS (
  SELECT *, make_timestamp(CAST(epoch_us(ts) // 100 * 100 AS BIGINT)) AS ts4,
         date_trunc('second', ts) AS ts0
  FROM told WHERE event_id % 97 <> 0
)
"""

TRACING = """
  CASE WHEN event_id % 2 = 0 THEN 'app-' || (user_id % 5) END AS service_name,
  CASE WHEN event_id % 2 = 0 THEN 'span-' || event_id END AS span_id,
  CASE WHEN event_id % 2 = 0 THEN 'trace-' || (event_id % 1000) END AS trace_id,
  CAST(NULL AS VARCHAR) AS trace_flags
"""

AUDIT = f"""
audit AS (
  SELECT ts0 AS log_timestamp, CAST(ts AS DATE) AS log_date,
    service AS transaction_name,
    audit_status AS transaction_status, audit_code AS response_code,
    'host-' || (user_id % 50) AS host_name, '10.0.0.' || (user_id % 50) AS host_ip,
    cluster, instance_name, 'conv-' || event_id AS conversation_id, 'txn-' || event_id AS unique_transaction_id,
    event_type AS application_id, 'portal' AS origination_system_name,
    CASE WHEN event_id % 11 <> 0 THEN audit_elapsed END AS elapsed_time_ms,
    CASE WHEN event_id % 13 <> 0 THEN ts4 END AS initiated_timestamp,
    CASE WHEN event_type = 'error' THEN ts0 + to_seconds(event_id % 7) END AS fault_timestamp,
    event_type = 'error' AS is_error,
    audit_status <> 'COMPLETE' AS is_failure,
    audit_status = 'COMPLETE' AS is_success,
    CASE WHEN event_type = 'error' AND event_id % 13 <> 0 THEN event_id % 7 * 1000 END
      AS response_time_calculated_ms,
    coalesce(CASE WHEN event_id % 11 <> 0 THEN audit_elapsed END,
             CASE WHEN event_type = 'error' AND event_id % 13 <> 0 THEN event_id % 7 * 1000 END)
      AS response_time_ms,
    {TRACING}
  FROM lines
)
"""


def _mark(n: int) -> str:
    return f"""CASE WHEN event_id % 4 >= {n} AND (event_id + {n}) % 5 <> 0
               THEN track_elapsed + {n} ELSE 0 END"""


TRACK = f"""
marks AS (
  SELECT *,
    CASE WHEN event_id % 4 > 0 THEN event_id % 4 WHEN event_id % 8 = 0 THEN 0 END AS n_marks,
    CASE WHEN event_id % 4 = 0 THEN FALSE WHEN event_id % 23 <> 0 THEN NOT track_complete END
      AS incomplete,
    CASE WHEN event_id % 4 > 0 THEN {_mark(1)} + {_mark(2)} + {_mark(3)} END AS elapsed
  FROM lines
),
track AS (
  SELECT ts, ts0, event_id, event_type, track_code,
    'conv-' || event_id AS conversation_id,
    service, event_type AS custom_tag, cluster, 'v' || (event_id % 2) AS vtier,
    'txn-' || event_id AS transaction_id, instance_name,
    '10.0.0.' || (user_id % 50) AS host_ip, 'host-' || (user_id % 50) AS host_name,
    event_type AS client_id, 'app-' || (user_id % 7) AS application,
    event_id % 5000 AS req_msg_size, event_id % 1000 AS resp_msg_size,
    n_marks AS trail_marks_count, incomplete AS has_incomplete_trails,
    elapsed AS total_elapsed_ms,
    CASE WHEN n_marks > 0 AND event_id % 17 <> 0 THEN ts4 END AS operation_start_timestamp,
    CASE WHEN n_marks > 0 AND track_complete THEN ts0 + INTERVAL 1 SECOND END
      AS operation_end_timestamp,
    event_type = 'error' AS is_error, incomplete AS is_timeout,
    coalesce(elapsed > 30000, FALSE) AS is_high_response_time,
    {TRACING}
  FROM marks
),
track_mdc AS (
  SELECT CASE WHEN event_id % 29 <> 0 THEN date_trunc('millisecond', ts) END AS log_timestamp,
         CASE WHEN event_id % 29 <> 0 THEN CAST(ts AS DATE) END AS log_date,
         * EXCLUDE (ts, ts0, event_id, event_type, track_code)
  FROM track
),
coded AS (
  SELECT *, coalesce(CASE WHEN event_id % 31 = 0 THEN 'E500' WHEN event_id % 37 = 0 THEN '399' END,
                     track_code) AS response_code
  FROM track
),
track_ctx AS (
  SELECT ts0 AS log_timestamp, CAST(ts AS DATE) AS log_date,
         * EXCLUDE (ts, ts0, event_id, event_type, track_code),
         coalesce(TRY_CAST(response_code AS INTEGER) BETWEEN 400 AND 599, FALSE) AS is_failure,
         CASE WHEN track_code IS NOT NULL THEN '1' END AS external_fault_code,
         CASE WHEN track_code IS NOT NULL THEN 'BackendRefused' END
           AS external_fault_description,
         CASE WHEN track_code IS NOT NULL THEN 'backend' END AS fault_entity
  FROM coded
)
"""


# The six feeds, each from a sixth of the events, as their normalised lines.
LINE_FEEDS = """
feeds AS (
  SELECT f.key AS log_type, f.key || '_logs' AS source_table, TRUE AS is_audit, log_timestamp,
         transaction_name AS svc, instance_name AS inst, cluster, is_failure,
         response_time_ms AS ms, FALSE AS has_incomplete
  FROM audit JOIN (VALUES ('bpm_audit', 0), ('m2e_audit', 1)) f(key, n)
    ON CAST(substr(conversation_id, 6) AS BIGINT) % 6 = f.n
  UNION ALL
  SELECT f.key, f.key || '_logs', FALSE, log_timestamp, service, instance_name, cluster, NULL,
         total_elapsed_ms, has_incomplete_trails
  FROM track_mdc JOIN (VALUES ('bpm_adapter', 2), ('bpm_perf', 3)) f(key, n)
    ON CAST(substr(conversation_id, 6) AS BIGINT) % 6 = f.n
  UNION ALL
  SELECT f.key, f.key || '_logs', FALSE, log_timestamp, service, instance_name, cluster, NULL,
         total_elapsed_ms, has_incomplete_trails
  FROM track_ctx JOIN (VALUES ('m2e_perf', 4), ('maf_perf', 5)) f(key, n)
    ON CAST(substr(conversation_id, 6) AS BIGINT) % 6 = f.n
)
"""


def _over_lines(body: str) -> str:
    return _with(OUTCOMES, AUDIT, TRACK, LINE_FEEDS, ONE_RUN, DETECTORS, ALL_ANOMALIES, body=body)


def _over_audit(body: str) -> str:
    return _with(OUTCOMES, AUDIT, body=body)


def _over_track(body: str) -> str:
    return _with(OUTCOMES, TRACK, body=body)


# --- profiles ----------------------------------------------------------------------

AUDIT_TABLE = """
audit_table AS (
  SELECT log_id, log_timestamp AS t, svc AS transaction_name, inst AS instance_name, cluster,
         is_failure, event_type = 'error' AS is_error, ms AS response_time_ms
  FROM log_events
)
"""
TRACK_TABLE = """
track_table AS (
  SELECT log_timestamp AS t, svc AS service, cluster, event_type AS application,
         ms AS total_elapsed_ms, has_incomplete AS has_incomplete_trails,
         event_id % 3 + 1 AS trail_marks_count
  FROM log_events
)
"""


def _profile(table: str, slices: list[str], metrics: str) -> str:
    parts = ["SELECT *, NULL AS slice_key, NULL AS slice_value FROM periods"]
    parts += [f"SELECT *, '{s}', {s} FROM periods" for s in slices]
    return f"""
periods AS (
  SELECT *, make_timestamp(CAST(floor(epoch(t) / secs) AS BIGINT) * secs * 1000000) AS window_start
  FROM {table}, (VALUES ('1 hour', 3600), ('1 day', 86400)) g(granularity, secs)
),
sliced AS ({" UNION ALL ".join(parts)}),
profile AS (
  SELECT window_start, window_start + to_seconds(secs) AS window_end, granularity,
         slice_key, slice_value, count(*) AS row_count, {metrics}
  FROM sliced GROUP BY window_start, secs, granularity, slice_key, slice_value
)
"""


AUDIT_PROFILE = _profile(
    "audit_table",
    ["transaction_name", "cluster"],
    """
    avg(CAST(is_failure AS INTEGER)) AS hourly_failure_rate,
    avg(response_time_ms) AS avg_response_time_ms,
    quantile_cont(response_time_ms, 0.95) AS p95_response_time_ms,
    count(*) FILTER (WHERE response_time_ms > 30000) AS high_response_time_count,
    count(DISTINCT transaction_name) AS unique_services,
    avg(CAST(is_error AS INTEGER)) AS error_rate
    """,
)
TRACK_A_PROFILE = _profile(
    "track_table",
    ["service", "cluster"],
    """
    avg(CAST(has_incomplete_trails AS INTEGER)) AS timeout_rate,
    avg(total_elapsed_ms) AS avg_total_elapsed_ms,
    avg(CAST(has_incomplete_trails AS INTEGER)) AS incomplete_trails_rate,
    avg(CAST(total_elapsed_ms > 30000 AS INTEGER)) AS high_response_rate
    """,
)
TRACK_B_PROFILE = _profile(
    "track_table",
    ["service", "cluster", "application"],
    """
    avg(total_elapsed_ms) AS avg_response_time_ms,
    CAST(max(total_elapsed_ms) AS DOUBLE) AS max_response_time_ms,
    avg(CAST(has_incomplete_trails AS INTEGER)) AS incomplete_operations_rate,
    avg(CAST(total_elapsed_ms > 60000 AS INTEGER)) AS very_high_response_rate,
    avg(trail_marks_count) AS avg_trail_marks_count
    """,
)
ANOMALY_PROFILE = "anomaly_table AS (SELECT detected_at AS t, * FROM anomalies)," + _profile(
    "anomaly_table",
    ["anomaly_type", "severity", "affected_service"],
    """
    avg(CAST(severity = 'CRITICAL' AS INTEGER)) AS critical_anomaly_rate,
    avg(CAST(severity = 'HIGH' AS INTEGER)) AS high_anomaly_rate,
    count(DISTINCT anomaly_type) AS unique_anomaly_types,
    avg(metric_value) AS avg_metric_value,
    avg(metric_value / nullif(threshold_value, 0)) AS avg_threshold_breach_ratio
    """,
)

PROFILE_KEYS = "window_start, window_end, granularity, slice_key, slice_value, row_count"
AUDIT_PROFILE_QUERY = _with(
    LOG_EVENTS,
    AUDIT_TABLE,
    AUDIT_PROFILE,
    body=f"""SELECT {PROFILE_KEYS}, round(hourly_failure_rate, 6) AS hourly_failure_rate,
    round(avg_response_time_ms, 6) AS avg_response_time_ms,
    round(p95_response_time_ms, 6) AS p95_response_time_ms,
    high_response_time_count, unique_services, round(error_rate, 6) AS error_rate
    FROM profile""",
)
OWN_PROFILE = _profile(
    "audit_table",
    ["transaction_name", "cluster"],
    """
    count(*) FILTER (WHERE is_failure AND response_time_ms > 10000)::DOUBLE
        / greatest(count(*) FILTER (WHERE is_failure), 1) AS slow_failure_share,
    max(response_time_ms) - min(response_time_ms) AS ms_range,
    stddev_pop(response_time_ms) AS ms_deviation,
    count(DISTINCT instance_name) AS instances
    """,
)
LAST_WEEK = "window_start BETWEEN TIMESTAMP '2024-01-22' AND TIMESTAMP '2024-01-29'"
PERIOD = "window_start AS time_window, granularity, slice_key, slice_value"

LOG_TABLE = """
SELECT log_id, log_timestamp, svc AS transaction_name, inst AS instance_name, cluster, is_failure,
       event_type = 'error' AS is_error, ms AS response_time_ms, CAST(log_timestamp AS DATE) AS log_date
FROM log_events {where}
"""
KEPT = "WHERE log_timestamp >= TIMESTAMP '2024-04-15 06:00:00' - INTERVAL 90 DAY"

DRIFT_METRICS = (
    "hourly_failure_rate",
    "avg_response_time_ms",
    "p95_response_time_ms",
    "high_response_time_count",
    "unique_services",
    "error_rate",
)


def _drift() -> str:
    long = " UNION ALL ".join(
        f"""SELECT granularity, window_start, slice_key, slice_value, '{m}' AS metric_name,
            CAST({m} AS DOUBLE) AS value FROM profile"""
        for m in DRIFT_METRICS
    )
    over = "(PARTITION BY granularity, slice_key, slice_value, metric_name ORDER BY window_start)"
    return f"""
SELECT granularity, window_start, previous_start, slice_key, slice_value, metric_name,
       round(value, 9) AS value, round(previous_value, 9) AS previous_value,
       round(value - previous_value, 9) AS absolute_change,
       round((value - previous_value) / nullif(previous_value, 0), 9) AS relative_change
FROM (
  SELECT *, lag(window_start) OVER {over} AS previous_start,
         lag(value) OVER {over} AS previous_value
  FROM ({long})
) WHERE previous_start IS NOT NULL
"""


ORACLE: dict[str, str] = {
    "d1_failure_rate_spike": _detector(
        "d1",
        rate_multiplier="round(ratio, 6)",
        failure_count="failures",
        baseline_total="baseline_total",
        source_table="source_table",
    ),
    "d2_missing_heartbeat": _detector("d2", log_type="log_type"),
    "d3_high_response_time": _detector(
        "d3", p95="round(p95, 6)", p99="round(p99, 6)", source_table="source_table"
    ),
    "d4_transaction_timeout": _detector(
        "d4", avg_elapsed_before_timeout_ms="round(mean, 6)", source_table="source_table"
    ),
    "d5_volume_anomaly": _detector("d5", volume_ratio="round(ratio, 6)", source_table="log_type"),
    "d6_service_degradation": _detector(
        "d6",
        degradation_percent="round(pct, 6)",
        baseline_count="baseline_count",
        source_table="source_table",
    ),
    "anomalies_union": _over_run(f"SELECT {RECORD} FROM anomalies"),
    "anomaly_summary": _over_run(
        "SELECT anomaly_type, severity, count(*) AS count FROM anomalies GROUP BY ALL"
    ),
    "anomaly_details": _over_run("SELECT anomaly_id, details FROM anomalies"),
    "normalize_audit": _over_audit("SELECT * FROM audit"),
    "normalize_track_mdc": _over_track("SELECT * FROM track_mdc"),
    "normalize_track_ctx": _over_track("SELECT * FROM track_ctx"),
    "trail_metrics": _over_track(
        """SELECT conversation_id, trail_marks_count, has_incomplete_trails, total_elapsed_ms,
        operation_start_timestamp, operation_end_timestamp FROM track_mdc"""
    ),
    "failure_classify": _over_track(
        """SELECT conversation_id, response_code, is_error, is_failure, is_timeout,
        is_high_response_time FROM track_ctx"""
    ),
    "response_time_derive": _over_audit(
        """SELECT conversation_id, elapsed_time_ms, initiated_timestamp, fault_timestamp,
        response_time_calculated_ms, response_time_ms FROM audit"""
    ),
    "corrupt_rows": "SELECT 'not json ' || event_id AS line FROM events WHERE event_id % 97 = 0",
    "alert_recent": _over_run(f"SELECT {RECORD} FROM anomalies"),
    "alert_by_severity": _over_run(
        "SELECT severity, count(*) AS count FROM anomalies GROUP BY severity"
    ),
    "alert_by_type": _over_run(
        "SELECT anomaly_type, severity, count(*) AS count FROM anomalies GROUP BY ALL"
    ),
    "alert_top_services": _over_run(
        f"""SELECT affected_service, count(*) AS anomaly_count,
        count(DISTINCT anomaly_type) AS anomaly_types, max(severity) AS max_severity,
        arg_min(severity, {RANK}) AS worst_severity
        FROM anomalies WHERE affected_service IS NOT NULL GROUP BY affected_service
        ORDER BY anomaly_count DESC, affected_service LIMIT 10"""
    ),
    "alert_critical_detail": _over_run(
        """SELECT anomaly_type, affected_service, metric_name,
        round(metric_value, 6) AS metric_value, round(threshold_value, 6) AS threshold_value,
        details FROM anomalies WHERE severity = 'CRITICAL'"""
    ),
    "alert_messages": _over_messages(
        """SELECT * REPLACE (round(threshold, 6) AS threshold, round(baseline, 6) AS baseline)
        FROM messages"""
    ),
    "alert_rendered": _over_messages(
        """SELECT id, severity, concat_ws(chr(10),
          '[' || severity || '] ' || type,
          '  Service: ' || coalesce(nullif(service, ''), 'N/A'),
          '  Instance: ' || nullif(instance, ''),
          '  Cluster: ' || nullif(cluster, ''),
          '  Metric: ' || metric,
          CASE WHEN threshold <> 0 THEN '  Threshold: ' || printf('%.2f', threshold) END,
          CASE WHEN baseline <> 0 THEN '  Baseline: ' || printf('%.2f', baseline) END,
          '  Details: ' || details,
          '  Time Window: ' || time_window,
          '  Detected At: ' || strftime(detected_at, '%Y-%m-%d %H:%M:%S'),
          '') AS text FROM messages"""
    ),
    "alert_routing": _over_messages(
        """SELECT severity, CASE severity WHEN 'CRITICAL' THEN 'on-call'
        WHEN 'HIGH' THEN 'operations' ELSE 'dashboard' END AS route, count(*) AS count
        FROM messages GROUP BY ALL"""
    ),
    "alert_payload": _over_messages(
        """SELECT 'header' AS part, '2024-01-29T00:00:00' AS timestamp,
        'Log Anomaly Detection: ' || critical_count || ' CRITICAL, ' || high_count || ' HIGH alerts' AS summary,
        critical_count, high_count, CAST(NULL AS VARCHAR) AS severity, CAST(NULL AS VARCHAR) AS type,
        CAST(NULL AS VARCHAR) AS service, CAST(NULL AS VARCHAR) AS details
        FROM (SELECT count(*) FILTER (WHERE severity = 'CRITICAL') AS critical_count,
                     count(*) FILTER (WHERE severity = 'HIGH') AS high_count FROM messages)
        WHERE critical_count > 0 OR high_count > 0
        UNION ALL
        SELECT 'alert', NULL, NULL, NULL, NULL, severity, type, service, details
        FROM messages WHERE severity = 'CRITICAL'"""
    ),
    "dash_over_time": _over_table(
        """SELECT date_trunc('hour', detected_at) AS hour, anomaly_type, severity, count(*) AS count
        FROM anomalies WHERE detected_at BETWEEN TIMESTAMP '2024-01-28' AND TIMESTAMP '2024-01-29'
        GROUP BY ALL"""
    ),
    "dash_top_services": _over_table(
        """SELECT affected_service, count(*) AS total_anomalies,
        count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
        count(*) FILTER (WHERE severity = 'HIGH') AS high,
        count(*) FILTER (WHERE severity = 'MEDIUM') AS medium, max(detected_at) AS last_anomaly
        FROM anomalies WHERE detected_at BETWEEN TIMESTAMP '2024-01-22' AND TIMESTAMP '2024-01-29'
        GROUP BY affected_service
        ORDER BY total_anomalies DESC, affected_service NULLS FIRST LIMIT 20"""
    ),
    "dash_recent_critical": _over_table(
        """SELECT detected_at, anomaly_type, affected_service, affected_cluster, metric_name,
        round(metric_value, 6) AS metric_value, round(threshold_value, 6) AS threshold_value,
        details FROM anomalies WHERE severity = 'CRITICAL'
        AND detected_at BETWEEN TIMESTAMP '2024-01-28' AND TIMESTAMP '2024-01-29'"""
    ),
    "anomalies_24h_by_severity": _over_table(
        """SELECT severity, anomaly_type, count(*) AS count FROM anomalies
        WHERE detected_at BETWEEN TIMESTAMP '2024-01-28' AND TIMESTAMP '2024-01-29'
        GROUP BY ALL"""
    ),
    "top_services_7d": _over_table(
        """SELECT affected_service, count(*) AS anomaly_count FROM anomalies
        WHERE detected_at BETWEEN TIMESTAMP '2024-01-22' AND TIMESTAMP '2024-01-29'
        GROUP BY affected_service
        ORDER BY anomaly_count DESC, affected_service NULLS FIRST LIMIT 10"""
    ),
    "acknowledge": _over_table(
        f"""SELECT {RECORD}, details, severity = 'CRITICAL' AS acknowledged,
        CASE WHEN severity = 'CRITICAL' THEN TIMESTAMP '2024-01-29' END AS acknowledged_at,
        CAST(NULL AS VARCHAR) AS acknowledged_by FROM anomalies"""
    ),
    "rerun_acknowledged": _with(
        LOG_EVENTS,
        FEEDS,
        ONE_RUN,
        DETECTORS,
        BY_FEED,
        body=f"""SELECT {RECORD}, details, feed = 'bpm_audit' AS acknowledged,
        CASE WHEN feed = 'bpm_audit' THEN TIMESTAMP '2024-01-29' END AS acknowledged_at,
        CASE WHEN feed = 'bpm_audit' THEN 'operator' END AS acknowledged_by FROM by_feed""",
    ),
    "run_status": _with(
        LOG_EVENTS,
        FEEDS,
        ONE_RUN,
        DETECTORS,
        BY_FEED,
        body="""SELECT j.detector, j.feed, CASE WHEN j.feed = 'm2e_audit' THEN 'failed' ELSE 'ok' END AS status,
        CASE WHEN j.feed <> 'm2e_audit' THEN (SELECT count(*) FROM by_feed b
            WHERE b.detector = j.detector AND b.feed = j.feed) END AS row_count
        FROM (VALUES ('failure_rate_spikes', 'bpm_audit'), ('failure_rate_spikes', 'm2e_audit'),
            ('missing_heartbeats', 'bpm_audit'), ('missing_heartbeats', 'm2e_audit'), ('missing_heartbeats', 'm2e_perf'),
            ('high_response_times', 'bpm_audit'), ('high_response_times', 'm2e_audit'), ('high_response_times', 'm2e_perf'),
            ('volume_anomalies', 'bpm_audit'), ('volume_anomalies', 'm2e_audit'), ('volume_anomalies', 'm2e_perf'),
            ('transaction_timeouts', 'm2e_perf'), ('service_degradation', 'm2e_perf')) j(detector, feed)
        UNION ALL
        SELECT 'saved', anomaly_type, 'ok', count(*) FROM by_feed GROUP BY anomaly_type""",
    ),
    "latest_logs": _with(
        LOG_EVENTS,
        AUDIT_TABLE,
        body="""SELECT t AS log_timestamp, * EXCLUDE (t) FROM audit_table
        ORDER BY t DESC, log_id LIMIT 100""",
    ),
    "latest_anomalies": _over_table(
        f"SELECT {RECORD} FROM anomalies ORDER BY detected_at DESC, anomaly_id LIMIT 50"
    ),
    "profile_audit": AUDIT_PROFILE_QUERY,
    "profile_track_a": _with(
        LOG_EVENTS,
        TRACK_TABLE,
        TRACK_A_PROFILE,
        body=f"""SELECT {PROFILE_KEYS}, round(timeout_rate, 6) AS timeout_rate,
        round(avg_total_elapsed_ms, 6) AS avg_total_elapsed_ms,
        round(incomplete_trails_rate, 6) AS incomplete_trails_rate,
        round(high_response_rate, 6) AS high_response_rate FROM profile""",
    ),
    "profile_track_b": _with(
        LOG_EVENTS,
        TRACK_TABLE,
        TRACK_B_PROFILE,
        body=f"""SELECT {PROFILE_KEYS}, round(avg_response_time_ms, 6) AS avg_response_time_ms,
        max_response_time_ms, round(incomplete_operations_rate, 6) AS incomplete_operations_rate,
        round(very_high_response_rate, 6) AS very_high_response_rate,
        round(avg_trail_marks_count, 6) AS avg_trail_marks_count FROM profile""",
    ),
    "profile_anomalies": _over_table("SELECT 1").removesuffix("SELECT 1").rstrip()
    + ",\n"
    + ANOMALY_PROFILE
    + f"""SELECT {PROFILE_KEYS}, round(critical_anomaly_rate, 6) AS critical_anomaly_rate,
    round(high_anomaly_rate, 6) AS high_anomaly_rate, unique_anomaly_types,
    round(avg_metric_value, 6) AS avg_metric_value,
    round(avg_threshold_breach_ratio, 6) AS avg_threshold_breach_ratio FROM profile""",
    "drift_audit": _with(LOG_EVENTS, AUDIT_TABLE, AUDIT_PROFILE, body=_drift()),
    "sample_metrics": _with(
        LOG_EVENTS,
        AUDIT_TABLE,
        AUDIT_PROFILE,
        body=f"""SELECT {PERIOD}, round(avg_response_time_ms, 6) AS avg_response_time_ms,
        round(p95_response_time_ms, 6) AS p95_response_time_ms,
        round(hourly_failure_rate, 6) AS hourly_failure_rate, round(error_rate, 6) AS error_rate,
        high_response_time_count, unique_services FROM profile WHERE {LAST_WEEK}
        ORDER BY time_window DESC, granularity, slice_key NULLS FIRST, slice_value NULLS FIRST
        LIMIT 10""",
    ),
    "dash_response_trend": _with(
        LOG_EVENTS,
        AUDIT_TABLE,
        AUDIT_PROFILE,
        body=f"""SELECT {PERIOD}, round(avg_response_time_ms, 6) AS avg_response_time_ms,
        round(p95_response_time_ms, 6) AS p95_response_time_ms, high_response_time_count
        FROM profile WHERE {LAST_WEEK}""",
    ),
    "dash_timeout_pct": _with(
        LOG_EVENTS,
        TRACK_TABLE,
        TRACK_A_PROFILE,
        body=f"""SELECT {PERIOD}, round(timeout_rate * 100, 6) AS timeout_rate_percent,
        round(incomplete_trails_rate * 100, 6) AS incomplete_rate_percent,
        round(avg_total_elapsed_ms, 6) AS avg_total_elapsed_ms
        FROM profile WHERE {LAST_WEEK}""",
    ),
    "dash_severity_pct": _over_table("SELECT 1").removesuffix("SELECT 1").rstrip()
    + ",\n"
    + ANOMALY_PROFILE
    + f"""SELECT {PERIOD}, round(critical_anomaly_rate * 100, 6) AS critical_percent,
    round(high_anomaly_rate * 100, 6) AS high_percent, unique_anomaly_types
    FROM profile WHERE {LAST_WEEK}""",
    "profile_incremental": AUDIT_PROFILE_QUERY,
    "profile_state": AUDIT_PROFILE_QUERY,
    "profile_custom": _with(
        LOG_EVENTS,
        AUDIT_TABLE,
        OWN_PROFILE,
        body=f"""SELECT {PROFILE_KEYS}, round(slow_failure_share, 6) AS slow_failure_share, ms_range,
        round(ms_deviation, 6) AS ms_deviation, instances, true AS instances_about FROM profile""",
    ),
    "stream_ingest_audit": _over_audit("SELECT * FROM audit"),
    "stream_ingest_track": _over_track("SELECT * FROM track_mdc"),
    "stream_ingest_track_ctx": _over_track("SELECT * FROM track_ctx"),
    "stream_written_feed": _over_audit("SELECT * FROM audit"),
    "stream_rescue": _over_audit(
        """SELECT conversation_id, conversation_id AS added, '[1,"x"]' AS message_added, 2::BIGINT AS n_unknown
        FROM audit WHERE conversation_id IS NOT NULL"""
    ),
    "retention": _with(LOG_EVENTS, body=LOG_TABLE.format(where=KEPT)),
    "compaction": _with(LOG_EVENTS, body=LOG_TABLE.format(where="")),
    "schema_evolution": _with(
        LOG_EVENTS,
        body=f"""SELECT *, CASE WHEN log_timestamp >= TIMESTAMP '2024-01-20' THEN log_id % 7 END AS added
        FROM ({LOG_TABLE.format(where=KEPT)})""",
    ),
    "ingest_retain_compact": _over_audit(
        """SELECT * FROM audit
        WHERE log_timestamp >= TIMESTAMP '2024-04-15 06:00:00' - INTERVAL 90 DAY"""
    ),
    "detect_from_lines": _over_lines(f"SELECT {RECORD}, details FROM anomalies"),
    "profile_family": _with(
        LOG_EVENTS,
        AUDIT_TABLE.replace("FROM log_events", "FROM log_events, (VALUES (0), (1)) copies(c)"),
        AUDIT_PROFILE,
        body=AUDIT_PROFILE_QUERY[AUDIT_PROFILE_QUERY.rindex("SELECT window_start") :],
    ),
    "dash_month": _over_table(
        """SELECT affected_service, count(*) AS anomaly_count FROM anomalies
        WHERE detected_at >= TIMESTAMP '2024-01-29' - INTERVAL 30 DAY GROUP BY affected_service"""
    ),
    "latest_undated": _over_track(
        """SELECT conversation_id, log_timestamp FROM track_mdc
        ORDER BY log_timestamp DESC NULLS LAST, conversation_id"""
    ),
    "latest_track": _over_track("SELECT conversation_id, log_timestamp FROM track_mdc"),
    "profile_feeds": _with(
        LOG_EVENTS,
        AUDIT_TABLE.replace("FROM log_events", "FROM log_events, (VALUES (0), (1)) copies(c)"),
        AUDIT_PROFILE,
        body=AUDIT_PROFILE_QUERY[AUDIT_PROFILE_QUERY.rindex("SELECT window_start") :],
    ),
}
