"""The six detectors, each a function from DataFrames to anomaly rows.

The sentences of ``details`` and the keys of ``metadata`` are fixed values.

``detect_*`` functions take the log tables. The functions they call take counters, so
that a full run (vigilog.plans.detection) can feed all of them from one scan.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.config import AUDIT, TRACK, DetectorConfig, Span, TimeWindows
from vigilog.functions.text import fixed, stable_id
from vigilog.functions.times import instant
from vigilog.operators.counters import row_counters, sums
from vigilog.operators.percentiles import approximate_percentiles, exact_percentiles
from vigilog.operators.unified_logs import table_name, unified_logs
from vigilog.schemas import ANOMALIES


def anomaly_rows(
    df: DataFrame,
    *,
    windows: TimeWindows,
    span: Span,
    anomaly_type: Column,
    severity: Column,
    service: Column,
    metric_name: Column,
    metric_value: Column,
    threshold: Column,
    details: Column,
    metadata: dict[str, Column],
    instance: Column | None = None,
    cluster: Column | None = None,
    baseline: Column | None = None,
    log_count: Column | None = None,
) -> DataFrame:
    """The fixed columns of the anomalies table.

    The id is a digest of what was detected where and when, so a rerun of the same
    detection gives the same ids.
    """
    missing = F.lit(None)
    instance = missing if instance is None else instance
    cluster = missing if cluster is None else cluster
    baseline = missing if baseline is None else baseline
    log_count = missing if log_count is None else log_count
    detected = instant(windows.as_of)
    values = {
        "anomaly_id": stable_id(
            anomaly_type,
            F.unix_timestamp(detected),
            F.col("log_type"),
            service,
            instance,
            cluster,
        ),
        "anomaly_type": anomaly_type,
        "severity": severity,
        "detected_at": detected,
        "time_window_start": instant(span.start),
        "time_window_end": instant(span.end),
        "affected_service": service,
        "affected_instance": instance,
        "affected_cluster": cluster,
        "metric_name": metric_name,
        "metric_value": metric_value,
        "threshold_value": threshold,
        "baseline_value": baseline,
        "details": details,
        "log_count": log_count,
        "metadata": F.create_map(
            *[item for k, v in metadata.items() for item in (F.lit(k), v.cast("string"))]
        ),
    }
    return df.select(
        *[values[field.name].cast(field.dataType).alias(field.name) for field in ANOMALIES]
    )


def _percent(part: str, whole: str) -> Column:
    return F.try_divide(F.col(part), F.col(whole)) * 100


# --- failure rate ------------------------------------------------------------------


def failure_rate_spikes(
    counters: DataFrame, config: DetectorConfig, windows: TimeWindows
) -> DataFrame:
    """A service without a baseline has no ratio and is not flagged."""
    compared = (
        counters.filter(F.col("is_audit") & F.col("service").isNotNull())
        .groupBy("log_type", "service")
        .agg(*sums("current_rows", "current_failures", "baseline_rows", "baseline_failures"))
        .filter(F.col("current_rows") >= config.failure_min_rows)
        .withColumn("current_rate", _percent("current_failures", "current_rows"))
        .withColumn("baseline_rate", _percent("baseline_failures", "baseline_rows"))
        .withColumn(
            "multiplier",
            F.col("current_rate") / (F.col("baseline_rate") + config.failure_rate_smoothing),
        )
        .filter(F.col("multiplier") >= config.failure_rate_multiplier)
    )
    source = table_name(F.col("log_type"))
    critical = F.col("multiplier") >= config.failure_rate_critical
    return anomaly_rows(
        compared,
        windows=windows,
        span=windows.medium,
        anomaly_type=F.lit("FAILURE_RATE_SPIKE"),
        severity=F.when(critical, "CRITICAL").otherwise("HIGH"),
        service=F.col("service"),
        metric_name=F.lit("failure_rate_percent"),
        metric_value=F.col("current_rate"),
        threshold=F.col("baseline_rate") * config.failure_rate_multiplier,
        baseline=F.col("baseline_rate"),
        details=F.concat(
            F.lit("Failure rate spike detected in "),
            source,
            F.lit(": "),
            fixed(F.col("current_rate"), 2),
            F.lit("% vs baseline "),
            fixed(F.col("baseline_rate"), 2),
            F.lit("%"),
        ),
        log_count=F.col("current_rows"),
        metadata={
            "rate_multiplier": F.col("multiplier"),
            "failure_count": F.col("current_failures"),
            "baseline_total": F.col("baseline_rows"),
            "source_table": source,
        },
    )


def detect_failure_rate_spikes(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    windows = config.windows_at(as_of)
    counters = row_counters(logs, config, windows, frozenset({AUDIT}))
    return failure_rate_spikes(counters, config, windows)


# --- heartbeat ---------------------------------------------------------------------


def missing_heartbeats(
    counters: DataFrame, config: DetectorConfig, windows: TimeWindows
) -> DataFrame:
    """Grouping treats NULL keys as equal, so this is a null-safe anti join without a join."""
    named = F.when(F.col("is_audit"), F.coalesce("service", F.lit("unknown"))).otherwise(
        F.col("service")
    )
    silent = (
        counters.withColumn("service", named)
        .filter(F.col("service").isNotNull())
        .groupBy("log_type", "service", "instance_name", "cluster")
        .agg(*sums("baseline_rows", "heartbeat_rows"))
        .filter((F.col("baseline_rows") > 0) & (F.col("heartbeat_rows") == 0))
    )
    minutes = F.lit(config.heartbeat_minutes)
    return anomaly_rows(
        silent,
        windows=windows,
        span=Span(windows.heartbeat.start, windows.as_of),
        anomaly_type=F.lit("MISSING_HEARTBEAT"),
        severity=F.lit("HIGH"),
        service=F.col("service"),
        instance=F.col("instance_name"),
        cluster=F.col("cluster"),
        metric_name=F.lit("minutes_since_last_log"),
        metric_value=minutes,
        threshold=minutes,
        details=F.concat(
            F.lit("No logs received from "),
            F.col("service"),
            F.lit(f" in the last {config.heartbeat_minutes} minutes"),
        ),
        metadata={"log_type": F.col("log_type")},
    )


def detect_missing_heartbeats(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    windows = config.windows_at(as_of)
    return missing_heartbeats(row_counters(logs, config, windows), config, windows)


# --- response time -----------------------------------------------------------------


def detect_high_response_times(
    logs: Mapping[str, DataFrame],
    config: DetectorConfig,
    as_of: datetime,
    approximate: bool = False,
) -> DataFrame:
    windows = config.windows_at(as_of)
    rows = unified_logs(logs, [windows.long])
    measure = approximate_percentiles if approximate else exact_percentiles
    slow = (
        measure(rows, ["log_type", "service"], "elapsed_ms", {"p95": 0.95, "p99": 0.99})
        .filter(F.col("value_count") >= config.response_min_rows)
        .filter((F.col("p95") > config.p95_limit_ms) | (F.col("p99") > config.p99_limit_ms))
    )
    worst = F.col("p99") > config.p99_limit_ms
    metric = F.when(worst, "p99_response_time_ms").otherwise("p95_response_time_ms")
    value = F.when(worst, F.col("p99")).otherwise(F.col("p95"))
    source = table_name(F.col("log_type"))
    return anomaly_rows(
        slow,
        windows=windows,
        span=windows.long,
        anomaly_type=F.lit("HIGH_RESPONSE_TIME"),
        severity=F.when(worst, "CRITICAL").otherwise("HIGH"),
        service=F.col("service"),
        metric_name=metric,
        metric_value=value,
        threshold=F.when(worst, config.p99_limit_ms).otherwise(config.p95_limit_ms),
        baseline=F.col("value_mean"),
        details=F.concat(
            F.lit("High response time detected in "),
            source,
            F.lit(": "),
            metric,
            F.lit("="),
            fixed(value, 0),
            F.lit("ms (avg: "),
            fixed(F.col("value_mean"), 0),
            F.lit("ms)"),
        ),
        log_count=F.col("value_count"),
        metadata={"p95": F.col("p95"), "p99": F.col("p99"), "source_table": source},
    )


# --- timeouts ----------------------------------------------------------------------


def detect_transaction_timeouts(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    windows = config.windows_at(as_of)
    timeouts = (
        unified_logs(logs, [windows.long], TRACK)
        .filter("has_incomplete_trails")
        .groupBy("log_type", "service", "cluster")
        .agg(F.count(F.lit(1)).alias("timeouts"), F.avg("elapsed_ms").alias("mean_elapsed"))
        .filter(F.col("timeouts") >= config.timeout_min_rows)
    )
    source = table_name(F.col("log_type"))
    return anomaly_rows(
        timeouts,
        windows=windows,
        span=windows.long,
        anomaly_type=F.lit("TRANSACTION_TIMEOUT"),
        severity=F.lit("HIGH"),
        service=F.col("service"),
        cluster=F.col("cluster"),
        metric_name=F.lit("timeout_count"),
        metric_value=F.col("timeouts"),
        threshold=F.lit(config.timeout_min_rows),
        details=F.concat(
            F.lit("Multiple incomplete transactions detected in "),
            source,
            F.lit(": "),
            F.col("timeouts").cast("string"),
            F.lit(" timeouts"),
        ),
        log_count=F.col("timeouts"),
        metadata={
            "avg_elapsed_before_timeout_ms": F.when(
                F.col("mean_elapsed") != 0, F.col("mean_elapsed").cast("string")
            ).otherwise("N/A"),
            "source_table": source,
        },
    )


# --- volume ------------------------------------------------------------------------


def volume_anomalies(
    counters: DataFrame, config: DetectorConfig, windows: TimeWindows
) -> DataFrame:
    """Current count against the mean count per baseline bucket that has any rows.

    The first aggregation spreads a busy service over its buckets; only one row per
    bucket reaches the second.
    """
    named = F.when(F.col("is_audit"), F.coalesce("service", F.lit("audit_service"))).otherwise(
        F.col("service")
    )
    limit = config.volume_multiplier
    busy = F.when(F.col("baseline_rows") > 0, F.col("baseline_rows"))
    compared = (
        counters.withColumn("service", named)
        .filter(F.col("service").isNotNull())
        .groupBy("log_type", "service", "time_bucket")
        .agg(*sums("current_rows", "baseline_rows"))
        .groupBy("log_type", "service")
        .agg(F.sum("current_rows").alias("current_rows"), F.avg(busy).alias("baseline_mean"))
        .filter((F.col("current_rows") > 0) & F.col("baseline_mean").isNotNull())
        .withColumn(
            "ratio", F.col("current_rows") / (F.col("baseline_mean") + config.volume_smoothing)
        )
        .filter((F.col("ratio") > limit) | (F.col("ratio") < 1.0 / limit))
    )
    spike = F.col("ratio") > limit
    return anomaly_rows(
        compared,
        windows=windows,
        span=windows.medium,
        anomaly_type=F.when(spike, "VOLUME_SPIKE").otherwise("VOLUME_DROP"),
        severity=F.when(spike, "MEDIUM").otherwise("HIGH"),
        service=F.col("service"),
        metric_name=F.lit("log_count"),
        metric_value=F.col("current_rows"),
        threshold=F.col("baseline_mean") * limit,
        baseline=F.col("baseline_mean"),
        details=F.concat(
            F.when(spike, "Log volume spike in ").otherwise("Log volume drop in "),
            F.col("log_type"),
            F.lit(": "),
            F.col("current_rows").cast("string"),
            F.lit(" logs vs baseline "),
            fixed(F.col("baseline_mean"), 0),
        ),
        log_count=F.col("current_rows"),
        metadata={"volume_ratio": F.col("ratio"), "source_table": F.col("log_type")},
    )


def detect_volume_anomalies(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    windows = config.windows_at(as_of)
    return volume_anomalies(row_counters(logs, config, windows), config, windows)


# --- degradation -------------------------------------------------------------------


def service_degradation(
    counters: DataFrame, config: DetectorConfig, windows: TimeWindows
) -> DataFrame:
    """A baseline mean of zero gives no percentage, hence no anomaly and no error."""
    compared = (
        counters.filter(
            ~F.col("is_audit") & F.col("service").isNotNull() & F.col("instance_name").isNotNull()
        )
        .groupBy("log_type", "service", "instance_name")
        .agg(*sums("current_timed", "current_elapsed", "baseline_timed", "baseline_elapsed"))
        .filter(
            (F.col("current_timed") >= config.degradation_min_current)
            & (F.col("baseline_timed") >= config.degradation_min_baseline)
        )
        .withColumn("current_mean", F.try_divide("current_elapsed", "current_timed"))
        .withColumn("baseline_mean", F.try_divide("baseline_elapsed", "baseline_timed"))
        .withColumn(
            "percent",
            F.try_divide(F.col("current_mean") - F.col("baseline_mean"), F.col("baseline_mean"))
            * 100,
        )
        .filter(F.col("percent") >= config.degradation_percent)
    )
    source = table_name(F.col("log_type"))
    critical = F.col("percent") >= config.degradation_critical_percent
    return anomaly_rows(
        compared,
        windows=windows,
        span=windows.medium,
        anomaly_type=F.lit("SERVICE_DEGRADATION"),
        severity=F.when(critical, "CRITICAL").otherwise("HIGH"),
        service=F.col("service"),
        instance=F.col("instance_name"),
        metric_name=F.lit("avg_response_time_ms"),
        metric_value=F.col("current_mean"),
        threshold=F.col("baseline_mean") * (1 + config.degradation_percent / 100),
        baseline=F.col("baseline_mean"),
        details=F.concat(
            F.lit("Performance degradation in "),
            source,
            F.lit(": "),
            fixed(F.col("percent"), 1),
            F.lit("% slower than baseline ("),
            fixed(F.col("current_mean"), 0),
            F.lit("ms vs "),
            fixed(F.col("baseline_mean"), 0),
            F.lit("ms)"),
        ),
        log_count=F.col("current_timed"),
        metadata={
            "degradation_percent": F.col("percent"),
            "baseline_count": F.col("baseline_timed"),
            "source_table": source,
        },
    )


def detect_service_degradation(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    windows = config.windows_at(as_of)
    counters = row_counters(logs, config, windows, TRACK)
    return service_degradation(counters, config, windows)
