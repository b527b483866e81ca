"""A full detection run: all six detectors, saved and summarised."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.config import ALL_FAMILIES, AUDIT, FEEDS, TRACK, DetectorConfig, utc
from vigilog.functions.times import instant
from vigilog.operators import detectors as d
from vigilog.operators.alerts import by_type
from vigilog.operators.counters import counter_rollup, row_counters
from vigilog.schemas import ANOMALIES
from vigilog.session import materialize, scratch
from vigilog.sources.tables import DETECTED_DATE, RUN, save_anomalies
from vigilog.sources.versions import live_items, read_items

Detector = Callable[[Mapping[str, DataFrame], DetectorConfig, datetime], DataFrame]

# In the order of a run, each with the feed families it looks at.
DETECTORS: dict[str, tuple[Detector, frozenset[str]]] = {
    "failure_rate_spikes": (d.detect_failure_rate_spikes, frozenset({AUDIT})),
    "missing_heartbeats": (d.detect_missing_heartbeats, ALL_FAMILIES),
    "high_response_times": (d.detect_high_response_times, ALL_FAMILIES),
    "transaction_timeouts": (d.detect_transaction_timeouts, TRACK),
    "volume_anomalies": (d.detect_volume_anomalies, ALL_FAMILIES),
    "service_degradation": (d.detect_service_degradation, TRACK),
}


def _present(logs: Mapping[str, DataFrame], families: frozenset[str]) -> bool:
    return any(FEEDS[key].family in families for key in logs)


def run_separately(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    """Bag union of the detectors, each with its own scan of the columns it needs."""
    parts = [
        detect(logs, config, as_of)
        for detect, families in DETECTORS.values()
        if _present(logs, families)
    ]
    return reduce(DataFrame.unionByName, parts)


def run_detection(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> DataFrame:
    """The same rows as ``run_separately`` from a single pass over the baseline.

    The four baseline detectors share one rollup, which is written to the shared folder
    because every one of them reads it. The other two look at the long window only,
    which date partitions and file statistics reduce to the newest files.
    """
    windows = config.windows_at(as_of)
    rollup = materialize(counter_rollup(row_counters(logs, config, windows)), "counters")
    by_entity = rollup.filter("by_entity")
    by_bucket = rollup.filter("not by_entity")
    parts = [
        d.failure_rate_spikes(by_bucket, config, windows),
        d.missing_heartbeats(by_entity, config, windows),
        d.detect_high_response_times(logs, config, as_of),
        d.volume_anomalies(by_bucket, config, windows),
        d.service_degradation(by_entity, config, windows),
    ]
    if _present(logs, TRACK):
        parts.append(d.detect_transaction_timeouts(logs, config, as_of))
    return reduce(DataFrame.unionByName, parts)


def detect_and_save(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime, table: str
) -> DataFrame:
    """Save a run in the anomalies table; returns the summary of its instant.

    A run is named by its instant and its feeds. The same run again replaces its rows, also if it
    finds fewer; a run of other feeds adds only what the table does not have. The summary reads
    what the table has, and the run's intermediate copies are deleted.
    """
    spark = next(iter(logs.values())).sparkSession
    with scratch(spark):
        found = materialize(run_detection(logs, config, as_of), "anomalies")
        save_anomalies(found, table, run_name(logs, as_of), as_of)
    return saved_summary(spark, table, as_of)


def run_name(logs: Mapping[str, DataFrame], as_of: datetime) -> str:
    return "-".join([utc(as_of).strftime("at%Y%m%dT%H%M%S.%f"), *sorted(logs)])


def saved_summary(spark: SparkSession, table: str, as_of: datetime) -> DataFrame:
    """What the table has of one instant, by type and severity."""
    day = [i for i in live_items(spark, table) if i.date == f"{DETECTED_DATE}={utc(as_of).date()}"]
    schema = T.StructType([*ANOMALIES.fields, T.StructField(DETECTED_DATE, T.DateType()), T.StructField(RUN, T.StringType())])
    saved = read_items(spark, table, day, schema)
    if saved is None:
        return by_type(spark.createDataFrame([], ANOMALIES))
    return by_type(saved.filter(F.col("detected_at") == instant(as_of)))


STATUS = "detector string, feed string, status string, message string, row_count bigint"
#: Characters of a message that a status keeps.
MESSAGE_CHARS = 500


def run_isolated(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime
) -> tuple[DataFrame, DataFrame]:
    """(anomalies, status): each detector is a job of its own for each feed it looks at.

    A job that fails costs its own rows only; the others are there all the same. Status has a row
    for each job: detector, feed, status (ok, failed), the first line of the message, and the rows
    that were found (null where it failed). Detectors look at one feed at a time, so the rows of
    all jobs together are those of ``run_detection``. An error while a feed's plan is built counts like
    one of its job.
    """
    spark = next(iter(logs.values())).sparkSession
    parts, status = [], []
    for name, (detect, families) in DETECTORS.items():
        for feed, rows in logs.items():
            if FEEDS[feed].family not in families:
                continue
            counted = Observation()
            try:
                found = detect({feed: rows}, config, as_of)
                found = found.observe(counted, F.count(F.lit(1)).alias("rows"))
                parts.append(materialize(found, f"found-{name}-{feed}"))
                status.append((name, feed, "ok", None, counted.get["rows"]))
            except (Py4JError, PySparkException) as error:
                message = (str(error).strip().splitlines() or [type(error).__name__])[0]
                status.append((name, feed, "failed", message[:MESSAGE_CHARS], None))
    anomalies = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ANOMALIES)
    return anomalies, spark.createDataFrame(status, STATUS)


def detect_isolated_and_save(
    logs: Mapping[str, DataFrame], config: DetectorConfig, as_of: datetime, table: str
) -> DataFrame:
    """Like ``detect_and_save``, but what fails keeps nothing else from being saved; returns the
    status of all jobs.

    A repeated run replaces its rows, and what failed this time is not kept from the time before.
    """
    spark = next(iter(logs.values())).sparkSession
    with scratch(spark):
        found, status = run_isolated(logs, config, as_of)
        save_anomalies(found, table, run_name(logs, as_of), as_of)
    return status
