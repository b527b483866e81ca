from datetime import timedelta

import pytest
from conftest import NOW, ago
from helpers import audit, track

from vigilog.config import FEEDS, DetectorConfig
from vigilog.operators import detectors as d
from vigilog.plans import detection
from vigilog.schemas import ANOMALIES

CFG = DetectorConfig()
RECENT, LONG, PAST = ago(minutes=1), ago(minutes=25), ago(days=2)


def rows(df):
    assert [f.name for f in df.schema] == ANOMALIES.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in ANOMALIES]
    return df.collect()


# --- failure rate ------------------------------------------------------------------


def failures(spark, current, past):
    """current, past: (rows, failures) of one service."""
    data = []
    for moment, (n, bad) in ((RECENT, current), (PAST, past)):
        data += [(moment, "s", i < bad, 1) for i in range(n)]
    return rows(
        d.detect_failure_rate_spikes({"bpm_audit": audit(spark, data)}, CFG, NOW)
    )


def test_failure_spike_values(spark):
    (row,) = failures(spark, (10, 4), (10, 1))
    assert (row.anomaly_type, row.severity) == ("FAILURE_RATE_SPIKE", "HIGH")
    assert (row.metric_value, row.baseline_value, row.threshold_value) == (40.0, 10.0, 20.0)
    assert row.log_count == 10 and row.metadata["failure_count"] == "4"
    assert row.metadata["baseline_total"] == "10"
    assert row.metadata["source_table"] == "bpm_audit_logs"
    assert row.details == (
        "Failure rate spike detected in bpm_audit_logs: 40.00% vs baseline 10.00%"
    )
    assert row.time_window_end - row.time_window_start == timedelta(minutes=15)


@pytest.mark.parametrize(
    ("current", "past", "severity"),
    [
        ((10, 1), (10, 0), "CRITICAL"),
        ((2000, 1), (10, 0), "CRITICAL"),
        ((2001, 1), (10, 0), "HIGH"),
        ((9, 9), (10, 0), None),
        ((10, 0), (10, 0), None),
        ((10, 2), (10, 1), None),
        ((10, 10), (0, 0), None),
    ],
)
def test_failure_spike_edges(spark, current, past, severity):
    found = failures(spark, current, past)
    assert [r.severity for r in found] == ([severity] if severity else [])


def test_rows_on_the_edges_of_windows_count(spark):
    data = [(ago(minutes=15), "s", True, 1)] * 5 + [(NOW, "s", True, 1)] * 5
    data += [(ago(days=7), "s", False, 1), (ago(hours=1), "s", False, 1)]
    data += [(ago(minutes=15, microseconds=1), "s", False, 1)] * 50
    data += [(ago(days=7, microseconds=1), "s", True, 1)]
    (row,) = rows(d.detect_failure_rate_spikes({"bpm_audit": audit(spark, data)}, CFG, NOW))
    assert row.log_count == 10 and row.metric_value == 100.0
    assert row.metadata["baseline_total"] == "2"


def test_services_without_a_name_never_match(spark):
    data = [(RECENT, None, True, 1)] * 10 + [(PAST, None, False, 1)] * 10
    assert not rows(d.detect_failure_rate_spikes({"bpm_audit": audit(spark, data)}, CFG, NOW))


# --- heartbeat ---------------------------------------------------------------------


def test_missing_heartbeat(spark):
    data = [
        (PAST, "gone", 1, False, "i1", "c1"),
        (PAST, "here", 1, False, "i1", None),
        (RECENT, "here", 1, False, "i1", None),
        (PAST, "moved", 1, False, "i1", "c1"),
        (RECENT, "moved", 1, False, "i2", "c1"),
        (PAST, None, 1, False, "i1", "c1"),
        (RECENT, "new", 1, False, "i1", "c1"),
        (PAST, "late", 1, False, None, "c1"),
        (ago(minutes=5, microseconds=1), "late", 1, False, None, "c1"),
    ]
    found = rows(d.detect_missing_heartbeats({"maf_perf": track(spark, data)}, CFG, NOW))
    keys = {(r.affected_service, r.affected_instance, r.affected_cluster) for r in found}
    assert keys == {("gone", "i1", "c1"), ("moved", "i1", "c1"), ("late", None, "c1")}
    row = found[0]
    assert (row.severity, row.metric_value, row.threshold_value) == ("HIGH", 5.0, 5.0)
    assert row.baseline_value is None and row.log_count is None
    assert row.metadata == {"log_type": "maf_perf"}
    assert row.details.endswith("in the last 5 minutes")


def test_nameless_audit_rows_are_the_unknown_service(spark):
    data = [(PAST, None, False, 1), (PAST, "unknown", False, 1)]
    logs = {"m2e_audit": audit(spark, data)}
    (row,) = rows(d.detect_missing_heartbeats(logs, CFG, NOW))
    assert row.affected_service == "unknown"
    (fused,) = [
        r
        for r in detection.run_detection(logs, CFG, NOW).collect()
        if r.anomaly_type == "MISSING_HEARTBEAT"
    ]
    assert fused == row


# --- response time -----------------------------------------------------------------


def slow(spark, values):
    data = [(LONG, "s", False, v) for v in values]
    return rows(d.detect_high_response_times({"bpm_audit": audit(spark, data)}, CFG, NOW))


def test_response_time_edges(spark):
    assert not slow(spark, [30000] * 10)
    assert not slow(spark, [90000] * 9)
    (high,) = slow(spark, [30001] * 10 + [None])
    assert (high.severity, high.metric_name) == ("HIGH", "p95_response_time_ms")
    assert (high.metric_value, high.threshold_value, high.log_count) == (30001.0, 30000.0, 10)
    (critical,) = slow(spark, [60001] * 10)
    assert (critical.severity, critical.metric_name) == ("CRITICAL", "p99_response_time_ms")
    assert (critical.metric_value, critical.threshold_value) == (60001.0, 60000.0)
    assert critical.details == (
        "High response time detected in bpm_audit_logs: "
        "p99_response_time_ms=60001ms (avg: 60001ms)"
    )


def test_slow_rows_without_a_service_are_reported(spark):
    data = [(LONG, None, 90000, False)] * 10
    logs = {"bpm_adapter": track(spark, data)}
    (row,) = rows(d.detect_high_response_times(logs, CFG, NOW))
    assert row.affected_service is None and row.metadata["p95"] == "90000.0"
    (rough,) = rows(d.detect_high_response_times(logs, CFG, NOW, approximate=True))
    assert rough.metric_value == 90000.0


# --- timeouts ----------------------------------------------------------------------


def test_timeouts(spark):
    data = [(LONG, "s", 10, True, "i", "c1")] * 3 + [(LONG, "s", 10, True, "i", "c2")] * 2
    data += [(LONG, "z", 0, True, "i", None)] * 3 + [(LONG, "s", 5, None, "i", "c1")]
    data += [(ago(minutes=31), "s", 5, True, "i", "c2")]
    found = rows(d.detect_transaction_timeouts({"bpm_perf": track(spark, data)}, CFG, NOW))
    by_service = {r.affected_service: r for r in found}
    assert by_service.keys() == {"s", "z"}
    s, z = by_service["s"], by_service["z"]
    assert (s.affected_cluster, s.metric_value, s.threshold_value) == ("c1", 3.0, 3.0)
    assert s.metadata["avg_elapsed_before_timeout_ms"] == "10.0"
    assert z.metadata["avg_elapsed_before_timeout_ms"] == "N/A" and z.affected_cluster is None


# --- volume ------------------------------------------------------------------------


def volume(spark, current, buckets):
    data = [(RECENT, "s", 1, False)] * current
    for i, n in enumerate(buckets):
        data += [(ago(days=1, minutes=15 * i), "s", 1, False)] * n
    return rows(d.detect_volume_anomalies({"m2e_perf": track(spark, data)}, CFG, NOW))


def test_volume(spark):
    (spike,) = volume(spark, 40, [10, 0, 10])
    assert (spike.anomaly_type, spike.severity) == ("VOLUME_SPIKE", "MEDIUM")
    assert (spike.baseline_value, spike.threshold_value, spike.log_count) == (10.0, 30.0, 40)
    assert spike.details == "Log volume spike in m2e_perf: 40 logs vs baseline 10"
    assert spike.metadata["source_table"] == "m2e_perf"
    (drop,) = volume(spark, 1, [10, 6])
    assert (drop.anomaly_type, drop.severity, drop.threshold_value) == ("VOLUME_DROP", "HIGH", 24.0)
    assert not volume(spark, 30, [10])
    assert not volume(spark, 0, [10])
    assert not volume(spark, 50, [])


def test_nameless_audit_rows_are_the_audit_service(spark):
    data = [(RECENT, None, False, 1)] * 40 + [(PAST, None, False, 1)] * 5
    data += [(PAST, "audit_service", False, 1)] * 5
    logs = {"bpm_audit": audit(spark, data)}
    (row,) = rows(d.detect_volume_anomalies(logs, CFG, NOW))
    assert (row.affected_service, row.baseline_value) == ("audit_service", 10.0)


# --- degradation -------------------------------------------------------------------


def degraded(spark, current, past, current_n=5, past_n=10, instance="i"):
    data = [(RECENT, "s", current, False, instance, "c")] * current_n
    data += [(PAST, "s", past, False, instance, "c")] * past_n
    return rows(d.detect_service_degradation({"maf_perf": track(spark, data)}, CFG, NOW))


def test_degradation(spark):
    (row,) = degraded(spark, 150, 100)
    assert (row.severity, row.metric_value, row.baseline_value) == ("HIGH", 150.0, 100.0)
    assert (row.threshold_value, row.log_count) == (150.0, 5)
    assert row.details == (
        "Performance degradation in maf_perf_logs: 50.0% slower than baseline (150ms vs 100ms)"
    )
    assert [r.severity for r in degraded(spark, 200, 100)] == ["CRITICAL"]
    assert not degraded(spark, 149, 100)
    assert not degraded(spark, 100, 0)
    assert not degraded(spark, 200, 100, current_n=4)
    assert not degraded(spark, 200, 100, past_n=9)
    assert not degraded(spark, 200, 100, instance=None)


# --- runs --------------------------------------------------------------------------


def six_feeds(spark):
    """Every feed with the same troubled services, ids as the row multiplies."""
    feeds = {}
    for key, feed in FEEDS.items():
        if feed.family == "audit":
            data = [(RECENT, "s", True, 90000)] * 40 + [(PAST, "s", False, 10)] * 10
            data += [(PAST, None, False, 1), (PAST, "gone", False, 1, None, None)]
            feeds[key] = audit(spark, data)
        else:
            data = [(RECENT, "s", 90000, True)] * 40 + [(PAST, "s", 10, False)] * 10
            data += [(PAST, None, 1, False), (PAST, "gone", 1, False, None, None)]
            feeds[key] = track(spark, data)
    return feeds


def test_one_pass_equals_six_detectors(spark):
    feeds = six_feeds(spark)
    fused = sorted(detection.run_detection(feeds, CFG, NOW).collect(), key=str)
    separate = sorted(detection.run_separately(feeds, CFG, NOW).collect(), key=str)
    assert fused == separate
    kinds = {}
    for row in fused:
        kinds[row.anomaly_type] = kinds.get(row.anomaly_type, 0) + 1
    assert kinds == {
        "FAILURE_RATE_SPIKE": 2,
        "MISSING_HEARTBEAT": 8,
        "HIGH_RESPONSE_TIME": 6,
        "TRANSACTION_TIMEOUT": 4,
        "VOLUME_SPIKE": 6,
        "SERVICE_DEGRADATION": 4,
    }
    assert len({r.anomaly_id for r in fused}) == len(fused)


def test_a_rerun_repeats_its_ids(spark):
    feeds = {"bpm_audit": six_feeds(spark)["bpm_audit"]}
    first = {r.anomaly_id for r in detection.run_detection(feeds, CFG, NOW).collect()}
    again = {r.anomaly_id for r in detection.run_detection(feeds, CFG, NOW).collect()}
    later = {r.anomaly_id for r in detection.run_detection(feeds, CFG, ago(seconds=-1)).collect()}
    assert first == again and first and not first & later


def test_absent_feeds_are_skipped_and_unknown_ones_refused(spark):
    feeds = six_feeds(spark)
    only_track = {"m2e_perf": feeds["m2e_perf"]}
    assert detection.run_detection(only_track, CFG, NOW).count() > 0
    with pytest.raises(KeyError):
        d.detect_volume_anomalies({"other": feeds["m2e_perf"]}, CFG, NOW)
    with pytest.raises(ValueError):
        d.detect_failure_rate_spikes(only_track, CFG, NOW)


def test_save_appends_and_summarises(spark, tmp_path):
    from vigilog.sources.tables import read_anomalies

    feeds = {"bpm_audit": six_feeds(spark)["bpm_audit"]}
    table = str(tmp_path / "anomalies")
    summary = detection.detect_and_save(feeds, CFG, NOW, table)
    listed = [(r.severity, r.anomaly_type, r["count"]) for r in summary.collect()]
    assert listed == sorted(listed)
    detection.detect_and_save(feeds, CFG, ago(hours=-1), table)
    saved = read_anomalies(spark, table)
    first = saved.filter("detected_at = timestamp'2024-01-29 00:00:00'").count()
    assert first == sum(n for _, _, n in listed) and saved.count() > first
    assert saved.filter("acknowledged").count() == 0
