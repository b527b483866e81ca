
from datetime import timedelta

import pytest
from conftest import NOW, SF_DIR, ago
from helpers import audit, plan_of, utc
from pyspark.sql import functions as F

from vigilog.operators.profiles import (
    composed,
    custom,
    distinct,
    distinct_sketch,
    drift,
    maximum,
    mean,
    percentile,
    profile,
    total,
)
from vigilog.functions.times import utc_day
from vigilog.plans import dashboards, monitoring
from vigilog.registry.event_views import audit_logs, read_events
from vigilog.sources.tables import scan


def small(spark):
    return audit(
        spark,
        [
            (ago(hours=2), "a", True, 10),
            (ago(hours=2, minutes=-59), "a", False, 30),
            (ago(hours=2), None, False, None),
            (ago(hours=1), "b", None, 50000),
        ],
    )


METRICS = [
    mean("rate", "is_failure"),
    mean("ms", "response_time_ms"),
    total("high", "case when response_time_ms > 30000 then 1 else 0 end"),
    maximum("worst", "response_time_ms"),
    distinct("services", "transaction_name"),
    percentile("median", "response_time_ms", 0.5),
    custom("p50", "percentile(response_time_ms, 0.5)"),
    custom("spread", "max(response_time_ms) - min(response_time_ms)", "bigint"),
]


def test_profile_values(spark):
    rows = profile(small(spark), "log_timestamp", METRICS, ["transaction_name"]).collect()
    found = {(r.granularity, r.window.start, r.slice_key, r.slice_value): r for r in rows}
    assert len(found) == len(rows) == 2 + 3 + 1 + 3
    hour = found["1 hour", ago(hours=2), None, None]
    assert (hour.row_count, hour.rate, hour.ms) == (3, pytest.approx(1 / 3), 20.0)
    assert (hour.high, hour.worst, hour.services, hour.median, hour.p50) == (0, 30.0, 1, 20.0, 20.0)
    assert hour.spread == 20 and hour.window.end - hour.window.start == timedelta(hours=1)
    day = found["1 day", ago(days=1), None, None]
    assert (day.row_count, day.high, day.services, day.median) == (4, 1, 2, 30.0)
    nameless = found["1 day", ago(days=1), "transaction_name", None]
    assert (nameless.row_count, nameless.ms, nameless.median, nameless.p50) == (1, None, None, None)
    b = found["1 hour", ago(hours=1), "transaction_name", "b"]
    assert b.rate is None and b.worst == 50000.0


def test_parts_equal_the_plain_aggregates(spark):
    """Metrics built from parts against the same metrics as free SQL."""
    logs = audit_logs(read_events(spark, SF_DIR))
    monitor = monitoring.AUDIT_MONITOR
    plain = [
        custom("hourly_failure_rate", "avg(cast(is_failure as double))"),
        custom("avg_response_time_ms", "avg(response_time_ms)"),
        custom("p95_response_time_ms", "percentile(response_time_ms, 0.95)"),
        custom(
            "high_response_time_count",
            "sum(case when response_time_ms > 30000 then 1 else 0 end)",
            "bigint",
        ),
        custom("unique_services", "count(distinct transaction_name)", "bigint"),
        custom("error_rate", "avg(cast(is_error as double))"),
    ]
    slices = list(monitor.slices)
    ours = monitoring.run_monitor(logs, monitor)
    theirs = profile(logs, "log_timestamp", plain, slices)
    assert ours.columns == theirs.columns

    def cells(df):
        rounded = [
            F.round(c, 6).alias(c) if t == "double" else F.col(c).alias(c) for c, t in df.dtypes
        ]
        return sorted(df.select(*rounded).collect(), key=str)

    assert cells(ours) == cells(theirs)


def test_other_granularities(spark):
    rows = profile(small(spark), "log_timestamp", METRICS[:1], [], ("30 minutes", "2 hours"))
    starts = {(r.granularity, r.window.start, r.row_count) for r in rows.collect()}
    assert starts == {
        ("30 minutes", ago(hours=2), 2),
        ("30 minutes", ago(hours=1, minutes=30), 1),
        ("30 minutes", ago(hours=1), 1),
        ("2 hours", ago(hours=2), 4),
    }
    with pytest.raises(ValueError):
        profile(small(spark), "log_timestamp", METRICS[:1], [], ("1 month",))


def test_drift_compares_with_the_previous_window(spark):
    table = profile(small(spark), "log_timestamp", METRICS[1:3], [])
    rows = drift(table, METRICS[1:3]).collect()
    assert {r.granularity for r in rows} == {"1 hour"}
    by_name = {r.metric_name: r for r in rows}
    assert (by_name["ms"].previous_value, by_name["ms"].value) == (20.0, 50000.0)
    assert by_name["ms"].absolute_change == 49980.0 and by_name["ms"].relative_change == 2499.0
    assert by_name["high"].absolute_change == 1.0 and by_name["high"].relative_change is None


def ingested(df, at):
    return df.withColumn("ingestion_timestamp", F.lit(utc(at)))


def test_refresh_touches_only_days_with_new_rows(spark, tmp_path):
    monitor = monitoring.Monitor(
        "log_timestamp",
        ("transaction_name",),
        (mean("ms", "response_time_ms"), percentile("p95", "response_time_ms", 0.95)),
        "1 hour",
    )
    path = str(tmp_path / "profile")
    old = ingested(
        audit(spark, [(ago(days=d, hours=1), "a", False, 10 * d) for d in range(5)]), ago(hours=1)
    )
    monitoring.create_profile_table(old, monitor, path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "profile").glob("*/*.parquet")}
    late = [(ago(days=3, hours=1), "a", False, 1000), (ago(hours=2), "b", False, 7)]
    logs = old.unionByName(ingested(audit(spark, late), NOW))
    monitoring.refresh_profile_table(logs, monitor, path, since=ago(hours=1))
    refreshed = monitoring.read_profile_table(spark, path).drop(monitoring.WINDOW_DATE)
    assert sorted(refreshed.collect(), key=str) == sorted(
        monitoring.run_monitor(logs, monitor).collect(), key=str
    )
    kept = {f for f in (tmp_path / "profile").glob("*/*.parquet")} & set(before)
    dates = {f.parent.name for f in kept}
    assert dates == {f"window_date=2024-01-{d}" for d in (24, 26, 27)}
    monitoring.refresh_profile_table(logs, monitor, path, since=NOW)
    assert monitoring.read_profile_table(spark, path).count() == refreshed.count()


def test_profile_dashboards_have_a_total_order(spark):
    table = monitoring.run_monitor(audit_logs(read_events(spark, SF_DIR)), monitoring.AUDIT_MONITOR)
    rows = dashboards.dashboard(dashboards.SAMPLE_METRICS, NOW, profile=table).collect()
    assert len(rows) == 10 and rows[0].time_window == NOW
    trend = dashboards.dashboard(dashboards.RESPONSE_TREND, NOW, profile=table).collect()
    keys = [(r.time_window, r.granularity, r.slice_key or "", r.slice_value or "") for r in trend]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


def test_the_fan_out_happens_after_the_reduction(spark):
    logs = audit_logs(read_events(spark, SF_DIR))
    plan = plan_of(monitoring.run_monitor(logs, monitoring.AUDIT_MONITOR), "simple")
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan
    lines = [line.strip(" :+-*()0123456789") for line in plan.split("\n")]
    scans = [i for i, line in enumerate(lines) if line.startswith("FileScan")]
    for scan in scans:
        above = [i for i in range(scan) if lines[i].startswith("HashAggregate")]
        fans = [i for i in range(scan) if "explode(array(" in lines[i] and "_slice" in lines[i]]
        assert fans and max(above) > max(fans), "aggregate below the fan-out"


def batches(spark, path, *numbers, stream="s"):
    from vigilog.streaming.ingest import save_batch

    for number, rows in numbers:
        logs = audit(spark, rows).withColumn("log_date", utc_day(F.col("log_timestamp")))
        save_batch(logs, path, stream, number)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_refresh_knows_the_batches_it_has_seen(spark, tmp_path, zone):
    """A batch that started early and was committed after the refresh is profiled by the next."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        monitor = monitoring.Monitor(
            "log_timestamp", ("transaction_name",), (mean("ms", "response_time_ms"),), "1 hour"
        )
        table, path = str(tmp_path / "logs"), str(tmp_path / "profile")
        batches(spark, table, (0, [(ago(hours=h), "a", False, h) for h in range(0, 90, 5)]))
        monitoring.create_profile_table(scan(spark, table), monitor, path)
        assert monitoring.read_marks(spark, path) == {"s": 0}
        batches(spark, table, (1, [(ago(hours=50), "a", False, 900)]))
        batches(spark, table, (0, [(ago(hours=3), "b", False, 7)]), stream="t")
        before = {f: f.stat().st_mtime_ns for f in (tmp_path / "profile").glob("*/*.parquet")}
        monitoring.refresh_profile_table(scan(spark, table), monitor, path)
        assert monitoring.read_marks(spark, path) == {"s": 1, "t": 0}
        fresh = monitoring.read_profile_table(spark, path).drop(monitoring.WINDOW_DATE)
        whole = monitoring.run_monitor(scan(spark, table), monitor)
        assert sorted(map(str, fresh.collect())) == sorted(map(str, whole.collect()))
        after = {f for f in (tmp_path / "profile").glob("*/*.parquet")}
        assert {f.parent.name for f in after & set(before)} == {
            "window_date=2024-01-25", "window_date=2024-01-27", "window_date=2024-01-29",
        }
        monitoring.refresh_profile_table(scan(spark, table), monitor, path)
        assert {f for f in (tmp_path / "profile").glob("*/*.parquet")} == after
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_family_is_monitored_as_one_table(spark):
    logs = {
        "bpm_audit": audit(spark, [(NOW, "a", True, 1)]),
        "m2e_audit": audit(spark, [(NOW, "a", False, 3)]).withColumn("extra", F.lit(1)),
    }
    rows = monitoring.run_monitor(
        monitoring.family_logs(logs, "audit").withColumn("is_error", F.lit(False)),
        monitoring.AUDIT_MONITOR,
    )
    assert {r.row_count for r in rows.collect()} == {2}
    with pytest.raises(ValueError):
        monitoring.family_logs(logs, "track_ctx")


# --- refresh from a stored state -----------------------------------------------------

STATE_MONITOR = monitoring.Monitor(
    "log_timestamp",
    ("transaction_name", "cluster"),
    (
        mean("ms", "response_time_ms"), percentile("p50", "response_time_ms", 0.5), maximum("most", "response_time_ms"),
        total("rows", "1"), distinct("instances", "instance_name"), percentile("p95", "response_time_ms", 0.95),
        composed("range", "hi - lo", hi="max(response_time_ms)", lo="min(response_time_ms)"),
        composed("share", "bad / n", bad="sum(case when is_failure then 1.0 else 0.0 end)", n="count(*)"),
        distinct_sketch("about", "instance_name"),
    ),
    "1 hour",
)


def same_as_whole(spark, table, path):
    stored = monitoring.read_profile_table(spark, path).drop(monitoring.WINDOW_DATE)
    whole = monitoring.run_monitor(scan(spark, table), STATE_MONITOR)
    return sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))


def test_a_refresh_from_state_reads_new_batches_only(spark, tmp_path):
    from vigilog.plans import maintenance
    from vigilog.sources.versions import read_state

    table, path = str(tmp_path / "logs"), str(tmp_path / "profile")

    def new_files():
        rows, _ = monitoring.unseen_rows(spark, table, read_state(spark, f"{path}/_state").notes)
        return [] if rows is None else rows.inputFiles()

    batches(spark, table, (0, [(ago(hours=h), "a", False, h) for h in range(0, 60, 5)]))
    assert len(monitoring.refresh_from_state(spark, table, STATE_MONITOR, path)) == 4
    assert same_as_whole(spark, table, path) and new_files() == []
    batches(spark, table, (1, [(ago(hours=50), "a", False, None)]), (2, [(ago(hours=50), "b", False, 7, None, None)]))
    batches(spark, table, (0, [(ago(hours=2), "a", False, 900)]), stream="t")
    assert all("s-000000000000" not in f for f in new_files()) and len(new_files()) == 3
    # A rewrite merges a batch that nobody has seen.
    maintenance.compact_table(spark, table, table)
    assert monitoring.refresh_from_state(spark, table, STATE_MONITOR, path) == ["2024-01-26", "2024-01-28"]
    assert same_as_whole(spark, table, path) and new_files() == []
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "profile").glob("*/*.parquet")}
    maintenance.compact_table(spark, table, table)
    assert monitoring.refresh_from_state(spark, table, STATE_MONITOR, path) == []
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "profile").glob("*/*.parquet")} == before


def test_the_plan_of_a_refresh_does_not_repeat_its_state(spark, tmp_path, monkeypatch):
    """The driver holds a plan once for every step of adaptive execution, so plans have to be small."""
    from vigilog.session import Files, shared_root

    def copies():
        return set(Files(spark, app).folders(app))

    app = f"{shared_root(spark)}/vigilog/{spark.sparkContext.applicationId}"
    plans, store, known = [], monitoring.store_profile, copies()
    monkeypatch.setattr(monitoring, "store_profile", lambda rows, to: plans.append(plan_of(rows, "simple")) or store(rows, to))
    table, path = str(tmp_path / "logs"), str(tmp_path / "profile")
    batches(spark, table, (0, [(ago(hours=h), "a", False, h) for h in range(0, 60, 5)]))
    monitoring.refresh_from_state(spark, table, STATE_MONITOR, path)
    # The base rows, and the kept values twice.
    assert plans[0].count("FileScan parquet") == 3
    assert same_as_whole(spark, table, path) and copies() == known


def test_a_failed_refresh_is_made_good_by_the_next(spark, tmp_path, monkeypatch):
    table, path = str(tmp_path / "logs"), str(tmp_path / "profile")
    batches(spark, table, (0, [(ago(hours=h), "a", False, h) for h in range(0, 60, 5)]))
    monitoring.refresh_from_state(spark, table, STATE_MONITOR, path)
    batches(spark, table, (1, [(ago(hours=50), "a", False, 900)]))
    for step in ("replace_items", "store_profile"):
        with monkeypatch.context() as patch:
            patch.setattr(monitoring, step, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                monitoring.refresh_from_state(spark, table, STATE_MONITOR, path)
    assert monitoring.refresh_from_state(spark, table, STATE_MONITOR, path) == ["2024-01-26"]
    assert same_as_whole(spark, table, path)


def test_a_custom_metric_has_no_state(spark):
    from vigilog.operators.profiles import custom, profile_state

    rows = audit(spark, [(NOW, "a", False, 1)])
    with pytest.raises(ValueError, match="spread"):
        profile_state(rows, "log_timestamp", [custom("spread", "stddev(response_time_ms)")], [])


def test_composed_metrics_are_reduced_before_they_are_fanned_out(spark):
    rows = audit(spark, [(ago(hours=h % 30), "ab"[h % 2], h % 3 == 0, h) for h in range(90)])
    own = [
        composed("range", "hi - lo", "bigint", hi="max(response_time_ms)", lo="min( response_time_ms )"),
        composed("share", "bad / n", bad="sum(case when is_failure then 1.0 else 0.0 end)", n="count(response_time_ms)"),
    ]
    free = [custom("range", "max(response_time_ms) - min(response_time_ms)", "bigint"), custom("share", "avg(cast(is_failure as int))")]
    made, expected = (profile(rows, "log_timestamp", m, ["transaction_name"]) for m in (own, free))
    assert [[round(r.share, 9), r.range, r.slice_value] for r in made.orderBy(*made.columns[:4]).collect()] == [
        [round(r.share, 9), r.range, r.slice_value] for r in expected.orderBy(*expected.columns[:4]).collect()
    ]
    plan = plan_of(made, "simple")
    assert plan.index("Generate explode") > 0 and plan.rindex("HashAggregate") > plan.rindex("Generate explode")
    with pytest.raises(ValueError, match="avg"):
        composed("x", "a", a="avg(response_time_ms)")


def test_sketches_of_hours_merge_to_days(spark):
    from vigilog.operators.profiles import SKETCH_ERROR

    rows = spark.range(200_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 80_000).alias("t"),
        F.concat(F.lit("u"), F.col("id") % 50_000).alias("user"),
    )
    day = profile(rows, "t", [distinct_sketch("about", "user")], [], ("1 hour", "1 day")).filter("granularity = '1 day'").first()
    assert abs(day.about - 50_000) <= 5 * SKETCH_ERROR * 50_000
