import json
from datetime import datetime, timedelta, timezone

import pytest
from conftest import NOW, ago
from helpers import plan_of, utc
from pyspark.sql import functions as F

from vigilog.operators import alerts
from vigilog.plans import dashboards
from vigilog.plans.dashboards import dashboard
from vigilog.schemas import ANOMALIES


def anomaly(spark, *changes):
    base = {
        "anomaly_id": "id",
        "anomaly_type": "VOLUME_DROP",
        "severity": "HIGH",
        "detected_at": utc(NOW),
        "time_window_start": utc(ago(minutes=15)),
        "time_window_end": utc(NOW),
        "affected_service": "s",
        "affected_instance": None,
        "affected_cluster": None,
        "metric_name": "log_count",
        "metric_value": 2.345,
        "threshold_value": 30.0,
        "baseline_value": None,
        "details": "d",
        "log_count": 2,
        "metadata": {},
    }
    rows = []
    for i, change in enumerate(changes):
        rows.append({**base, "anomaly_id": f"id{i}", **change})
    return spark.createDataFrame(
        [tuple(r[f] for f in ANOMALIES.fieldNames()) for r in rows], ANOMALIES
    )


def test_recent_has_closed_bounds(spark):
    df = anomaly(
        spark,
        {"detected_at": utc(ago(hours=1))},
        {"detected_at": utc(ago(hours=1, microseconds=1))},
        {"detected_at": utc(NOW)},
        {"detected_at": utc(ago(microseconds=-1))},
    )
    found = alerts.recent_anomalies(df, NOW)
    assert {r.anomaly_id for r in found.collect()} == {"id0", "id2"}
    assert alerts.recent_anomalies(df, NOW, hours_back=2).count() == 3


def test_severities_come_in_rank_order(spark):
    df = anomaly(
        spark, *[{"severity": s} for s in ("LOW", "odd", "HIGH", "CRITICAL", "MEDIUM", "HIGH")]
    )
    listed = [(r.severity, r["count"]) for r in alerts.by_severity(df).collect()]
    assert listed == [("CRITICAL", 1), ("HIGH", 2), ("MEDIUM", 1), ("LOW", 1), ("odd", 1)]


def test_top_services(spark):
    changes = [{"affected_service": None}] * 9
    changes += [{"affected_service": "b", "severity": s} for s in ("CRITICAL", "MEDIUM", "LOW")]
    changes += [{"affected_service": "a", "anomaly_type": t} for t in ("X", "Y", "Y")]
    changes += [{"affected_service": f"z{i:02}"} for i in range(20)]
    top = alerts.top_services(anomaly(spark, *changes)).collect()
    assert [r.affected_service for r in top] == ["a", "b"] + [f"z{i:02}" for i in range(8)]
    assert (top[0].anomaly_count, top[0].anomaly_types) == (3, 2)
    assert (top[1].max_severity, top[1].worst_severity) == ("MEDIUM", "CRITICAL")


def test_messages(spark):
    df = anomaly(spark, {}, {"metric_value": 0.0}, {"metric_value": None}, {"severity": "INFO"})
    found = {r.id: r for r in alerts.alert_messages(df).collect()}
    assert found.keys() == {"id0", "id1", "id2"}
    assert found["id0"].metric == f"log_count={2.345:.2f}"
    assert found["id1"].metric is None and found["id2"].metric is None
    assert found["id0"].time_window == "2024-01-28 23:45:00 to 2024-01-29 00:00:00"


@pytest.mark.parametrize("value", [0.125, 0.375, 2.675, 1.005, 1e9 + 0.125, -0.125, 12.5])
def test_fixed_point_text_is_the_usual_one(spark, value):
    from vigilog.functions.text import fixed

    row = spark.range(1).select(
        *[fixed(F.lit(value), digits).alias(f"d{digits}") for digits in (0, 1, 2)]
    )
    assert tuple(row.first()) == (f"{value:.0f}", f"{value:.1f}", f"{value:.2f}")


def test_rendering_leaves_out_empty_lines(spark):
    df = anomaly(
        spark,
        {"affected_service": None, "threshold_value": 0.0},
        {"affected_instance": "i", "affected_cluster": "c", "baseline_value": 1.5},
    )
    texts = {r.id: r.text for r in alerts.rendered(alerts.alert_messages(df)).collect()}
    assert texts["id0"].split("\n") == [
        "[HIGH] VOLUME_DROP",
        "  Service: N/A",
        f"  Metric: log_count={2.345:.2f}",
        "  Details: d",
        "  Time Window: 2024-01-28 23:45:00 to 2024-01-29 00:00:00",
        "  Detected At: 2024-01-29 00:00:00",
        "",
    ]
    assert "  Instance: i\n  Cluster: c\n" in texts["id1"]
    assert "  Threshold: 30.00\n  Baseline: 1.50\n" in texts["id1"]


def test_moments_show_microseconds_only_where_there_are_any(spark):
    from vigilog.functions.text import moment

    at = datetime(2024, 1, 1, 2, 3, 4, 500, tzinfo=timezone.utc)
    assert spark.range(1).select(moment(F.lit(at))).first()[0] == "2024-01-01 02:03:04.000500"


def test_routes(spark):
    df = anomaly(spark, *[{"severity": s} for s in ("LOW", "MEDIUM", "HIGH", "CRITICAL", "INFO")])
    counts = alerts.route_counts(alerts.alert_messages(df)).collect()
    assert [tuple(r) for r in counts] == [
        ("CRITICAL", "on-call", 1),
        ("HIGH", "operations", 1),
        ("MEDIUM", "dashboard", 1),
        ("LOW", "dashboard", 1),
    ]


def payloads(spark, *changes):
    messages = alerts.alert_messages(anomaly(spark, *changes))
    rows = alerts.notification_payloads(messages, NOW).collect()
    return [json.loads(r.payload) for r in sorted(rows, key=lambda r: (r.part != "header", r.id))]


def test_payload_has_a_header_and_a_line_for_each_critical_alert(spark):
    head, line = payloads(spark, {"severity": "CRITICAL", "affected_service": None}, {}, {})
    assert head == {
        "timestamp": "2024-01-29T00:00:00",
        "summary": "Log Anomaly Detection: 1 CRITICAL, 2 HIGH alerts",
        "critical_count": 1,
        "high_count": 2,
    }
    assert line == {"severity": "CRITICAL", "type": "VOLUME_DROP", "service": None, "details": "d"}
    (quiet,) = payloads(spark, {})
    assert quiet["critical_count"] == 0 and quiet["high_count"] == 1
    assert payloads(spark, {"severity": "LOW"}) == []


def test_the_form_of_a_payload_does_not_depend_on_the_number_of_alerts(spark):
    changes = [{"severity": "CRITICAL", "details": f"d{i}"} for i in range(50)]
    head, *lines = payloads(spark, *changes)
    assert head["critical_count"] == 50
    assert sorted(a["details"] for a in lines) == sorted(f"d{i}" for i in range(50))


def test_a_dashboard_reads_as_far_back_as_its_text(spark, tmp_path):
    from vigilog.sources.tables import append_anomalies, read_anomalies

    path = str(tmp_path / "anomalies")
    append_anomalies(anomaly(spark, {}, {"detected_at": utc(ago(days=20))}), path)
    text = "SELECT count(*) AS n FROM {a} WHERE detected_at >= :as_of - INTERVAL 30 DAYS"
    table = read_anomalies(spark, path)
    assert dashboard(text, NOW, a=table).first().n == 2
    month = dashboards.Dashboard(timedelta(days=30), text)
    assert dashboard(month, NOW, a=table).first().n == 2


def test_latest_keeps_rows_without_a_date(spark):
    rows = [(1, NOW, NOW.date()), (2, None, None)]
    table = spark.createDataFrame(rows, "id int, at timestamp, day date")
    assert [r.id for r in alerts.latest(table, "at", 5, "id", "day").collect()] == [1, 2]


def test_ids_of_different_parts_differ(spark):
    from vigilog.functions.text import stable_id

    rows = [("a|b", "c"), ("a", "b|c"), ("~", "c"), (None, "c"), ("1:a", ""), ("", "1:a")]
    found = spark.createDataFrame(rows, "x string, y string").select(stable_id(F.col("x"), F.col("y")).alias("i"))
    assert len({r.i for r in found.collect()}) == len(rows)


def test_dashboards(spark):
    df = anomaly(
        spark,
        {"severity": "CRITICAL"},
        {"detected_at": utc(ago(minutes=30))},
        {"detected_at": utc(ago(days=3)), "affected_service": None, "severity": "MEDIUM"},
        {"detected_at": utc(ago(days=8))},
        {"detected_at": utc(ago(days=-1))},
    )
    hours = dashboard(dashboards.ANOMALIES_OVER_TIME, NOW, anomalies=df).collect()
    assert [r.hour for r in hours] == [NOW, ago(hours=1)]
    top = dashboard(dashboards.TOP_SERVICES, NOW, anomalies=df).collect()
    assert [tuple(r)[:5] for r in top] == [("s", 2, 1, 1, 0), (None, 1, 0, 0, 1)]
    assert top[0].last_anomaly == NOW
    critical = dashboard(dashboards.RECENT_CRITICAL, NOW, anomalies=df)
    assert [r.detected_at for r in critical.collect()] == [NOW]
    day = dashboard(dashboards.LAST_DAY_BY_SEVERITY, NOW, anomalies=df)
    assert [tuple(r) for r in day.collect()] == [
        ("CRITICAL", "VOLUME_DROP", 1),
        ("HIGH", "VOLUME_DROP", 1),
    ]
    week = dashboard(dashboards.LAST_WEEK_TOP_SERVICES, NOW, anomalies=df)
    assert [tuple(r) for r in week.collect()] == [("s", 2), (None, 1)]


def test_latest_reads_only_the_newest_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    logs = spark.range(300).select(
        F.col("id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("at"),
    )
    logs.withColumn("day", F.to_date("at")).write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    newest = alerts.latest(table, "at", 30, "id", "day")
    assert [r.id for r in newest.collect()] == list(range(299, 269, -1))
    assert alerts.latest(table, "at", 1000, "id", "day").count() == 300
    plan = plan_of(newest)
    assert "TakeOrderedAndProject" in plan and "Subquery" in plan
    scans = [p for p in plan.split("PartitionFilters: ")[1:] if "subquery" in p.split("\n")[0]]
    assert scans, "the newest date must prune partitions of the main scan"


def test_latest_query_covers_the_whole_track_table(spark):
    from conftest import SF_DIR

    from vigilog.registry import queries

    found = queries.QUERIES["latest_track"](spark, SF_DIR).toPandas()
    logs = queries._normalized(spark, SF_DIR, queries.TRACK_MDC)
    assert len(found) == logs.count() and found.log_timestamp.isna().any()
