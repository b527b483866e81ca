from datetime import datetime, timedelta

import pytest
from conftest import NOW, ago
from helpers import audit, utc
from pyspark.sql import functions as F
from test_alerts import anomaly

from vigilog.plans import maintenance
from vigilog.sources.versions import vacuum
from vigilog.sources.tables import LOG_DATE, append_anomalies, read_anomalies, replace_dates, scan

#: Long after everything that these tests replace.
LATER = datetime(2200, 1, 1)


def logs_by_date(spark, path, *rows):
    df = audit(spark, list(rows)).withColumn(LOG_DATE, F.to_date("log_timestamp"))
    df.write.mode("append").partitionBy(LOG_DATE).parquet(path)


def files(path):
    return {f.relative_to(path) for f in path.rglob("*.parquet")}


def test_acknowledging_rewrites_no_row(spark, tmp_path):
    path = tmp_path / "anomalies"
    append_anomalies(anomaly(spark, {}, {}, {"detected_at": utc(ago(days=2))}), str(path))
    before = files(path)
    maintenance.acknowledge(spark, str(path), [], NOW)
    assert files(path) == before
    maintenance.acknowledge(spark, str(path), ["id1"], NOW)
    assert before < files(path) and {f.parts[0] for f in files(path) - before} == {"_acknowledgements"}
    table = {r.anomaly_id: r for r in read_anomalies(spark, str(path)).collect()}
    assert table.keys() == {"id0", "id1", "id2"}
    assert [table[i].acknowledged for i in ("id0", "id1", "id2")] == [False, True, False]
    assert table["id1"].acknowledged_at == NOW and table["id1"].acknowledged_by is None
    assert table["id0"].acknowledged_at is None
    again = spark.createDataFrame([("id1",), ("id1",), ("other",)], "anomaly_id string")
    maintenance.acknowledge(spark, str(path), again, ago(hours=-1))
    table = {r.anomaly_id: r for r in read_anomalies(spark, str(path)).collect()}
    assert len(table) == 3 and table["id1"].acknowledged_at == ago(hours=-1)


def test_acknowledged_rows_and_appends_live_together(spark, tmp_path):
    path = str(tmp_path / "anomalies")
    append_anomalies(anomaly(spark, {}), path)
    maintenance.acknowledge(spark, path, ["id0"], NOW)
    append_anomalies(anomaly(spark, {"anomaly_id": "new"}), path)
    flags = {r.anomaly_id: r.acknowledged for r in read_anomalies(spark, path).collect()}
    assert flags == {"id0": True, "new": False}


def test_retention(spark, tmp_path):
    path = tmp_path / "logs"
    limit = NOW - timedelta(days=90) + timedelta(hours=6)
    logs_by_date(
        spark,
        str(path),
        (limit, "edge", False, 1),
        (limit - timedelta(microseconds=1), "gone", False, 1),
        (limit - timedelta(days=40), "old", False, 1),
        (NOW, "new", False, 1),
    )
    spark.createDataFrame([("torn",)], "transaction_name string").withColumn(
        LOG_DATE, F.lit(None).cast("date")
    ).write.mode("append").partitionBy(LOG_DATE).parquet(str(path))
    untouched = {f for f in files(path) if "2024-01-29" in str(f)}
    dropped = maintenance.apply_retention(spark, str(path), NOW + timedelta(hours=6))
    left = {r.transaction_name for r in scan(spark, str(path)).collect()}
    assert left == {"edge", "new", "torn"} and dropped == ["2023-09-21"]
    assert untouched <= files(path)


def test_retention_drops_a_boundary_day_without_newer_rows(spark, tmp_path):
    path = str(tmp_path / "logs")
    limit = NOW - timedelta(days=90)
    logs_by_date(spark, path, (limit + timedelta(hours=1), "gone", False, 1), (NOW, "s", False, 1))
    dropped = maintenance.apply_retention(spark, path, NOW + timedelta(hours=6))
    assert dropped == ["2023-10-31"]
    assert [r.transaction_name for r in scan(spark, path).collect()] == ["s"]


def test_compaction_keeps_rows_and_merges_files(spark, tmp_path):
    source, target = tmp_path / "logs", tmp_path / "compact"
    for i in range(6):
        logs_by_date(
            spark,
            str(source),
            (ago(hours=i), "s", False, i),
            (ago(days=3, hours=i), "s", False, 10 + i),
        )
    maintenance.compact_table(spark, str(source), str(target))
    assert sorted(map(str, scan(spark, str(target)).collect())) == sorted(
        map(str, scan(spark, str(source)).collect())
    )
    dates = {f.parts[0] for f in files(source)}
    assert len(files(source)) >= 12 and len(files(target)) == len(dates)
    maintenance.compact_table(spark, str(source), str(source), dates=["2024-01-25"])
    vacuum(spark, str(source), LATER)
    per_date = [f.parts[0] for f in files(source)]
    assert per_date.count("log_date=2024-01-25") == 1
    assert scan(spark, str(source)).count() == 12


def test_a_heavy_date_is_split(spark, tmp_path):
    """REBALANCE must not put one date into one task."""
    rows = spark.range(400_000).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 80000).alias("log_timestamp"),
        F.lit("2024-01-01").cast("date").alias(LOG_DATE),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        compact = maintenance.compacted(rows, "log_timestamp")
        compact.write.partitionBy(LOG_DATE).parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    table = scan(spark, str(tmp_path / "t"))
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 400_000 and len(sizes) > 3 and max(sizes) < 200_000


def test_no_rewrite_loses_a_column(spark, tmp_path):
    path = tmp_path / "logs"
    logs_by_date(spark, str(path), (ago(days=1), "s", False, 1))
    extra = audit(spark, [(NOW, "s", False, 2)]).withColumn("added", F.lit("x"))
    extra.withColumn(LOG_DATE, F.to_date("log_timestamp")).write.mode("append").partitionBy(LOG_DATE).parquet(str(path))
    for _ in range(2):
        assert {r.added for r in scan(spark, str(path)).collect()} == {None, "x"}
        maintenance.compact_table(spark, str(path), str(path))
    maintenance.apply_retention(spark, str(path), NOW + timedelta(days=89, hours=12))
    assert [(r.added, r.response_time_ms) for r in scan(spark, str(path)).collect()] == [("x", 2)]
    logs_by_date(spark, str(path), (NOW, "s", False, 1))
    extra.withColumn(LOG_DATE, F.to_date("log_timestamp")).write.mode("append").partitionBy(LOG_DATE).parquet(str(path))
    with pytest.raises(ValueError, match="added"):
        replace_dates(scan(spark, str(path)).drop("added"), str(path), [LOG_DATE])


def test_acknowledging_keeps_columns_it_does_not_know(spark, tmp_path):
    path = str(tmp_path / "anomalies")
    append_anomalies(anomaly(spark, {"anomaly_id": "old"}).withColumn("runbook", F.lit("r")), path)
    append_anomalies(anomaly(spark, {"detected_at": utc(ago(hours=1))}), path)
    maintenance.acknowledge(spark, path, ["old"], NOW)
    found = {r.anomaly_id: (r.runbook, r.acknowledged) for r in read_anomalies(spark, path).collect()}
    assert found == {"old": ("r", True), "id0": (None, False)}


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_retention_goes_by_utc_days(spark, tmp_path, zone):
    from vigilog.functions.times import utc_date

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path = str(tmp_path / "logs")
        limit = NOW - timedelta(days=90) + timedelta(hours=2)
        logs = audit(spark, [(limit + timedelta(hours=h), str(h), False, 1) for h in range(-30, 30, 3)])
        logs.withColumn(LOG_DATE, utc_date(logs, "log_timestamp")).write.partitionBy(LOG_DATE).parquet(path)
        kept = {r.transaction_name for r in maintenance.retained(logs, "log_timestamp", NOW + timedelta(hours=2)).collect()}
        maintenance.apply_retention(spark, path, NOW + timedelta(hours=2))
        assert {r.transaction_name for r in scan(spark, path).collect()} == kept and len(kept) == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_the_same_run_again_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "anomalies")
    for _ in range(2):
        append_anomalies(anomaly(spark, {}, {}), path, "one")
    append_anomalies(anomaly(spark, {"detected_at": utc(ago(hours=-1))}), path)
    assert read_anomalies(spark, path).count() == 3


def test_copies_need_a_shared_folder_off_one_machine(spark, monkeypatch):
    from vigilog import session

    class Elsewhere:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: None)})
        sparkContext = type("Context", (), {"master": "yarn", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="share"):
        session.shared_root(Elsewhere)
    with session.scratch(spark):
        copy = session.materialize(spark.range(3), "t")
        path = copy.inputFiles()[0]
        assert copy.count() == 3
    assert not session.Files(spark, path).exists(path.rsplit("/", 1)[0])
    monkeypatch.setattr(session, "_one_machine", lambda s: False)
    assert session.materialize(spark.range(7), "checked").count() == 7


def test_a_date_in_no_batch_folder_can_be_garbage(spark, tmp_path):
    """Dates far out of range make folders, not failures."""
    from vigilog.streaming.ingest import save_batch

    path = str(tmp_path / "logs")
    rows = audit(spark, [(NOW, "s", False, 1)]).withColumn(LOG_DATE, F.lit(None).cast("date"))
    save_batch(rows, path, "q", 0)
    save_batch(rows.withColumn(LOG_DATE, F.lit("9999-12-31").cast("date")), path, "q", 1)
    maintenance.compact_table(spark, path, path)
    assert maintenance.apply_retention(spark, path, NOW) == [] and scan(spark, path).count() == 2
