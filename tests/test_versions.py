"""Rewrites take effect at once or not at all; nothing is lost or doubled around them."""

from datetime import datetime, timedelta

import pytest
from conftest import NOW, ago
from helpers import audit, utc
from pyspark.sql import functions as F
from test_alerts import anomaly
from test_detectors import CFG, six_feeds

from vigilog.plans import detection, maintenance
from vigilog.sources import tables, versions
from vigilog.sources.tables import LOG_DATE, read_anomalies, save_anomalies, scan
from vigilog.sources.versions import Conflict, live_items, read_state, vacuum
from vigilog.streaming.ingest import save_batch

LATER = datetime(2200, 1, 1)


def batch(spark, path, number, *values, stream="s", days=0, hours=1):
    rows = audit(spark, [(ago(days=days, hours=hours), "svc", False, v) for v in values])
    save_batch(rows.withColumn(LOG_DATE, F.to_date("log_timestamp")), path, stream, number)


def values(spark, path):
    return sorted(r.response_time_ms for r in scan(spark, path).collect())


@pytest.fixture
def path(spark, tmp_path):
    table = str(tmp_path / "logs")
    for number in range(4):
        batch(spark, table, number, *range(10 * number, 10 * number + 10))
    return table


def during(monkeypatch, module, what):
    """Do something after a rewrite has listed its items and before it writes."""
    real = module.replace_items

    def meanwhile(*args, **kwargs):
        monkeypatch.setattr(module, "replace_items", real)
        what()
        return real(*args, **kwargs)

    monkeypatch.setattr(module, "replace_items", meanwhile)


def test_a_batch_that_is_committed_during_compaction_stays(spark, path, monkeypatch):
    during(monkeypatch, maintenance, lambda: batch(spark, path, 4, *range(40, 50)))
    maintenance.compact_table(spark, path, path)
    assert values(spark, path) == list(range(50))
    maintenance.compact_table(spark, path, path)
    vacuum(spark, path, LATER)
    assert values(spark, path) == list(range(50))
    assert len(live_items(spark, path)) == 2  # the newest batch and all others


def test_files_that_are_added_to_a_date_during_compaction_stay(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "plain")

    def add(*own):
        rows = audit(spark, [(NOW, "svc", False, v) for v in own]).withColumn(LOG_DATE, F.to_date("log_timestamp"))
        rows.write.mode("append").partitionBy(LOG_DATE).parquet(table)

    add(1, 2)
    add(3)
    during(monkeypatch, maintenance, lambda: add(4))
    maintenance.compact_table(spark, table, table)
    assert values(spark, table) == [1, 2, 3, 4] and versions.VERSION not in scan(spark, table).columns
    add(5)
    maintenance.compact_table(spark, table, table)
    vacuum(spark, table, LATER)
    assert values(spark, table) == [1, 2, 3, 4, 5] and len(live_items(spark, table)) == 1


@pytest.mark.parametrize("step", ["commit", "read_state", "all_items"])
def test_a_failure_leaves_the_old_version(spark, path, monkeypatch, step):
    real, left = getattr(versions, step), {"calls": 0}

    def fail(*args, **kwargs):
        left["calls"] += 1
        if step == "commit" or left["calls"] > 3:
            raise OSError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, step, fail)
    with pytest.raises(OSError, match="lost"):
        maintenance.compact_table(spark, path, path)
        maintenance.compact_table(spark, path, path)
    monkeypatch.undo()
    assert values(spark, path) == list(range(40))
    maintenance.compact_table(spark, path, path)
    assert values(spark, path) == list(range(40))
    gone = vacuum(spark, path, LATER)
    assert values(spark, path) == list(range(40)) and gone


def test_a_reader_from_before_finishes_until_vacuum(spark, path):
    before = scan(spark, path)
    maintenance.compact_table(spark, path, path)
    now = datetime.now()
    assert vacuum(spark, path, now + timedelta(hours=167)) == []
    assert before.count() == 40
    gone = vacuum(spark, path, now + timedelta(hours=170))
    assert len(gone) == 3 and values(spark, path) == list(range(40))
    assert read_state(spark, path).replaced == {}


def test_a_repeated_batch_stays_replaced(spark, path):
    batch(spark, path, 0, 900, stream="t")
    batch(spark, path, 1, 901, stream="t")
    maintenance.compact_table(spark, path, path)
    batch(spark, path, 0, 900, stream="t")
    assert values(spark, path) == [*range(40), 900, 901]


def test_of_two_rewrites_of_the_same_items_one_gives_up(spark, path, monkeypatch):
    during(monkeypatch, maintenance, lambda: maintenance.compact_table(spark, path, path))
    with pytest.raises(Conflict):
        maintenance.compact_table(spark, path, path)
    assert values(spark, path) == list(range(40))


def test_two_rewrites_of_different_dates_both_commit(spark, path, monkeypatch):
    batch(spark, path, 0, 100, stream="old", days=3)
    batch(spark, path, 1, 101, stream="old", days=3)
    other = (ago(days=3, hours=1)).date().isoformat()
    during(monkeypatch, maintenance, lambda: maintenance.compact_table(spark, path, path, dates=[other]))
    maintenance.compact_table(spark, path, path, dates=[ago(hours=1).date().isoformat()])
    assert values(spark, path) == [*range(40), 100, 101] and read_state(spark, path).number == 2


def test_retention_keeps_a_batch_that_comes_meanwhile(spark, path, monkeypatch):
    edge, as_of = {"days": 89, "hours": 20}, NOW + timedelta(hours=6)  # two hours too old
    batch(spark, path, 0, 500, stream="old", days=100)
    for number in (1, 2):
        batch(spark, path, number, 500 + number, stream="old", **edge)
    during(monkeypatch, maintenance, lambda: batch(spark, path, 3, 503, stream="old", **edge))
    dropped = maintenance.apply_retention(spark, path, as_of)
    assert dropped == [ago(days=100, hours=1).date().isoformat(), ago(**edge).date().isoformat()]
    assert values(spark, path) == [*range(40), 503]
    assert maintenance.apply_retention(spark, path, as_of) == dropped[1:]
    assert maintenance.apply_retention(spark, path, as_of) == []
    vacuum(spark, path, LATER)
    assert values(spark, path) == list(range(40))


def test_a_table_of_which_everything_expired_keeps_its_columns(spark, path):
    columns = scan(spark, path).columns
    maintenance.apply_retention(spark, path, NOW + timedelta(days=200))
    assert scan(spark, path).columns == columns and values(spark, path) == []


# --- anomalies ---------------------------------------------------------------------


def ids(spark, path):
    return sorted(r.anomaly_id for r in read_anomalies(spark, path).collect())


def test_a_rerun_keeps_acknowledgements(spark, tmp_path):
    feeds, table = {"bpm_audit": six_feeds(spark)["bpm_audit"]}, str(tmp_path / "anomalies")
    detection.detect_and_save(feeds, CFG, NOW, table)
    first = ids(spark, table)
    maintenance.acknowledge(spark, table, first[:3], NOW, by="me")
    detection.detect_and_save(feeds, CFG, NOW, table)
    found = read_anomalies(spark, table).filter("acknowledged").collect()
    assert ids(spark, table) == first and sorted(r.anomaly_id for r in found) == first[:3]
    assert {(r.acknowledged_by, r.acknowledged_at) for r in found} == {("me", NOW)}
    maintenance.acknowledge(spark, table, first[:1], ago(hours=-2), by="you")
    maintenance.acknowledge(spark, table, first[:1], ago(hours=-1), by="late")
    again = read_anomalies(spark, table, declared=True).filter(F.col("anomaly_id") == first[0]).first()
    assert (again.acknowledged_by, again.acknowledged_at) == ("you", ago(hours=-2))


def test_a_run_of_other_feeds_leaves_each_id_once(spark, tmp_path):
    feeds, table = six_feeds(spark), str(tmp_path / "anomalies")
    detection.detect_and_save({"bpm_audit": feeds["bpm_audit"]}, CFG, NOW, table)
    some = ids(spark, table)
    summary = detection.detect_and_save(feeds, CFG, NOW, table)
    every = ids(spark, table)
    assert len(every) == len(set(every)) > len(some) and set(some) < set(every)
    assert sum(r["count"] for r in summary.collect()) == len(every)


def test_a_run_that_finds_less_replaces_its_rows_and_a_failure_keeps_them(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "anomalies")
    save_anomalies(anomaly(spark, {}, {}), table, "run", NOW)
    monkeypatch.setattr(versions, "commit", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        save_anomalies(anomaly(spark, {}), table, "run", NOW)
    monkeypatch.undo()
    assert ids(spark, table) == ["id0", "id1"]
    save_anomalies(anomaly(spark, {}), table, "run", NOW)
    assert ids(spark, table) == ["id0"]
    save_anomalies(anomaly(spark, {}).limit(0), table, "run", NOW)
    assert ids(spark, table) == []


def test_runs_that_save_at_once_add_an_id_once(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "anomalies")
    during(monkeypatch, tables, lambda: save_anomalies(anomaly(spark, {}), table, "one", NOW))
    save_anomalies(anomaly(spark, {}, {}), table, "two", NOW)
    assert ids(spark, table) == ["id0", "id1"]


# --- isolation ---------------------------------------------------------------------


def broken(df):
    return df.withColumn("cluster", F.when(F.lit(True), F.raise_error(F.lit("torn file"))).cast("string"))


def test_a_broken_feed_costs_its_own_rows_only(spark, tmp_path):
    feeds, table = six_feeds(spark), str(tmp_path / "anomalies")
    whole, status = detection.run_isolated(feeds, CFG, NOW)
    expected = {tuple(r) for r in detection.run_detection(feeds, CFG, NOW).select("anomaly_id", "details").collect()}
    assert {tuple(r) for r in whole.select("anomaly_id", "details").collect()} == expected
    rows = status.collect()
    assert {r.status for r in rows} == {"ok"} and sum(r.row_count for r in rows) == whole.count()
    bad = feeds | {"bpm_perf": broken(feeds["bpm_perf"])}
    rows = detection.detect_isolated_and_save(bad, CFG, NOW, table).collect()
    failed = [r for r in rows if r.status == "failed"]
    assert failed and {r.feed for r in failed} == {"bpm_perf"} and {r.row_count for r in failed} == {None}
    assert all("torn file" in r.message for r in failed)
    rest = detection.run_detection({k: v for k, v in feeds.items() if k != "bpm_perf"}, CFG, NOW)
    kept = {r.anomaly_id for r in rest.collect()}
    assert kept <= set(ids(spark, table))
    assert len(ids(spark, table)) == sum(r.row_count for r in rows if r.status == "ok")


def test_a_missing_file_is_a_status_too(spark, tmp_path):
    feeds, gone = six_feeds(spark), str(tmp_path / "gone")
    feeds["m2e_audit"].write.parquet(gone)
    lost = spark.read.parquet(gone)
    for file in (tmp_path / "gone").glob("*.parquet"):
        file.write_bytes(b"PAR1 no longer")
    for file in (tmp_path / "gone").glob(".*.crc"):
        file.unlink()
    _, status = detection.run_isolated({"bpm_audit": feeds["bpm_audit"], "m2e_audit": lost}, CFG, NOW)
    assert {(r.feed, r.status) for r in status.collect()} == {("bpm_audit", "ok"), ("m2e_audit", "failed")}


def test_utc_instants(spark):
    assert utc(NOW).isoformat().endswith("+00:00")
