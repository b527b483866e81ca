"""Every registered query against its SQL, and the shape of the plans behind them."""

import re

import pytest
from conftest import SF_DIR
from helpers import plan_of
from oracle_check import compare, connect

import __spark_entry__ as entry
from vigilog.registry import oracle
from vigilog.registry import queries as registered
from vigilog.registry.event_views import audit_logs, log_events, read_events, track_logs

QUERIES = registered.QUERIES
ORACLE = oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_its_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "anomaly_id"


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


LAZY = [n for n in QUERIES if not n.startswith(("stream", "retention", "compaction"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_plan_has_a_cross_join_or_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR), "simple")
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in plan


BASELINE = ["d1_failure_rate_spike", "d2_missing_heartbeat", "d5_volume_anomaly", "d6_service_degradation"]


@pytest.mark.parametrize("name", BASELINE)
def test_baseline_detectors_scan_once_and_join_nothing(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR), "simple")
    feeds = 1 if name.startswith(("d1", "d6")) else 2
    assert plan.count("FileScan parquet") == feeds
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == (2 if name.startswith("d5") else 1)


@pytest.mark.parametrize("name", BASELINE + ["d3_high_response_time", "d4_transaction_timeout"])
def test_time_ranges_reach_the_scan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    scans = [part for part in plan.split("Location: ")[1:] if "events.parquet" in part[:200]]
    assert scans
    for scan in scans:
        (pushed,) = re.findall(r"PushedFilters: \[(.*)\]", scan)
        (schema,) = re.findall(r"ReadSchema: struct<(.*)>", scan)
        assert "GreaterThanOrEqual(ts" in pushed and "props" not in schema


def test_partitioned_log_tables_are_pruned(spark, tmp_path):
    from pyspark.sql import functions as F

    from vigilog.operators.detectors import detect_transaction_timeouts
    from vigilog.sources.tables import LOG_DATE

    path = str(tmp_path / "logs")
    logs = track_logs(read_events(spark, SF_DIR))
    logs.withColumn(LOG_DATE, F.to_date("log_timestamp")).write.partitionBy(LOG_DATE).parquet(path)
    found = detect_transaction_timeouts(
        {"m2e_perf": spark.read.parquet(path)}, registered.CONFIG, registered.AS_OF
    )
    (filters,) = re.findall(r"PartitionFilters: \[(.*)\]", plan_of(found))
    assert "log_date" in filters and "2024-01-23" in filters and "2024-01-30" in filters
    direct = detect_transaction_timeouts({"m2e_perf": logs}, registered.CONFIG, registered.AS_OF)
    assert sorted(found.collect(), key=str) == sorted(direct.collect(), key=str)


def test_the_views_have_the_disturbances(spark):
    events = read_events(spark, SF_DIR)
    assert log_events(events).count() == 1059
    assert audit_logs(events).count() == track_logs(events).count() == 1059


@pytest.mark.parametrize("name", ["stream_ingest_track", "stream_rescue"])
def test_events_are_dealt_to_all_cores_before_they_become_lines(spark, monkeypatch, name):
    """A file of one row group is read by one task, which must not make all lines."""

    class Seen(Exception):
        pass

    def seen(lines, path):
        plan = lines._jdf.queryExecution().optimizedPlan().toString()
        raise Seen(lines.rdd.getNumPartitions(), *plan.split("Repartition", 1))

    monkeypatch.setattr(registered, "write_lines", seen)
    with pytest.raises(Seen) as found:
        QUERIES[name](spark, SF_DIR)
    parts, made, dealt = found.value.args
    assert parts >= spark.sparkContext.defaultParallelism
    assert "not json" in made and "not json" not in dealt
