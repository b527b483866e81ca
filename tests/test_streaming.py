import json

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from vigilog.config import AUDIT, FEEDS, TRACK_CTX, TRACK_MDC
from vigilog.operators.normalize import normalize
from vigilog.registry import raw_views
from vigilog.registry.event_views import read_events
from vigilog.sources.json_feeds import parse_lines, read_feed, write_lines
from vigilog.sources.tables import scan
from vigilog.streaming.ingest import quarantined, save_batch, start_ingest


def ingest(spark, root, feed="bpm_audit", **options):
    query = start_ingest(
        spark,
        feed,
        str(root / "in"),
        str(root / "table"),
        str(root / "checkpoint"),
        trigger=None,
        **options,
    )
    query.awaitTermination()
    return query


def put(root, name, *records):
    (root / "in").mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (root / "in" / name).write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize("feed", ["bpm_audit", "bpm_perf", "maf_perf"])
def test_stream_equals_batch(spark, tmp_path, feed):
    family = FEEDS[feed].family
    lines = raw_views.feed_lines(read_events(spark, SF_DIR), family).repartition(5)
    write_lines(lines, str(tmp_path / "in"))
    ingest(spark, tmp_path, feed)
    expected = normalize(read_feed(spark, family, str(tmp_path / "in")), family)
    names = [c for c in expected.columns if c != "ingestion_timestamp"]
    columns = [F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])).alias("row")]
    got = sorted(r.row for r in scan(spark, str(tmp_path / "table")).select(*columns).collect())
    assert got == sorted(r.row for r in expected.select(*columns).collect()) and len(got) == 1000


def test_restart_takes_only_new_files(spark, tmp_path):
    put(tmp_path, "a.json", {"level": "INFO", "timeMillis": 1704067200000})
    ingest(spark, tmp_path)
    put(tmp_path, "b.json", {"level": "ERROR", "timeMillis": 1704153600000})
    ingest(spark, tmp_path)
    ingest(spark, tmp_path)
    rows = scan(spark, str(tmp_path / "table")).collect()
    assert sorted((str(r.log_date), r.is_error) for r in rows) == [
        ("2024-01-01", False),
        ("2024-01-02", True),
    ]


def test_rate_limit(spark, tmp_path):
    for i in range(5):
        put(tmp_path, f"{i}.json", {"level": "INFO", "timeMillis": 1704067200000 + i})
    query = ingest(spark, tmp_path, max_files=2)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 1]


def test_bad_lines_are_quarantined_and_do_not_stop_the_stream(spark, tmp_path):
    put(
        tmp_path,
        "a.json",
        "not json",
        {"timeMillis": 1704067200000, "message": {"ElapsedTime": "abc"}},
        {"timeMillis": 1704067200000, "threadId": "many"},
        {"level": "INFO"},
        {"threadId": "many", "level": "WARN"},
    )
    ingest(spark, tmp_path)
    table = scan(spark, str(tmp_path / "table"))
    assert [r.line for r in quarantined(table, AUDIT).collect()] == ["not json"]
    assert table.filter("log_date = '2024-01-01'").count() == 2 and table.count() == 5


def test_one_map_only_stage(spark, tmp_path):
    put(tmp_path, "a.json", {"level": "INFO"})
    df = normalize(read_feed(spark, TRACK_CTX, str(tmp_path / "in")), TRACK_CTX)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_parser_is_not_doubled_by_a_filter(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    df = normalize(parse_lines(lines, TRACK_MDC, F.col("value")), TRACK_MDC).filter("is_error")
    assert df._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    put(tmp_path, "a.json", *[{"level": "INFO", "timeMillis": 1704067200000 + i * 40_000_000} for i in range(4)])
    df = normalize(read_feed(spark, AUDIT, str(tmp_path / "in")), AUDIT)
    for _ in range(2):
        save_batch(df, str(tmp_path / "t"), "q", 5)
    table = scan(spark, str(tmp_path / "t"))
    assert table.count() == 4 and {(r.ingest_query, r.ingest_batch) for r in table.collect()} == {("q", 5)}


def test_a_batch_writes_few_files_a_date(spark, tmp_path):
    put(tmp_path, "a.json", *[{"level": "INFO", "timeMillis": 1704067200000 + i % 3 * 86_400_000} for i in range(400)])
    df = normalize(read_feed(spark, AUDIT, str(tmp_path / "in")), AUDIT).repartition(16)
    save_batch(df, str(tmp_path / "t"), "q", 0)
    assert len(list((tmp_path / "t").glob("*/*/*.parquet"))) == 3
    assert scan(spark, str(tmp_path / "t")).count() == 400


def test_an_ingested_table_can_be_compacted_trimmed_and_go_on(spark, tmp_path):
    from datetime import datetime

    from vigilog.plans import maintenance
    from vigilog.sources.versions import vacuum

    path = str(tmp_path / "table")
    for i in range(6):
        put(tmp_path, f"{i}.json", {"level": "INFO", "timeMillis": 1704067200000 + i * 1000}, {"level": "WARN", "timeMillis": 1698796800000 + i})
    ingest(spark, tmp_path, max_files=2)
    before = sorted(r.timeMillis for r in scan(spark, path).collect())
    maintenance.compact_table(spark, path, path)
    assert sorted(r.timeMillis for r in scan(spark, path).collect()) == before and len(before) == 12
    vacuum(spark, path, datetime(2200, 1, 1))
    assert sorted(r.timeMillis for r in scan(spark, path).collect()) == before
    day = [f.name for f in (tmp_path / "table" / "log_date=2024-01-01").iterdir()]
    assert len(day) == 2 and sum("compacted" in d for d in day) == 1
    put(tmp_path, "new.json", {"level": "INFO", "timeMillis": 1704067200000})
    ingest(spark, tmp_path)
    maintenance.compact_table(spark, path, path)
    dropped = maintenance.apply_retention(spark, path, datetime(2024, 2, 1))
    assert dropped == ["2023-11-01"] and scan(spark, path).count() == 7
    copy = str(tmp_path / "copy")
    maintenance.compact_table(spark, path, copy)
    assert scan(spark, copy).count() == 7


def test_fields_that_a_feed_adds_are_kept(spark, tmp_path):
    path = str(tmp_path / "table")
    put(tmp_path, "a.json", {"level": "INFO", "timeMillis": 1704067200000})
    ingest(spark, tmp_path)
    put(tmp_path, "b.json", {"level": "WARN", "timeMillis": 1704067200000, "new": {"a": [1, None]}, "message": {"Mode": "m", "More": 1.5}},
        {"level": "INFO", "message.More": "x", "message": {"More": None}})
    (tmp_path / "in" / "c.json").write_text("torn {")
    ingest(spark, tmp_path, rescue=True)  # the same checkpoint
    rows = {(r.level, r.message.Mode if r.message else None): r.rescued for r in scan(spark, path).collect()}
    assert rows[("WARN", "m")] == {"new": '{"a":[1,null]}', "message.More": "1.5"}
    found = [r.rescued for r in scan(spark, path).filter("level = 'INFO'").collect()]
    assert sorted(found, key=str) == sorted([None, {"message.More": None}], key=str)
    assert scan(spark, path).filter("rescued is not null").count() == 2
