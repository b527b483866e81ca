import random

import pytest
from pyspark.sql import functions as F

from vigilog.operators import percentiles
from vigilog.operators.percentiles import approximate_percentiles, exact_percentiles

FRACTIONS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def builtin(df):
    return df.filter("v is not null").groupBy("g").agg(
        F.count("*").alias("value_count"),
        F.avg("v").alias("value_mean"),
        *[F.percentile("v", F.lit(f)).alias(n) for n, f in FRACTIONS.items()],
    )


def as_map(df):
    return {r.g: r.asDict() for r in df.collect()}


def data():
    rnd = random.Random(7)
    rows = []
    for group, size, top in [("a", 1, 9), ("b", 2, 10**6), (None, 501, 50), ("d", 3000, 10**12)]:
        rows += [(group, rnd.randint(-top // 3, top)) for _ in range(size)]
    rows += [("hot", rnd.choice([3, 8192, 8193, 10**6])) for _ in range(4000)]
    rows += [("a", None), ("empty", None)]
    return rows


@pytest.mark.parametrize("limit", [10**6, 0], ids=["broadcast", "shuffled"])
def test_equal_to_the_builtin_percentile(spark, limit):
    df = spark.createDataFrame(data(), "g string, v bigint").repartition(5)
    if not limit:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        result = exact_percentiles(df, ["g"], "v", FRACTIONS)
        ours = as_map(result)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    theirs = as_map(builtin(df))
    assert ours.keys() == theirs.keys() and "empty" not in ours
    for group, row in theirs.items():
        for name, value in row.items():
            if isinstance(value, float):
                assert ours[group][name] == pytest.approx(value, rel=1e-12), (group, name)
            else:
                assert ours[group][name] == value


def test_cells_spread_over_overlapping_groups(spark):
    """Cells (g, h) feed the groups g, h and everything; some keys are NULL."""
    rnd = random.Random(3)
    rows = [
        (rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), rnd.randint(0, 5000))
        for _ in range(3000)
    ]
    df = spark.createDataFrame(rows, "g string, h int, v bigint").repartition(4)

    def spread(counts):
        text = F.lit(None).cast("string")
        kinds = F.array(
            F.struct(F.lit("all").alias("kind"), text.alias("name")),
            F.struct(F.lit("g").alias("kind"), F.col("g").alias("name")),
            F.struct(F.lit("h").alias("kind"), F.col("h").cast("string").alias("name")),
        )
        return counts.withColumn("k", F.explode(kinds)).select("*", "k.*")

    ours = exact_percentiles(
        df, ["g", "h"], "v", {"p50": 0.5, "p95": 0.95}, spread, ["kind", "name"]
    )
    theirs = (
        spread(df)
        .groupBy("kind", "name")
        .agg(
            F.count("*").alias("value_count"),
            F.avg("v").alias("value_mean"),
            F.percentile("v", F.lit(0.5)).alias("p50"),
            F.percentile("v", F.lit(0.95)).alias("p95"),
        )
    )
    assert ours.columns == theirs.columns

    def cells(frame):
        return sorted(
            [
                tuple(round(c, 6) if isinstance(c, float) else c for c in r)
                for r in frame.collect()
            ],
            key=str,
        )

    assert cells(ours) == cells(theirs)


def test_buckets_keep_the_order_and_are_few(spark):
    edges = [2**e + d for e in range(1, 62) for d in (-1, 0, 1)]
    values = sorted({*edges, *[-v for v in edges], 0, -1, 2**63 - 1, -(2**63)})
    df = spark.createDataFrame([(v,) for v in values], "value bigint")
    rows = percentiles.with_bucket(df).orderBy("value").collect()
    buckets = [r.bucket for r in rows]
    assert buckets == sorted(buckets)
    assert all(r.bucket <= r.value for r in rows)
    exact = 2**percentiles.BUCKET_DIGITS
    assert all(r.bucket == r.value for r in rows if -exact <= r.value < exact)
    ends = spark.range(2**19, 2**20).select(F.col("id").alias("value"))
    octave = percentiles.with_bucket(ends).select("bucket").distinct().count()
    assert octave == 2 ** (percentiles.BUCKET_DIGITS - 1)


def test_parts_keep_the_order_and_are_half_the_digits(spark):
    """Around 2^50 buckets have 2^44 values: 2^22 parts of 2^22 values."""
    edges = [2**e + d * 2**k for e in range(7, 62) for k in range(0, e, 5) for d in (-1, 0, 1)]
    values = sorted({*edges, *[-v for v in edges], 0, -1, 2**63 - 1, -(2**63)})
    df = spark.createDataFrame([(v,) for v in values], "value bigint")
    rows = percentiles.with_part(percentiles.with_bucket(df)).orderBy("value").collect()
    parts = [r.part for r in rows]
    assert parts == sorted(parts) and all(r.bucket <= r.part <= r.value for r in rows)
    assert all(r.value - r.part < 2**29 for r in rows)
    near = [r for r in rows if 2**49 <= r.value < 2**51]
    assert all(r.value - r.part < 2**22 and (r.part - r.bucket) % 2**21 == 0 for r in near)
    assert all(r.part == r.bucket for r in rows if abs(r.value) < 2**19)


def test_a_wide_bucket_passes_on_only_the_parts_that_hold_a_wanted_rank(spark):
    df = spark.range(50_000).select(F.lit("g").alias("g"), (F.lit(2**50) + F.col("id") * 2**23).alias("value"))
    kept = percentiles.with_bucket(df).withColumns(
        {"rows": F.lit(1).cast("bigint"), "rows_before": F.lit(0).cast("bigint"),
         "value_count": F.lit(50_000).cast("bigint"), "value_mean": F.lit(0.0)}
    )
    left = percentiles._narrowed(kept, ["g"], {"p50": 0.5}).collect()
    assert kept.select("bucket").distinct().count() == 1
    assert sorted(r.value for r in left) == [2**50 + 24_999 * 2**23, 2**50 + 25_000 * 2**23]
    assert sorted(r.rows_before for r in left) == [24_999, 25_000]


def jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_nothing_runs_while_the_plan_is_built_and_one_exchange_serves_both_passes(spark):
    df = spark.createDataFrame(data(), "g string, v bigint").repartition(3)
    before = jobs(spark)
    result = exact_percentiles(df, ["g"], "v", {"p95": 0.95})
    assert jobs(spark) == before
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "Window" in final


def test_wide_values_of_one_hot_group(spark):
    """Distinct values near 2^50, almost all of one key."""
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("g"),
        (F.lit(2**50) + F.col("id") * 7_654_321 % 1_000_003 * 977).alias("v"),
    )
    ours, theirs = as_map(exact_percentiles(rows, ["g"], "v", FRACTIONS)), as_map(builtin(rows))
    for group, row in theirs.items():
        assert all(ours[group][n] == pytest.approx(row[n], rel=1e-12) for n in FRACTIONS)


def test_approximate_is_near(spark):
    df = spark.createDataFrame(data(), "g string, v bigint").filter("g = 'd'")
    exact = as_map(exact_percentiles(df, ["g"], "v", {"p95": 0.95}))["d"]
    near = as_map(approximate_percentiles(df, ["g"], "v", {"p95": 0.95}))["d"]
    assert near["value_count"] == exact["value_count"]
    assert near["p95"] == pytest.approx(exact["p95"], rel=0.01)
