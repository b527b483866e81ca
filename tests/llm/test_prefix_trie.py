"""The prefix trie against a trie of tuples."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigilog.llm.prefix_trie import NodeTable, in_order, prefix_trie


def brute(rows):
    by_conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by_conv[c].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    said = {c: [(r.decode(), t.decode()) for _, r, t in sorted(v)] for c, v in by_conv.items()}
    paths = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = (*said.get(c - c % 100, [])[:h], *said[c][h:])
    members, children, leaves, saved = defaultdict(list), defaultdict(set), Counter(), Counter()
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    for path, own in members.items():
        weight = (len(own) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += weight
            leaves[path[:d]] += path not in children
    return ordered(
        (
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(children.get(path, ())),
            leaves[path], saved[path],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if paths[c] == path).encode()).hexdigest(),
        )
        for path, own in members.items()
    )


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[0]))


@pytest.mark.parametrize("options", [{}, {"band": 2, "shard_rows": 40}])
def test_nodes_are_those_of_a_trie(spark, options):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert ordered(prefix_trie(turns, **options).collect()) == brute(rows)


LONG = [(700, n, "user", f"t{n}") for n in range(150)] + [(701, n, "user", f"t{n}") for n in range(120)]
ODD = [
    (100, 0, "user", "a"), (100, 1, "assistant", "b"), (101, 0, "user", "x"), (102, None, "user", "n"),
    (102, 0, "user", "a"), (103, 0, None, None), (104, 0, "", ""), (105, 0, "us", "era"), (105, 0, "user", "a"),
    (106, 0, "user", "a"), (106, 0, "user", "a"), (250, 0, "user", "no base"), (251, 3, "user", "b"),
    (251, 1, "user", "é😀"), (None, 0, "user", "a"), (None, None, None, None), (-5, 0, "user", "m"),
    (-100, 0, "user", "a"), (107, 0, "user", "z" * 200_000), *[(n, 0, "user", "only") for n in range(300, 420)],
]
DDL = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("options", [{}, {"band": 7, "shard_rows": 100}])
def test_odd_rows_and_long_conversations(spark, options):
    df = spark.createDataFrame([*ODD, *LONG], DDL)
    df = df.withColumns({c: F.lit("clash") for c in ("node", "depth", "hash", "part", "band", "chars")})
    assert ordered(prefix_trie(df.repartition(7), **options).collect()) == brute([*ODD, *LONG])
    assert prefix_trie(df.limit(0), **options).collect() == []


def test_a_long_conversation_is_spread_over_tasks(spark):
    parts = in_order(spark.createDataFrame([(1, n, "u", "t") for n in range(4000)], DDL))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = in_order(spark.createDataFrame([(1, n, "u", "t") for n in range(4000)], DDL))
        sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 4000


def table(**changes):
    columns = {"a": [1, 2, 2], "b": [9, 9, 9], "pa": [0, 1, 1], "pb": [0, 9, 9], "ha": [5, 6, 6], "hb": [5, 6, 6],
               "depth": [0, 1, 1], "chars": [0, 3, 3]}
    return NodeTable({c: np.array(x, np.int64) for c, x in (columns | changes).items()})


def test_slots_are_checked():
    made = table()
    assert made.size == 2 and made.accumulate(made.scatter(np.array([0, 2, 3]))).tolist() == [5, 5]
    with pytest.raises(ValueError, match="two different"):
        table(ha=[5, 6, 7])
    with pytest.raises(ValueError, match="two different"):
        table(pa=[0, 1, 3])
    # Digests whose halves meet in one 64-bit key get another salt.
    from vigilog.llm.perfect_hash import mix

    a = np.array([1, 2, 2], np.uint64)
    b = mix(a, 0) ^ np.uint64(77)
    met = table(a=a.view(np.int64), b=b.view(np.int64), pb=[0, int(b.view(np.int64)[0]), int(b.view(np.int64)[0])])
    assert met.size == 2 and sorted(met.parent.tolist()) == [-1, int(met.slot[0])]
