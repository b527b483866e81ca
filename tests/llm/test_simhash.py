"""SimHash groups against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vigilog.llm import simhash
from vigilog.llm.components import components
from vigilog.llm.simhash import near_links, simhash_groups

UP = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UP))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(prints, labels):
    """Smallest label that chains of at most two differing bits reach."""
    prints, own = np.array(prints, np.uint64), np.array(labels)
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= 2) for p in prints]
    while True:
        new = np.array([own[n].min() for n in near])
        if (new == own).all():
            return own.tolist()
        own = new


@pytest.mark.parametrize("most", [simhash.BUCKET, 2])
def test_groups_are_those_of_all_pairs(spark, most):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [fingerprint(r.text) for r in rows]
    expected = sorted(zip((r.doc_id for r in rows), (f"{p:016x}" for p in prints), smallest(prints, [r.doc_id for r in rows]), strict=True))
    assert sorted(tuple(r) for r in simhash_groups(docs, most=most).collect()) == expected


@pytest.mark.parametrize("most", [simhash.BUCKET, 3, 1])
def test_no_link_is_lost_whatever_bits_differ(spark, most):
    rnd = random.Random(5)
    prints = set()
    for _ in range(30):
        center = rnd.getrandbits(64)
        prints.add(center)
        for _ in range(12):
            center ^= 1 << rnd.randrange(64)
            center ^= rnd.choice([0, 1 << rnd.randrange(64)])
            prints.add(center)
    # Very many in one bucket: equal first segments.
    prints |= {(7 << 32) | rnd.getrandbits(9) for _ in range(300)}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    fps = spark.createDataFrame(signed, "fp bigint")
    found = {r.node % 2**64: r.component % 2**64 for r in components(near_links(fps, most)).collect()}
    groups = {}
    for p, label in zip(prints, smallest(prints, list(range(len(prints)))), strict=True):
        groups.setdefault(label, set()).add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len({next(iter(g)) for g in groups.values()})


def test_odd_rows(spark):
    long = "One two three four. " * 20_000
    rows = [
        (9, None), (3, ""), (4, " \t\n\x0b"), (5, "One"), (6, "one"), (7, "One two three\x0bfour"), (7, "one TWO three four"),
        (None, "one two\tthree four"), (None, "alone"), (8, long), (2, long.lower()), (10, "a\xa0b a\xa0b"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("fp", "key", "least", "root", "fingerprint")})
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash_groups(df).collect()}
    prints = [fingerprint(t) for _, t in rows]
    labels = smallest(prints, [99 if d is None else d for d, _ in rows])
    assert found == {(d, f"{p:016x}", None if c == 99 else c) for (d, _), p, c in zip(rows, prints, labels, strict=True)}
    assert (3, "0" * 16, 3) in found and (9, "0" * 16, 3) in found and (8, f"{fingerprint(long):016x}", 2) in found
    assert simhash_groups(df).count() == len(rows)
    assert simhash_groups(df.limit(0)).collect() == []
