r"""SimHash near-duplicate grouping by deletion-variant signatures.

A-Z are lower-cased and words are ``[^\x20\x09-\x0D]+``. A document's features are its shingles of
``words`` consecutive words joined by a space, repeats included (all words where there are fewer),
hashed by XXH64 with seed 42. A fingerprint bit is set where more than half of the hashes have it; a
document without words has the fingerprint zero. Fingerprints that differ in at most two bits are
linked, and documents are grouped by the connected components of these links.

1. Equal fingerprints become one node, so copies never meet.
2. A fingerprint is cut into two segments of 32 bits, so one of them differs by one bit at most
   between linked fingerprints. Each segment is indexed under its 32 variants with one bit
   deleted: two segments that differ in one bit are equal in the variant without it.
3. Variants are joined by equality, and pairs of a bucket verified by counting bits. A bucket
   only answers for pairs that differ in the deleted bit (or, where bit 0 is deleted, not at
   all in the segment), so most of them have nothing to do. It yields a forest of its links, never
   pairs.
4. Buckets above ``BUCKET`` fingerprints are found by counting first and indexed once more: of the
   other segment one of both halves also differs by one bit at most. Segment and half fix all but
   18 bits, so these buckets are bounded by themselves.
5. The buckets' forests are joined by distributed connected components.

Every link is found: no cap, no probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import UPPER, WHITE, map_texts, text_of
from vigilog.llm.components import components
from vigilog.session import materialize

SEED = 42  # a fixed value
#: Fingerprints that are compared within one bucket.
BUCKET = 1 << 14
#: Comparisons that a task holds at once.
BLOCK_PAIRS = 1 << 20

_LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
# bytes.split() without an argument splits at exactly the same white space.
assert sorted(WHITE.encode()) == sorted(b" \t\n\x0b\x0c\r")


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle of a text."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    width = min(words, len(parts))
    starts = [0, *ends[: len(parts) - width].tolist()]
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[s:e], SEED) for s, e in zip(starts, stops, strict=True)]
    return np.array(found, np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed 64-bit number."""
    most = np.zeros(64, np.int64)
    for s in range(0, len(hashes), 1 << 14):
        rows = hashes[s : s + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        most += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * most > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) for each row of ``docs`` (doc_id, text)."""

    def make() -> Callable[[list[str]], dict[str, object]]:
        def compute(texts: list[str]) -> dict[str, object]:
            encoded = (t.encode("utf-8", "surrogatepass") for t in texts)
            return {"fp": [simhash(shingle_hashes(t, words)) for t in encoded]}

        return compute

    return map_texts(docs.select("doc_id", text_of().alias("text")), make, "fp bigint")


def deletions(value: Column, place: int, size: int, name: int) -> list[Column]:
    """(name, deleted bit, rest) of a segment of ``size`` bits that starts at bit ``place``."""
    segment = F.shiftrightunsigned(value, place).bitwiseAND(F.lit((1 << size) - 1))
    return [
        F.struct(
            F.lit(name).alias("segment"),
            F.lit(bit).alias("bit"),
            segment.bitwiseAND(F.lit(~(1 << bit))).alias("rest"),
        )
        for bit in range(size)
    ]


def variants(fps: DataFrame) -> DataFrame:
    """(fp, key): each fingerprint under the deletion variants of its two segments."""
    keys = [*deletions(F.col("fp"), 0, 32, 0), *deletions(F.col("fp"), 32, 32, 1)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def halved(placed: DataFrame) -> DataFrame:
    """The rows of (fp, key) under the deletion variants of the other segment's halves."""

    def halves(start: int) -> Column:
        return F.array(*deletions(F.col("fp"), start, 16, 0), *deletions(F.col("fp"), start + 16, 16, 1))

    half = F.when(F.col("key.segment") == 0, halves(32)).otherwise(halves(0))
    return placed.select("fp", "key", F.explode(half).alias("half"))


def forest(fps: np.ndarray, place: int, only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges (place of a fingerprint, of its root) that join all linked ones of a bucket.

    Only pairs that differ in the bit at ``place`` count; with ``only`` false those that do not,
    too.
    """
    own = (fps >> np.uint64(place)) & np.uint64(1)
    if only and own.min() == own.max():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    root = np.arange(len(fps))

    def top(n: int) -> int:
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    if only:
        left, right = np.flatnonzero(own == 0), np.flatnonzero(own == 1)
    else:
        left = right = np.arange(len(fps))
    step = max(1, BLOCK_PAIRS // len(right))
    for s in range(0, len(left), step):
        block = left[s : s + step]
        a, b = np.nonzero(np.bitwise_count(fps[block][:, None] ^ fps[right][None, :]) <= 2)
        for x, y in zip(block[a].tolist(), right[b].tolist(), strict=True):
            x, y = top(x), top(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    found = np.array([top(n) for n in range(len(fps))])
    moved = np.flatnonzero(found != np.arange(len(fps)))
    return moved, found[moved]


def links(placed: DataFrame, key: list[str]) -> DataFrame:
    """(src, dst) forests of the buckets of (fp, key columns); a row's first key says which pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def finish() -> pa.RecordBatch:
            fps = np.unique(np.concatenate(held)).view(np.uint64)
            segment, bit = current[:2]
            moved, root = forest(fps, 32 * segment + bit, bit > 0)
            ends = [pa.array(fps[x].view(np.int64)) for x in (moved, root)]
            return pa.RecordBatch.from_arrays(ends, ["src", "dst"])

        names = [f"k{n}" for n in range(3 * len(key))]
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names])
            fps = batch.column("fp").to_numpy()
            cuts = np.flatnonzero((np.diff(values, axis=1) != 0).any(axis=0)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(fps)], strict=True):
                bucket = tuple(values[:, s].tolist())
                if bucket != current and held:
                    if sum(map(len, held)) > 1:
                        yield finish()
                    held = []
                current = bucket
                held.append(fps[s:e])
        if sum(map(len, held)) > 1:
            yield finish()

    flat = [F.col(f"{k}.{f}") for k in key for f in ("segment", "bit", "rest")]
    flat = [c.alias(f"k{n}") for n, c in enumerate(flat)]
    names = [f"k{n}" for n in range(len(flat))]
    return (
        placed.select("fp", *flat)
        .repartition(*names)
        .sortWithinPartitions(*names)
        .mapInArrow(run, "src bigint, dst bigint")
    )


def near_links(fps: DataFrame, most: int = BUCKET) -> DataFrame:
    """(src, dst) edges whose components are those of all links between distinct ``fps`` (fp)."""
    placed = variants(fps)
    crowded = placed.groupBy("key").count().filter(F.col("count") > most).select("key")
    crowded = materialize(crowded, "crowded")
    usual = links(placed.join(crowded, "key", "left_anti"), ["key"])
    if crowded.isEmpty():
        return usual
    return usual.unionByName(links(halved(placed.join(crowded, "key", "left_semi")), ["key", "half"]))


def simhash_groups(docs: DataFrame, words: int = 3, most: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, the row's own included.

    Null and empty texts, and those of white space only, have the fingerprint zero and are linked
    like any other. Repeated rows and copies have one fingerprint. A null doc_id is never the
    smallest unless a group has no other; then component_id is null. Texts of any length are
    read whole; their hashes are held one document at a time. An empty table gives an empty result. Other columns of
    ``docs`` are not read.
    """
    signed = materialize(fingerprints(docs, words), "fingerprints")
    fps = materialize(signed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(near_links(fps.select("fp"), most), "simhash")
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("component", "fp")).select("fp", "least", "root")
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return signed.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
