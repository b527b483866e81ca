"""Threshold-scaled sketches of documents: every shingle hash below a fixed fraction is kept.

A shingle is ``WIDTH`` consecutive code points of the whole text (a shorter text is one shingle).
Its 64-bit hash is kept if it lies in the lowest 1/``SCALE`` of the range. What is kept depends on
the shingle alone, so sketches of parts merge by union, and containment of a short document in a
very long one is estimated as well as between equals; a sketch of fixed size could not do that.
A text of which nothing is kept has its smallest hash instead, so only the empty text has an
empty sketch; such a hash lies above the threshold, and merging drops it where others are kept.

A fingerprint is the sketch as text: base64 of sorted little-endian unsigned 64-bit hashes cut to
``BITS`` bits below the threshold. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import hash128, map_texts, text_of
from vigilog.llm.perfect_hash import mix

WIDTH = 12
SCALE = 8
#: A kept hash is below 2**32 after this shift; one above is a lone smallest hash.
SHIFT = np.uint64(64 - 32 - 3)
KEPT = np.uint64(1) << np.uint64(32)
WIDE = np.dtype("<u8")
NARROW = np.dtype("<u4")
#: Odd constant of the rolling hash over code points.
BASE = np.uint64(0x9E3779B97F4A7C15)
BLOCK_ROWS = 2000
LEAST_BLOCKS = 64
#: Bounds the cuts between blocks, which reach the driver and every task: eight bytes each.
MOST_BLOCKS = 100_000


def window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every window of ``width`` code points, or of all of them if there are fewer.

    Windows of a power of two are doubled; other widths are joined from two that overlap.
    """
    if not len(codes):
        return np.zeros(0, np.uint64)
    width = min(width, len(codes))
    out, have = mix(codes, 0), 1
    while have < width:
        step = min(have, width - have)
        out = mix(out[:-step] * BASE ^ out[step:], have)
        have += step
    return out


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def sketch(text: str) -> np.ndarray:
    """Sorted distinct kept hashes, cut to 32 bits below the threshold."""
    hashes = window_hashes(codes_of(text), WIDTH) >> SHIFT
    kept = hashes[hashes < KEPT]
    if not len(kept) and len(hashes):
        kept = hashes.min()[None]
    return np.unique(kept)


def to_text(found: np.ndarray) -> str:
    """A lone hash above the threshold takes 8 bytes, all others 4 bytes each."""
    lone = len(found) == 1 and bool(found[0] >= KEPT)
    return base64.b64encode(found.astype(WIDE if lone else NARROW).tobytes()).decode() + "~" * lone


def from_text(fingerprint: str) -> np.ndarray:
    lone = fingerprint.endswith("~")
    data = base64.b64decode(fingerprint.removesuffix("~"))
    return np.frombuffer(data, WIDE if lone else NARROW).astype(np.uint64)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Hashes that two sketches share."""
    if not len(a) or not len(b):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int(np.count_nonzero(b[at] == a))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity; two empty sketches are alike, one is unlike any other."""
    both = shared(a, b)
    return both / (len(a) + len(b) - both) if len(a) or len(b) else 1.0


def part_in(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has; 1 for an empty ``a``."""
    return shared(a, b) / len(a) if len(a) else 1.0


def union(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketch of the texts together: what is below the threshold, else the smallest hash."""
    every = np.unique(np.concatenate([np.zeros(0, np.uint64), *sketches]))
    kept = every[every < KEPT]
    return kept if len(kept) else every[:1]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with the column fingerprint instead of text; null texts count as empty."""

    def make():
        return lambda texts: {"fingerprint": [to_text(sketch(t)) for t in texts]}

    return map_texts(docs.drop("fingerprint"), make, "fingerprint string")


def _pairwise(f, a: Column, b: Column) -> Column:
    @F.pandas_udf("double")
    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [f(from_text(x or ""), from_text(y or "")) for x, y in zip(left, right, strict=True)],
            dtype="float64",
        )

    return compare(a, b)


def containment(a: Column, b: Column) -> Column:
    """Share of the shingles behind fingerprint ``a`` that are behind ``b``; null is empty."""
    return _pairwise(part_in, a, b)


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity estimated from two fingerprints; null is empty."""
    return _pairwise(likeness, a, b)


def merge(printed: DataFrame, by: list[str]) -> DataFrame:
    """One fingerprint for each group of rows (by, fingerprint).

    Rows are merged within each task first and then in one stream per group: a group is never
    gathered, only its union is held (a share 1/SCALE of its distinct shingles).
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in printed.select(*by).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            rows = batch.to_pydict()
            for *key, printed_ in zip(*[rows[c] for c in by], rows["fingerprint"], strict=True):
                new = from_text(printed_ or "")
                old = held.pop(tuple(key), None)
                held[tuple(key)] = new if old is None else union([old, new])
                if len(held) > 1000:
                    first = next(iter(held))
                    yield out(batch, {first: held.pop(first)})
            last = batch
        if held:
            yield out(last, held)

    def out(like: pa.RecordBatch, held: dict) -> pa.RecordBatch:
        columns = [pa.array([k[n] for k in held], like.schema.field(c).type) for n, c in enumerate(by)]
        columns.append(pa.array([to_text(x) for x in held.values()]))
        return pa.RecordBatch.from_arrays(columns, [*by, "fingerprint"])

    schema = f"{fields}, fingerprint string"
    own = printed.select(*by, "fingerprint").mapInArrow(run, schema)
    return own.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def with_next(docs: DataFrame) -> DataFrame:
    """(block, own, doc_id, text): sorted runs of documents, each followed by its next one.

    Rows are dealt by ranges of doc_id into blocks. The first document of a block is lent to the
    block before (the first of all to the last block), where it is not ``own``. Ranges follow
    quantiles of doc_id, so blocks are about equal: of ``BLOCK_ROWS`` rows, of more only where
    ``MOST_BLOCKS`` are not enough. Neighbouring blocks share a task, the same number in each.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    low = F.lit(-(2**63))
    order = F.coalesce(F.col("doc_id").cast("bigint"), low)
    total = rows.count()
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, total // BLOCK_ROWS))
    shares = [n / blocks for n in range(1, blocks)]
    found = rows.agg(
        F.min(order).alias("first"), F.percentile_approx(order, shares, max(10_000, 10 * blocks)).alias("cuts")
    ).first()
    cuts = np.unique(np.array(found["cuts"] or [], np.int64))
    first = found["first"]
    cuts = cuts[cuts > first] if first is not None else cuts

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right").astype(np.int32))

    @F.pandas_udf("boolean")
    def starts_block(ids: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(cuts, ids.to_numpy()), max(len(cuts) - 1, 0))
        return pd.Series(cuts[at] == ids.to_numpy() if len(cuts) else np.zeros(len(ids), bool))

    last = len(cuts)
    tasks = -(-(last + 1) // 4)
    placed = rows.withColumn("id", order).withColumn("block", block_of("id"))
    own = F.struct("block", F.lit(True).alias("own"), F.lit(0).alias("turn"))
    lent = F.struct((F.col("block") - 1).alias("block"), F.lit(False).alias("own"), F.lit(0).alias("turn"))
    round_ = F.struct(F.lit(last).alias("block"), F.lit(False).alias("own"), F.lit(1).alias("turn"))
    copies = F.array_compact(F.array(own, F.when(starts_block("id"), lent), F.when(F.col("id") == F.lit(first), round_)))
    return (
        placed.withColumn("copy", F.explode(copies))
        .select("copy.*", "id", "doc_id", "text", hash128(F.col("text")).alias("tie"))
        .repartitionById(tasks, F.shiftright("block", 2))
        .sortWithinPartitions("block", "turn", "id", F.desc("own"), "tie")
        .select("block", "own", "doc_id", "text")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how near those are.

    In the edited text the last quarter (rounded down) of the code points is replaced by as many
    from the start of the next document in ascending doc_id; after the last comes the first.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, next_contained (share of the next document's shingles found in this one).

    Texts of any length are fingerprinted whole; a task holds two of them and their sketches.
    Null texts are empty. Null doc_ids come first; rows with equal doc_ids follow each other in
    the order of their texts' hashes, and repeated rows stay. A lone document is its own next. An
    empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # (block, doc_id, text, sketch) whose next document is still to come
        for batch in batches:
            out: dict[str, list] = {c: [] for c in names}
            rows = zip(*(batch.column(c).to_pylist() for c in ("block", "own", "doc_id", "text")), strict=True)
            for block, own, doc_id, text in rows:
                if waiting is None and not own:
                    continue
                found = sketch(text)
                if waiting is not None and waiting[0] == block:
                    _, of, before, mine = waiting
                    cut = len(before) // 4
                    changed = before[: len(before) - cut] + text[:cut]
                    theirs = sketch(changed) if cut else mine
                    values = (
                        of, len(before), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        to_text(mine), to_text(theirs), likeness(mine, theirs), likeness(mine, found),
                        part_in(found, mine),
                    )
                    for column, value in zip(out.values(), values, strict=True):
                        column.append(value)
                waiting = (block, doc_id, text, found) if own else None
            arrays = [pa.array(out["doc_id"], batch.schema.field("doc_id").type)]
            arrays += [pa.array(out[c], t) for c, t in list(names.items())[1:]]
            yield pa.RecordBatch.from_arrays(arrays, list(names))

    names = {"doc_id": None, "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
             "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
             "next_contained": pa.float64()}
    return with_next(docs).mapInArrow(
        run,
        f"doc_id {key}, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, next_contained double",
    )
