"""Corpus-wide line dedup through a sharded minimal perfect hash.

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z
lower-cased. Lines whose key is found in at least ``min_docs`` documents are dropped from every
document; keys shorter than ``min_chars`` code points never are.

1. Distinct line hashes (128 bits) of each distinct text are counted over documents: partial
   counts before the shuffle, so a line that all documents share is one row per task.
2. The distinct hashes are dealt over shards of about ``SHARD_KEYS`` keys. Each shard becomes a
   minimal perfect hash with two flat arrays beside it: 32-bit fingerprints and counts (capped
   at 2**32 - 1, far beyond any threshold). About nine bytes a line, written to the shared folder.
3. Documents probe the arrays: their line hashes go to the shard, whose arrays a task reads once
   and then answers for a stream of hashes. A shard that many documents ask (a hot line) is
   copied to several tasks, in proportion to the hashes that come to it. No line is joined with
   its count, and no group is gathered: both build and probe stream over sorted partitions, and
   the largest thing in memory is one shard.
4. What was found goes back to the texts by their hash, and each text is filtered in one pass;
   only hashes of lines go to Python there.

Texts are never joined or grouped by line. The full text is shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from vigilog.llm.common import WHITE, hash128, lower_ascii, text_of
from vigilog.llm.perfect_hash import PerfectHash, mix
from vigilog.session import materialize

SHARD_KEYS = 1 << 18
#: Hashes that one task answers for; a shard that is asked more is copied to more tasks.
TASK_ASKS = 1 << 20
LEAST_SHARDS = 32


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def key_of(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def line_hashes(text: Column, min_chars: int) -> Column:
    """Distinct hashes of a text's line keys that are long enough."""
    keys = F.filter(F.transform(lines_of(text), key_of), lambda k: F.length(k) >= min_chars)
    return F.transform(F.array_distinct(keys), lambda k: hash128(k))


def _shard(shards: int) -> Column:
    return F.pmod(F.col("line.b"), F.lit(shards)).cast("int")


def _fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def _as_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both halves in one 64-bit key of the perfect hash (b also chose the shard)."""
    return mix(a.view(np.uint64), 7) ^ b.view(np.uint64)


def build_shards(counted: DataFrame, shards: int) -> DataFrame:
    """(shard, hash, fingerprints, counts) from distinct (line, n)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        current = None

        def finish() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _ in held])
            counts = np.concatenate([n for _, n in held])
            keys, first = np.unique(keys, return_index=True)
            found = PerfectHash.build(keys)
            at = found.index(keys)
            prints, array = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.uint32)
            prints[at] = _fingerprint(keys)
            array[at] = np.minimum(counts[first], 2**32 - 1)
            row = ([current], [found.to_bytes()], [prints.tobytes()], [array.tobytes()])
            types = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, types, strict=True)],
                ["shard", "hash", "prints", "counts"],
            )

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            keys = _as_key(batch.column("a").to_numpy(), batch.column("b").to_numpy())
            counts = batch.column("n").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if e == s:
                    continue
                if shard[s] != current and held:
                    yield finish()
                    held.clear()
                current = int(shard[s])
                held.append((keys[s:e], counts[s:e]))
        if held:
            yield finish()

    flat = counted.select(_shard(shards).alias("shard"), "line.a", "line.b", "n")
    return (
        flat.repartition(shards, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(build, "shard int, hash binary, prints binary, counts binary")
    )


def probe_shards(asks: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """(text, line) of those ``asks`` (text, line, n of their shard) that reach ``min_docs``."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = found = prints = counts = None
        for batch in batches:
            if not batch.num_rows:
                continue
            of = batch.column("shard").to_numpy()
            is_index = ~np.asarray(batch.column("hash").is_null())
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(of) != 0) | is_index[1:] | is_index[:-1]]))
            a = batch.column("a").fill_null(0).to_numpy()
            b = batch.column("b").fill_null(0).to_numpy()
            hit = np.zeros(batch.num_rows, bool)
            for s, e in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                if is_index[s]:
                    shard = int(of[s])
                    found = PerfectHash.from_bytes(batch.column("hash")[int(s)].as_py())
                    prints = np.frombuffer(batch.column("prints")[int(s)].as_py(), np.uint32)
                    counts = np.frombuffer(batch.column("counts")[int(s)].as_py(), np.uint32)
                elif shard == of[s]:
                    keys = _as_key(a[s:e], b[s:e])
                    at = found.index(keys)
                    known = (at >= 0) & (prints[at] == _fingerprint(keys))
                    hit[s:e] = known & (counts[at] >= min_docs)
            yield batch.select(["text", "a", "b"]).filter(pa.array(hit))

    heat = asks.groupBy(_shard(shards).alias("shard")).count()
    copies = heat.select(
        "shard", F.ceil(F.col("count") / TASK_ASKS).cast("int").alias("copies")
    )
    questions = (
        asks.withColumn("shard", _shard(shards))
        .join(copies, "shard")
        .select(
            "shard",
            F.pmod("text.a", F.col("copies")).cast("int").alias("copy"),
            F.lit(1).alias("turn"), "text", "line.a", "line.b",
            *[F.lit(None).cast("binary").alias(c) for c in ("hash", "prints", "counts")],
        )
    )
    arrays = index.join(copies, "shard").select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        F.lit(0).alias("turn"),
        F.lit(None).cast("struct<a:bigint,b:bigint>").alias("text"),
        *[F.lit(None).cast("bigint").alias(c) for c in "ab"],
        "hash", "prints", "counts",
    )
    return (
        arrays.unionByName(questions)
        .repartition(shards, "shard", "copy")
        .sortWithinPartitions("shard", "copy", "turn")
        .mapInArrow(answer, "text struct<a:bigint,b:bigint>, a bigint, b bigint")
        .select("text", F.struct("a", "b").alias("line"))
    )


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(text, lines): for each distinct text's hash, the hashes of its lines to drop."""
    texts = docs.select(hash128(text_of()).alias("text"), line_hashes(text_of(), min_chars).alias("lines"))
    texts = materialize(
        texts.groupBy("text").agg(F.count("*").alias("n"), F.first("lines").alias("lines")),
        "texts",
    )
    asks = texts.select("text", "n", F.explode("lines").alias("line"))
    counted = materialize(asks.groupBy("line").agg(F.sum("n").alias("n")), "lines")
    shards = max(LEAST_SHARDS, -(-counted.count() // SHARD_KEYS))
    index = materialize(build_shards(counted, shards), "line-index")
    hits = probe_shards(asks.select("text", "line"), index, shards, min_docs)
    return hits.groupBy("text").agg(F.collect_set("line").alias("lines"))


@F.pandas_udf(ArrayType(BooleanType()))
def among(a: pd.Series, b: pd.Series, of_a: pd.Series, of_b: pd.Series) -> pd.Series:
    """Whether each hash (halves a, b) is one of the others: linear, where ``array_contains`` is their product."""

    def flags(a: np.ndarray | None, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> list[bool] | None:
        if a is None:
            return None
        gone = set(zip(of_a.tolist(), of_b.tolist(), strict=True))
        return [x in gone for x in zip(a.tolist(), b.tolist(), strict=True)]

    return pd.Series([flags(*x) for x in zip(a, b, of_a, of_b, strict=True)], dtype=object)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Drop lines found in ``min_docs`` documents or more; add n_lines and n_dropped.

    The other columns pass through; ``text`` becomes the kept lines joined by newlines.

    A null or empty text is one empty line and becomes the empty text. Every row is a document:
    repeated rows count as often as they occur and are all kept. A key counts once a document,
    however often the document has it, and all of its lines go. Empty tables give empty tables.
    Columns named n_lines or n_dropped are replaced.
    """
    # A table of its own lets the join below split a text that very many documents share.
    drop = materialize(frequent_lines(docs, min_docs, min_chars), "line-hits").select(
        F.col("text").alias("__text"), F.col("lines").alias("__drop")
    )
    joined = docs.withColumn("__text", hash128(text_of())).join(drop, "__text", "left")
    lines = lines_of(text_of())
    hashes = F.when(F.col("__drop").isNotNull(), F.transform(lines, lambda x: hash128(key_of(x))))
    joined = joined.withColumn(
        "__gone", among(*[c.getField(half) for c in (hashes, F.col("__drop")) for half in "ab"])
    )
    kept = F.when(F.col("__drop").isNull(), lines).otherwise(
        F.filter(lines, lambda x, n: ~F.get("__gone", n))
    )
    joined = joined.withColumn("__kept", kept).withColumns(
        {"n_lines": F.size(lines).cast("long"), "n_dropped": (F.size(lines) - F.size("__kept")).cast("long")}
    )
    return joined.withColumn("text", F.concat_ws("\n", "__kept")).drop("__text", "__drop", "__gone", "__kept")
