"""Best-fit packing of tokenised documents into sequences of a fixed length.

A document is its token ids and an end id. Only documents longer than a sequence are cut: into
pieces of full length, of which the first may be shorter.

The packing is planned on the number of pieces of each length, at most ``capacity`` numbers
whatever the size of the corpus, and then carried out by rank:

1. Tokenise; one narrow row a piece is written to the shared folder.
2. Count pieces by length; these counts alone reach the driver.
3. Plan. Large pieces (above a third of the capacity) can share a sequence with one other large
   piece only: from the largest down, each is matched with the largest that still fits beside it.
   Smaller pieces, from the largest down, go where they fit best: into the smallest gap that
   holds them; new sequences open only where no gap does. Equal lengths are planned together, so
   a plan is a list of kinds of sequences with their numbers.
4. Each piece gets its rank among those of its length: numbered within shards of a length, plus
   the counts of the shards before. The plan gives for a rank the sequence and the offset.

Pieces of the same length are interchangeable, so a length that holds a third of all rows is
spread over all shards, and no sequence is ever gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.common import slices
from vigilog.session import materialize

CAPACITY = 2048
END_ID = 0
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the added tokens of this vocabulary's tokenizer (byte_bpe_50k.json). They are
#: matched in texts before anything else, as the tokenizers library does.
ADDED_TOKENS = {"<|endoftext|>": 50256}
#: Fixed value: the published pattern that splits text before the merges of this vocabulary, with
#: possessive repeats; it cuts every text like the pattern without them.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
SHARD_ROWS = 1 << 19
LEAST_SHARDS = 16


def load_tokenizer(name: str = VOCABULARY):
    """The public vocabulary ``name`` on this machine with its added tokens."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=ADDED_TOKENS)


def encoder(name: str = VOCABULARY) -> Callable[[str], list[int]]:
    """From a text to its ids; texts are split at added tokens, which have ids of their own."""
    return partial(load_tokenizer(name).encode, allowed_special="all")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    starts = ([0] if first else []) + list(range(first, n, capacity))
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def tokenize(
    docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False, vocabulary: str = VOCABULARY
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for s, e in slices([x or "" for x in texts]):
                of, piece, start, length, crc, kept = [], [], [], [], [], []
                for n in range(s, e):
                    ids = np.array([*encode(texts[n] or ""), END_ID], "<u4")
                    for k, (at, size) in enumerate(cut(len(ids), capacity)):
                        part = ids[at : at + size]
                        of.append(n)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(part.tobytes()))
                        if with_ids:
                            kept.append(part)
                columns = [batch.column("doc_id").take(pa.array(of, pa.int64()))]
                columns += [pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                if with_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int64())))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    key = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<bigint>" * with_ids)


@dataclass
class Kind:
    """``n`` sequences alike: for each length in them (length, how many, first offset)."""

    n: int
    slots: list[tuple[int, int, int]]
    gap: int


def match_large(left: np.ndarray, capacity: int) -> list[Kind]:
    """Kinds of one or two pieces above a third of the capacity; empties ``left`` of them."""
    kinds, least = [], capacity // 3 + 1
    for a in range(capacity, least - 1, -1):
        beside = min(a, capacity - a)
        while left[a]:
            while beside >= least and (not left[beside] or (beside == a and left[a] < 2)):
                beside -= 1
            if beside < least:
                kinds.append(Kind(int(left[a]), [(a, 1, 0)], capacity - a))
                left[a] = 0
            elif beside == a:
                kinds.append(Kind(int(left[a] // 2), [(a, 2, 0)], capacity - 2 * a))
                left[a] %= 2
            else:
                n = int(min(left[a], left[beside]))
                kinds.append(Kind(n, [(a, 1, 0), (beside, 1, a)], capacity - a - beside))
                left[a] -= n
                left[beside] -= n
    return kinds


def fill_gaps(kinds: list[Kind], left: np.ndarray, capacity: int) -> list[Kind]:
    """Put all remaining pieces, largest first, into the smallest gaps that hold them."""
    by_gap: list[list[Kind]] = [[] for _ in range(capacity + 1)]
    for kind in kinds:
        by_gap[kind.gap].append(kind)

    def put(kind: Kind, size: int, each: int, n: int) -> None:
        slot = (size, each, capacity - kind.gap)
        gap = kind.gap - size * each
        by_gap[gap].append(Kind(n, [*kind.slots, slot], gap))
        kind.n -= n

    for size in range(capacity // 3, 0, -1):
        todo, gap = int(left[size]), size
        while todo:
            while gap < capacity and not by_gap[gap]:
                gap += 1
            if by_gap[gap]:
                kind = by_gap[gap].pop()
            else:
                kind, gap = Kind(-(-todo // (capacity // size)), [], capacity), capacity
            each = gap // size
            whole = min(kind.n, todo // each)
            if whole:
                put(kind, size, each, whole)
                todo -= whole * each
            if kind.n and todo:  # fewer than ``each`` are left
                put(kind, size, todo, 1)
                todo = 0
            if kind.n:
                by_gap[gap].append(kind)
        left[size] = 0
    return [k for kinds in by_gap for k in kinds]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Runs of ranks sorted by (length, rank): first, base, each, offset.

    The pieces of a length with ranks from ``first`` on go to the sequences from ``base`` on,
    ``each`` of them to a sequence, from ``offset`` on. Its size depends on the capacity alone.
    """
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    kinds = fill_gaps(match_large(left, capacity), left, capacity)
    used, base = np.zeros(capacity + 1, np.int64), 0
    rows = []
    for kind in kinds:
        for size, each, offset in kind.slots:
            rows.append((size, used[size], base, each, offset))
            used[size] += each * kind.n
        base += kind.n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    names = ("length", "first", "base", "each", "offset")
    return {n: table[:, k] for k, n in enumerate(names)}


def place(runs: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray):
    """(sequence, offset) of pieces from their length and their rank in it."""
    at = np.zeros(len(length), np.int64)
    for size in np.unique(length):
        of = np.flatnonzero(length == size)
        s, e = np.searchsorted(runs["length"], [size, size + 1])
        at[of] = s + np.searchsorted(runs["first"][s:e], rank[of], "right") - 1
    n = rank - runs["first"][at]
    each = runs["each"][at]
    return runs["base"][at] + n // each, runs["offset"][at] + n % each * length


def pack(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are not read): a row for each piece.

    Columns: doc_id, piece, start, length, ids_crc32 (little-endian unsigned 32-bit ids),
    sequence_id, offset; ids too if ``with_ids``.

    A null or empty text is a document of the end id alone. A text of any length is tokenised whole
    and cut into pieces. Repeated rows and null or repeated doc_ids are documents of their own;
    pieces of equal length may change places. An empty table gives an empty result.
    """
    pieces = materialize(tokenize(docs, capacity, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs = plan(counts, capacity)
    shards = max(LEAST_SHARDS, -(-sum(counts.values()) // SHARD_ROWS))
    spread = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int"))
    sizes = spread.groupBy("length", "shard").count()
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("shard", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        spread.withColumn("rank", F.row_number().over(own) - 1)
        .join(offsets, ["shard", "length"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .drop("shard", "before")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = place(runs, batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            rest = batch.drop_columns(["rank"])
            for name, values in zip(("sequence_id", "offset"), found, strict=True):
                rest = rest.append_column(name, pa.array(values, pa.int64()))
            yield rest

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema]
    columns = ["rank", *pieces.columns]
    return ranked.select(*columns).mapInArrow(
        run, ", ".join([*fields, "sequence_id bigint, offset bigint"])
    )
