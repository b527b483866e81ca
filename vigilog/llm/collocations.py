r"""Phrase collocations by Rabin-Karp fingerprints.

A-Z are lower-cased; texts are split at ``[.,;:!?\x0A-\x0D]`` into pieces and these into words
``[^\x20\x09]+``. Phrases are counted per language within pieces.

1. Texts of a language become slices: words with one space between them, pieces with a newline.
   A slice is a row of a written table, so its number is good for a pointer. A text longer than
   a slice is cut between pieces, where no phrase can be lost.
2. Prefix polynomials over a slice's bytes give every n-gram's fingerprint by one subtraction and
   one multiplication, all in numpy. Slices send their distinct fingerprints with counts to shards
   of the fingerprint space, sorted; an entry's slice and rank are its occurrence pointer.
3. A shard adds up counts. To each slice it returns one bit an entry: whether the fingerprint is
   frequent in the corpus. An n-gram can only be frequent if both (n-1)-grams in it are, so the next
   length asks a filter of the frequent fingerprints first. The filter has at most ``FILTER_BITS``
   bits whatever the corpus; where it is full, more n-grams are counted and nothing is lost.
4. Pointers are followed back: slices materialise the phrases of the marked entries only.
   Occurrences with one fingerprint in a slice are compared word by word, and the counts of
   slices are added up by the phrase's text. So fingerprints only choose what is counted, and a
   collision can't change a result.

A slice holds a fingerprint once, so a phrase that all texts share is one entry a slice and shards
are even. Memory of a task is bounded by a slice (or one longer piece) and by a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigilog.llm.common import UPPER, text_of
from vigilog.llm.perfect_hash import mix
from vigilog.session import materialize

SLICE_BYTES = 1 << 21
SHARD_ENTRIES = 1 << 21
LEAST_SHARDS = 256
#: The largest filter that is broadcast between two lengths, 32 MB.
FILTER_BITS = 1 << 28
FILTER_HASHES = 3
SALTS = 64

# What ends a piece, [.,;:!?\x0A-\x0D].
_BREAKS = ".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    (UPPER + _BREAKS + "\t").encode(), (UPPER.lower() + "\n" * len(_BREAKS) + " ").encode()
)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_BYTES = mix(np.arange(256, dtype=np.uint64), 17)


def normal(raw: bytes) -> bytes:
    """One space between the words of a piece, one newline between pieces, nothing at the ends."""
    codes = np.frombuffer(raw.translate(_TABLE), np.uint8)
    gap = (codes == 32) | (codes == 10)
    first = gap.copy()
    first[1:] &= ~gap[:-1]
    runs = np.flatnonzero(first)
    if not len(runs):
        return codes.tobytes()
    codes = codes.copy()
    # From one run of separators to the next stand its separators and a word.
    codes[runs] = np.where(np.add.reduceat(codes == 10, runs) > 0, 10, 32)
    return codes[~gap | first].tobytes().strip(b" \n")


def cut(body: bytes, most: int) -> Iterator[bytes]:
    """Parts of a normal text of about ``most`` bytes, cut between pieces."""
    while len(body) > most:
        end = body.rfind(b"\n", 0, most)
        if end < 0 and (end := body.find(b"\n", most)) < 0:
            break
        yield body[:end]
        body = body[end + 1 :]
    if body:
        yield body


def slices_of(docs: DataFrame, most: int = SLICE_BYTES) -> DataFrame:
    """(slice, lang, words, body) of ``docs`` (lang, text); a slice is of one language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(langs: list[str]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for lang in langs:
                size.pop(lang)
                for body in cut(normal(b"\n".join(held.pop(lang))), most):
                    words = body.count(b" ") + body.count(b"\n") + 1
                    row = ([number], [lang], [words], [body])
                    types = (pa.int64(), pa.string(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(row, types, strict=True)],
                        ["slice", "lang", "words", "body"],
                    )
                    number += 1

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                text = text.as_py()
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                if size[lang] >= most:
                    yield from flush([lang])
                elif sum(size.values()) >= 4 * most:
                    yield from flush(list(size))
        yield from flush(list(size))

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    return rows.mapInArrow(run, "slice bigint, lang string, words bigint, body binary")


class Fingerprints:
    """Fingerprints of the n-grams of slices, by prefix polynomials."""

    def __init__(self, bits: int = 64):
        self.spare = np.uint64(64 - bits)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def read(self, lang: str, body: bytes) -> None:
        self.codes = np.frombuffer(body, np.uint8)
        n = len(self.codes)
        if n > len(self.powers):
            for name, base in (("powers", _BASE), ("inverses", _INVERSE)):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        gaps = np.flatnonzero((self.codes == 32) | (self.codes == 10))
        self.starts = np.concatenate([[0], gaps + 1])
        self.ends = np.concatenate([gaps, [n]])
        self.piece = np.concatenate([[0], np.cumsum(self.codes[gaps] == 10)])
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[self.codes] * self.powers[:n], out=self.prefix[1:])
        key = np.frombuffer(lang.encode("utf-8", "surrogatepass").ljust(8, b"\0"), np.uint8)
        self.key = np.uint64(0)
        for code in key:
            self.key = mix(np.array([self.key ^ np.uint64(code)]), 23)[0]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, fingerprint) of all phrases of n words."""
        last = len(self.starts) - n + 1
        if last < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[:last] == self.piece[n - 1 :])
        start = self.starts[at]
        own = (self.prefix[self.ends[at + n - 1]] - self.prefix[start]) * self.inverses[start]
        # Fingerprints of fewer bits serve to test collisions.
        return at, mix(own ^ self.key, n) >> self.spare << self.spare

    def candidates(self, n: int, known: Filter | None) -> tuple[np.ndarray, np.ndarray]:
        """Of these the ones whose both parts of n - 1 words may be frequent."""
        at, prints = self.grams(n)
        if known is None or not len(at):
            return at, prints
        parts, smaller = self.grams(n - 1)
        may = np.zeros(len(self.starts), bool)
        may[parts] = known.may_hold(smaller)
        keep = may[at] & may[at + 1]
        return at[keep], prints[keep]

    def words(self) -> np.ndarray:
        """A number for each word of the slice, the same for equal words only."""
        letters = self.codes[(self.codes != 32) & (self.codes != 10)]
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)]).astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.starts), buffers)
        return found.dictionary_encode().indices.to_numpy()

    def phrases(self, at: np.ndarray, n: int) -> pa.Array:
        """The texts of the phrases of n words that start at the given words."""
        start = self.starts[at]
        size = self.ends[at + n - 1] - start
        offsets = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
        buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.codes[take])]
        return pa.StringArray.from_buffers(len(at), *buffers[1:])


def shard_of(prints: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of fingerprints; ``shards`` is a power of two above one."""
    return (prints >> np.uint64(64 - (shards.bit_length() - 1))).astype(np.int64)


class Filter:
    """A Bloom filter with a block for each shard; it may hold more than was put in."""

    def __init__(self, shards: int, blocks: np.ndarray):
        self.shards, self.blocks = shards, blocks

    @staticmethod
    def places(prints: np.ndarray, size: int) -> Iterator[np.ndarray]:
        for k in range(FILTER_HASHES):
            yield (mix(prints, 31 + k) & np.uint64(8 * size - 1)).astype(np.int64)

    @classmethod
    def block(cls, prints: np.ndarray, size: int) -> bytes:
        bits = np.zeros(8 * size, np.uint8)
        for place in cls.places(prints, size):
            bits[place] = 1
        return np.packbits(bits).tobytes()

    def may_hold(self, prints: np.ndarray) -> np.ndarray:
        shard, size = shard_of(prints, self.shards), self.blocks.shape[1]
        found = np.ones(len(prints), bool)
        for place in self.places(prints, size):
            found &= (self.blocks[shard, place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        return found


def count_entries(slices: DataFrame, n: int, known, shards: int, bits: int) -> DataFrame:
    """(shard, slice, prints, counts): the sorted distinct fingerprints of each slice by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, smaller = Fingerprints(bits), known and Filter(shards, known.value)
        names = ["shard", "slice", "prints", "counts"]
        types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        for batch in batches:
            for number, lang, body in zip(*(batch.column(c) for c in ("slice", "lang", "body")), strict=True):
                state.read(lang.as_py(), body.as_py())
                _, prints = state.candidates(n, smaller)
                prints, counts = np.unique(prints, return_counts=True)
                bounds = np.searchsorted(shard_of(prints, shards), np.arange(shards + 1))
                used = np.flatnonzero(np.diff(bounds))
                ranges = [(bounds[s], bounds[s + 1]) for s in used]
                counts = counts.astype(np.uint32)
                columns = (
                    used, np.full(len(used), number.as_py()),
                    [prints[s:e].tobytes() for s, e in ranges], [counts[s:e].tobytes() for s, e in ranges],
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(columns, types, strict=True)], names
                )

    return slices.select("slice", "lang", "body").mapInArrow(
        run, "shard int, slice bigint, prints binary, counts binary"
    )


def mark_entries(entries: DataFrame, least: int) -> DataFrame:
    """(slice, shard, marks) for each slice with a frequent entry in a shard, and for each shard
    a row without a slice, whose marks are the frequent fingerprints themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, slices, prints, counts = None, [], [], []

        def finish() -> pa.RecordBatch:
            sizes = [len(p) for p in prints]
            every = np.concatenate(prints)
            order = np.argsort(every, kind="stable")
            distinct = np.concatenate([[True], np.diff(every[order]) != 0])
            sums = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), np.flatnonzero(distinct))
            often = sums >= least
            marked = np.empty(len(every), bool)
            marked[order] = often[np.cumsum(distinct) - 1]
            rows = [(None, current, every[order][distinct][often].tobytes())]
            for number, own in zip(slices, np.split(marked, np.cumsum(sizes)[:-1]), strict=True):
                if own.any():
                    rows.append((number, current, np.packbits(own).tobytes()))
            types = (pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)],
                ["slice", "shard", "marks"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "slice", "prints", "counts"))
            for shard, number, own, many in zip(*columns, strict=True):
                if shard != current and slices:
                    yield finish()
                    slices, prints, counts = [], [], []
                current = shard
                slices.append(number)
                prints.append(np.frombuffer(own, np.uint64))
                counts.append(np.frombuffer(many, np.uint32))
        if slices:
            yield finish()

    return (
        entries.repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(run, "slice bigint, shard int, marks binary")
    )


def filter_blocks(marked: DataFrame, shards: int, most_bits: int = FILTER_BITS) -> np.ndarray:
    """The blocks of a filter of the frequent fingerprints: 16 bits each, ``most_bits`` altogether."""
    frequent = marked.filter("slice is null").select("shard", "marks")
    total = (frequent.agg(F.sum(F.length("marks"))).first()[0] or 0) // 8
    room = min(most_bits, 1 << (16 * max(1, total) - 1).bit_length())
    size = max(8, room // shards // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [Filter.block(np.frombuffer(m.as_py(), np.uint64), size) for m in batch.column("marks")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), pa.array(blocks, pa.binary())], ["shard", "block"]
            )

    blocks = np.zeros((shards, size), np.uint8)
    for row in frequent.mapInArrow(run, "shard int, block binary").toLocalIterator():
        blocks[row["shard"]] = np.frombuffer(row["block"], np.uint8)
    return blocks


def follow(slices: DataFrame, marked: list[DataFrame], filters: list, shards: int, bits: int) -> DataFrame:
    """(lang, n, phrase, count) of the marked entries of each slice, read from its text."""
    empty = {"lang": "string", "body": "binary", "n": "int", "shard": "int", "marks": "binary"}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(
            "slice", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()]
        )

    rows = shaped(slices)
    for n, marks in enumerate(marked, 1):
        rows = rows.unionByName(shaped(marks.filter("slice is not null").withColumn("n", F.lit(n))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Fingerprints(bits)
        lang, own = None, {}

        def texts() -> Iterator[pa.RecordBatch]:
            word = None
            for n, of_shard in sorted(own.items()):
                smaller = Filter(shards, filters[n - 2].value) if n > 1 else None
                at, prints = state.candidates(n, smaller)
                distinct, first, entry = np.unique(prints, return_index=True, return_inverse=True)
                bounds = np.searchsorted(shard_of(distinct, shards), np.arange(shards + 1))
                often = np.zeros(len(distinct), bool)
                for shard, marks in of_shard.items():
                    s, e = bounds[shard], bounds[shard + 1]
                    often[s:e] = np.unpackbits(np.frombuffer(marks, np.uint8), count=e - s)
                word = state.words() if word is None else word
                taken = often[entry]
                at, like = at[taken], at[first[entry[taken]]]
                same = np.ones(len(at), bool)
                for k in range(n):
                    same &= word[at + k] == word[like + k]
                # An occurrence that only shares the fingerprint counts by its own text.
                firsts, counts = np.unique(np.where(same, like, at), return_counts=True)
                for s in range(0, len(firsts), 1 << 16):
                    part = state.phrases(firsts[s : s + (1 << 16)], n)
                    columns = [
                        pa.array([lang] * len(part), pa.string()), pa.array([n] * len(part), pa.int32()),
                        part, pa.array(counts[s : s + (1 << 16)], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "n", "phrase", "count"])

        for batch in batches:
            columns = (batch.column(c) for c in ("lang", "body", "n", "shard", "marks"))
            for new, body, n, shard, marks in zip(*columns, strict=True):
                if body.is_valid:
                    yield from texts()
                    lang, own = new.as_py(), {}
                    state.read(lang, body.as_py())
                else:
                    own.setdefault(n.as_py(), {})[shard.as_py()] = marks.as_py()
        yield from texts()

    return (
        rows.repartition("slice")
        .sortWithinPartitions("slice", F.col("n").asc_nulls_first())
        .mapInArrow(run, "lang string, n int, phrase string, count bigint")
    )


def frequent_phrases(
    slices: DataFrame, words: int, most: int, least: int, shards: int, bits: int = 64
) -> DataFrame:
    """(lang, n, phrase, f): all phrases of up to ``most`` words found ``least`` times."""
    context = slices.sparkSession.sparkContext
    marked, filters = [], []
    for n in range(1, most + 1):
        entries = count_entries(slices, n, filters[-1] if filters else None, shards, bits)
        marked.append(materialize(mark_entries(entries, least), f"marks-{n}"))
        if n < most:
            filters.append(context.broadcast(filter_blocks(marked[-1], shards)))
    found = follow(slices, marked, filters, shards, bits)
    counted = found.groupBy("lang", "n", "phrase").agg(F.sum("count").alias("f"))
    return materialize(counted.filter(F.col("f") >= least), "phrases")


def _words(phrase: Column, first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, size), " ")


def _exact(column: Column) -> Column:
    """Products may need more than 64 bits."""
    return column.cast("decimal(20,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates' lowest cuts, without the contained ones."""
    single = phrases.select("lang", "phrase", "f")
    cuts = phrases.filter("n >= 2").select(
        "lang", "n", "phrase", F.col("f").alias("a"), F.explode(F.expr("sequence(1, n - 1)")).alias("k")
    )
    cuts = cuts.withColumns(
        {"left": _words(F.col("phrase"), 1, F.col("k")), "right": _words(F.col("phrase"), F.col("k") + 1, F.col("n") - F.col("k"))}
    )
    left = single.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = single.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    whole = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    twice = _exact(F.col("a")) * F.lit(2_000_000).cast("decimal(7,0)")
    whole = whole.withColumn("_twice", twice).withColumn("_sum", _exact(F.col("l")) + _exact(F.col("r")))
    whole = whole.withColumn("score", F.expr("cast(_twice div _sum as bigint)"))
    lowest = whole.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("c")
    )
    longer = phrases.filter("n >= 3").select("lang", "n", "phrase", "f").withColumn(
        "size", F.explode(F.expr("sequence(2, n - 1)"))
    )
    inside = longer.withColumn("at", F.explode(F.expr("sequence(1, n - size + 1)"))).select(
        "lang", _words(F.col("phrase"), F.col("at"), F.col("size")).alias("phrase"), "f"
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    rows = lowest.select("lang", "phrase", "c.a", "c.l", "c.r", "c.score").join(
        inside, ["lang", "phrase"], "left"
    )
    hundred, eighty = (F.lit(x).cast("decimal(3,0)") for x in (100, 80))
    contained = _exact(F.col("longer")) * hundred >= _exact(F.col("a")) * eighty
    return rows.filter(~F.coalesce(contained, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame,
    most: int = 4,
    least: int = 30,
    top: int = 2000,
    slice_bytes: int = SLICE_BYTES,
    bits: int = 64,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``most`` words.

    a, l and r count the phrase and the two parts at its lowest-scoring cut, n all words of the
    language; score is floor(2,000,000 a / (l + r)). Phrases that a longer one holds in 80 % of their
    occurrences go. ``docs`` has lang and text; other columns are not read.

    A null lang is ``und`` and one language with texts that say so; null and empty texts have no
    words. Repeated rows count as often as they occur. Cuts with equal scores: the shortest first
    part. Equal scores and counts: by the phrase in UTF-8 byte order. Very long texts are cut into
    slices between pieces; one piece is never cut. An empty table gives an empty result.
    """
    slices = materialize(slices_of(docs, slice_bytes), "slices")
    words = slices.agg(F.sum("words")).first()[0] or 0
    shards = max(LEAST_SHARDS, 1 << (max(1, words // SHARD_ENTRIES) - 1).bit_length())
    rows = scored(frequent_phrases(slices, words, most, least, shards, bits))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # Each part of a language names its best first, so no task orders all of one.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    within = Window.partitionBy("lang", "_salt").orderBy(*order)
    rows = rows.withColumn("_salt", salt).withColumn("_place", F.row_number().over(within))
    rows = rows.filter(F.col("_place") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    totals = slices.groupBy("lang").agg(F.sum("words").alias("n"))
    return ranked.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
