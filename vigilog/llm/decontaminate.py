"""Benchmark decontamination: q-gram lemma filter over diagonal bands, then banded alignment.

An item leaks into a document if some window of ``window`` consecutive code points of the item (all
of a shorter item) is within the edit budget of some passage of the document: at most ``rate``
times its length insertions, deletions or substitutions. A-Z are lower-cased and runs of white space
are one space on both sides, so layout makes no difference; everything else counts as it is.
Windows and edits count in the text so normalised, results in places of the text as it was.

The q-gram lemma: a window of n code points within e edits of a passage shares at least
n + 1 - q (e + 1) of its q-grams with it, on e + 1 neighbouring diagonals. So, for each document:

1. All q-grams of the whole text are looked up in an index of the items' q-grams.
2. Hits are counted by item in bands of diagonals, two steps wide and a step apart. Any run of
   e + 1 diagonals lies in one of these bands, as a step is more than e.
   q and the step follow from the largest budgets (at most ``Q``, at least ``STEP``); a rate for which q
   would be below ``LEAST_Q`` is refused.
3. Bands in which some window of the item holds enough hits are kept; all others cannot leak.
4. In those, the windows that hold enough hits are aligned within the band widened by e.

Documents are read once and never shuffled. The index is broadcast in blocks of at most
``BLOCK_CHARS`` code points of items: a larger benchmark is so many passes over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from vigilog.llm.common import WHITE, slices, text_of
from vigilog.llm.perfect_hash import mix

Q = 10
WINDOW = 80
RATE = 0.0625
STEP = 8
LEAST_Q = 4
BLOCK_CHARS = 1_000_000
#: Hits that are expanded at a time.
HITS = 1 << 20

_WHITE = np.array([ord(c) for c in WHITE], np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalised codes, and the place in ``text`` of each."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)
    white = np.isin(codes, _WHITE)
    codes = np.where(white, np.uint32(32), codes)
    kept = np.ones(len(codes), bool)
    kept[1:] = ~(white[1:] & white[:-1])
    return codes[kept], np.flatnonzero(kept)


def normal_codes(text: str) -> np.ndarray:
    return normal(text)[0]


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A polynomial hash of every q-gram: lengths are doubled, then go on one by one."""
    single = codes.astype(np.uint64)
    out, have = single, 1
    while 2 * have <= q:
        out = out[:-have] * np.uint64(pow(int(_BASE), have, 1 << 64)) + out[have:]
        have *= 2
    for k in range(have, q):
        out = out[:-1] * _BASE + single[k:]
    return mix(out, 0)


def budget(length: int, rate: float) -> int:
    """Edits allowed in a window."""
    return int(length * rate)


def plan(lengths: np.ndarray, rate: float) -> tuple[int, int]:
    """q and step for windows of these lengths: the lemma promises each at least one shared q-gram."""
    edits = np.array([budget(int(n), rate) for n in lengths], np.int64)
    q = int(min([Q, *(lengths // (edits + 1))]))
    if q < LEAST_Q:
        raise ValueError(f"rate {rate} allows so many edits that no {LEAST_Q} code points in a row need stay")
    return q, int(max([STEP, *(edits + 1)]))


@dataclass
class Index:
    ids: list
    codes: list[np.ndarray]
    places: list[np.ndarray]  # of the codes in the item as it was
    lengths: np.ndarray  # of the items as they were
    q: int
    step: int
    grams: np.ndarray  # sorted distinct hashes
    starts: np.ndarray  # of each hash in item and place
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray  # by the low bits of a hash: whether an item may have it


def build_index(items: list[tuple[object, str]], window: int = WINDOW, rate: float = RATE) -> Index:
    """``items`` of at least Q code points; ``unsearched`` names the shorter ones."""
    items = [(i, len(t), *normal(t)) for i, t in items]
    items = [x for x in items if len(x[2]) >= Q]
    q, step = plan(np.array([min(len(c), window) for _, _, c, _ in items], np.int64), rate)
    hashes = [gram_hashes(c, q) for _, _, c, _ in items]
    every = np.concatenate([np.zeros(0, np.uint64), *hashes])
    item = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
    place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(h)) for h in hashes]])
    order = np.argsort(every, kind="stable")
    grams, starts = np.unique(every[order], return_index=True)
    bits = max(16, int(len(grams) * 16).bit_length())
    seen = np.zeros(1 << bits, bool)
    seen[(grams & np.uint64(len(seen) - 1)).astype(np.int64)] = True
    ids, lengths, codes, places = ([x[k] for x in items] for k in range(4))
    return Index(ids, codes, places, np.array(lengths, np.int64), q, step, grams, np.append(starts, len(every)), item[order], place[order], seen)


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, wins: np.ndarray, n: int):
    """(edits, end) of the best alignment of item[w : w + n] for each w in ``wins``.

    The passage of ``text`` may start and end anywhere on the diagonals low..high-1 (text position
    less item position). Windows that stand in the text unchanged are not aligned any further.
    """
    diagonals = np.arange(low, high)
    rows = np.arange(wins[0], wins[-1] + n)
    at = rows[:, None] + diagonals
    inside = (at >= 0) & (at < len(text))
    differs = ~inside | (text[np.clip(at, 0, len(text) - 1)] != item[rows][:, None])
    sums = np.vstack([np.zeros(len(diagonals), np.int64), np.cumsum(differs, 0)])
    own = wins - wins[0]
    straight = sums[own + n] - sums[own]
    best, column = straight.min(1), straight.argmin(1)
    todo = np.flatnonzero(best > 0)
    if len(todo):
        first = own[todo]
        cost = np.zeros((len(todo), len(diagonals)), np.int64)
        shift = np.arange(len(diagonals))
        for k in range(n):
            step = cost + differs[first + k]
            np.minimum(step[:, :-1], cost[:, 1:] + 1, out=step[:, :-1])
            cost = np.minimum.accumulate(step - shift, 1) + shift
        best[todo], column[todo] = cost.min(1), cost.argmin(1)
    return best, np.clip(wins + n + diagonals[column], 0, len(text))


def band_counts(place_in_text: np.ndarray, gram: np.ndarray, of: np.ndarray, index: Index, longest: int):
    """(text, item, strip of diagonals, hits), sorted, of hits given by their place, gram and text.

    A gram that an item repeats is as many hits. They are expanded ``HITS`` at a time and counted
    by strip at once, so neither a repeated gram in an item nor one in a text takes more memory.
    """
    count = index.starts[gram + 1] - index.starts[gram]
    until = np.cumsum(count)
    items, strips = len(index.codes), (longest + max(len(c) for c in index.codes)) // index.step + 2
    shift = max(len(c) for c in index.codes) // index.step + 1
    keys, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    s = 0
    while s < len(gram):
        done = until[s - 1] if s else 0
        e = max(s + 1, int(np.searchsorted(until, done + HITS, "right")))
        own = count[s:e]
        run = np.repeat(np.arange(s, e), own)
        entry = np.arange(len(run)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(index.starts[gram[s:e]], own)
        strip = (place_in_text[run] - index.place[entry]) // index.step + shift
        waiting.append(np.unique((of[run] * items + index.item[entry]) * strips + strip, return_counts=True))
        s = e
        if s == len(gram) or sum(len(k) for k, _ in waiting) > max(HITS, len(keys)):
            keys, back = np.unique(np.concatenate([keys, *[k for k, _ in waiting]]), return_inverse=True)
            # Whole numbers below 2**53 are exact as weights.
            held = np.bincount(back, np.concatenate([held, *[n for _, n in waiting]])).astype(np.int64)
            waiting.clear()
    return keys // strips // items, keys // strips % items, keys % strips - shift, held


def leaks_in(texts: list[str], index: Index, window: int, rate: float) -> Iterator[tuple]:
    """(text number, item number, start, end, edits, covered) of every leak in ``texts``."""
    codes, origins = ([x[k] for x in map(normal, texts)] for k in range(2)) if texts else ([], [])
    q, width = index.q, index.step
    joined = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    if len(joined) < q or not len(index.grams):
        return
    ends = np.cumsum([len(c) for c in codes])
    hashes = gram_hashes(joined, q)
    at = np.flatnonzero(index.seen[(hashes & np.uint64(len(index.seen) - 1)).astype(np.int64)])
    gram = np.minimum(np.searchsorted(index.grams, hashes[at]), len(index.grams) - 1)
    real = index.grams[gram] == hashes[at]
    at, gram = at[real], gram[real]
    of = np.searchsorted(ends, at, "right")
    whole = at + q <= ends[of]
    at, gram, of = at[whole], gram[whole], of[whole]
    if not len(at):
        return
    sizes = np.array([len(c) for c in index.codes])
    n_of = np.minimum(sizes, window)
    e_of = np.array([budget(int(n), rate) for n in n_of])
    need = n_of + 1 - q * (e_of + 1)
    base = ends - np.array([len(c) for c in codes])
    of, item, band, held = band_counts(at - base[of], gram, of, index, len(joined))
    # A band is two strips of diagonals: a strip and the next one, if that has hits.
    after = np.zeros(len(of), bool)
    after[:-1] = (of[1:] == of[:-1]) & (item[1:] == item[:-1]) & (band[1:] == band[:-1] + 1)
    both = held + np.where(after, np.append(held[1:], 0), 0)
    # Of each text and item: where windows start, fewest edits, first and last end.
    found: dict[tuple[int, int], tuple[np.ndarray, int, int, int]] = {}
    own: tuple[int, np.ndarray] = (-1, hashes[:0])
    for g in np.flatnonzero(both >= need[item]):
        t, i = int(of[g]), int(item[g])
        n, e = int(n_of[i]), int(e_of[i])
        low = int(band[g]) * width
        if own[0] != i:
            own = i, gram_hashes(index.codes[i], q)
        text_grams = hashes[int(base[t]) : int(ends[t]) - q + 1]
        marks = np.zeros(int(sizes[i]) - q + 2, np.int64)
        for diagonal in range(low, low + (2 if after[g] else 1) * width):
            first, last = max(0, -diagonal), min(len(own[1]), len(text_grams) - diagonal)
            if first < last:
                marks[first + 1 : last + 1] |= own[1][first:last] == text_grams[first + diagonal : last + diagonal]
        marks = np.cumsum(marks)
        wins = np.flatnonzero(marks[n - q + 1 :] - marks[: len(marks) - (n - q + 1)] >= need[i])
        if not len(wins):
            continue
        edits, stop = align(index.codes[i], codes[t], low - e, low + 2 * width + e, wins, n)
        good = edits <= e
        if good.any():
            starts, *old = found.get((t, i), (np.zeros(int(sizes[i]), bool), e, int(stop.max()), 0))
            starts[wins[good]] = True
            new = (int(edits[good].min()), int(stop[good].min()), int(stop[good].max()))
            found[t, i] = (starts, min(old[0], new[0]), min(old[1], new[1]), max(old[2], new[2]))
    for (t, i), (starts, edits, first, last) in found.items():
        n = int(n_of[i])
        wins = np.flatnonzero(starts)
        marks = np.zeros(int(sizes[i]) + 1, np.int64)
        marks[wins] += 1
        marks[wins + n] -= 1
        spans = np.diff(index.places[i], append=index.lengths[i])
        covered = int(spans[np.cumsum(marks)[:-1] > 0].sum())
        first, last = max(0, first - n), last - 1
        yield t, i, int(origins[t][first]), int(origins[t][last]) + 1, edits, covered


def unsearched(benchmark: DataFrame) -> DataFrame:
    """item_id and text of the items below ``Q`` normalised code points, which ``find_leaks`` does not search.

    So short a string stands in many clean documents, so it is no evidence of a leak; a benchmark
    should join such items with their context. Null texts are empty; repeated rows stay.
    """
    one = F.regexp_replace(text_of(), f"[{WHITE}]+", " ")
    return benchmark.filter(F.length(one) < Q).select("item_id", "text")


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, rate: float = RATE) -> DataFrame:
    """doc_id, item_id, start, end, edits, covered for every item that leaks into a document.

    start and end span the matched passages in the document's code points (start to within the
    edit budget), edits are those of the best window, covered counts the item's code points that
    lie in matched windows.

    Null texts and items match nothing, nor do items below ``Q`` normalised code points
    (``unsearched`` returns those). Repeated rows on
    either side give repeated results; null ids pass through. Empty tables give an empty result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    key, item_key = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {key}, item_id {item_key}, start bigint, end bigint, edits int, covered bigint"
    items = benchmark.select("item_id", text_of().alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))

    def matcher(block: int):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = build_index([(r.item_id, r.text) for r in own.collect()], window, rate)
        shared = spark.sparkContext.broadcast(tuple(vars(index).values()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                texts = [x or "" for x in batch.column("text").to_pylist()]
                rows = []
                for s, e in slices(texts):
                    rows += [(s + t, *rest) for t, *rest in leaks_in(texts[s:e], index, window, rate)]
                if rows:
                    of, item, *rest = (list(c) for c in zip(*rows, strict=True))
                    columns = [batch.column("doc_id").take(pa.array(of, pa.int64()))]
                    columns.append(pa.array([index.ids[i] for i in item], arrow_key))
                    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                    columns += [pa.array(c, t) for c, t in zip(rest, types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "start", "end", "edits", "covered"])

        return run

    arrow_key = to_arrow_type(benchmark.schema["item_id"].dataType)
    found = [docs.select("doc_id", "text").mapInArrow(matcher(b), schema) for b in range(blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
