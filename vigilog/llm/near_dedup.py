"""Near-duplicate grouping: SuperMinHash signatures, banding, exact verification, union-find.

A document's set holds the distinct shingles of ``words`` consecutive words, words being what
stands between white space, with A-Z lower-cased; a shorter text is one shingle, one without
words has an empty set and is linked with nothing. Documents are linked if intersection / union of
their sets is at least the threshold, and grouped by the connected components of these links.

1. Signatures. In SuperMinHash an element has one random permutation of the slots and rising
   ranks along it, so its values are spread evenly and signatures vary less than with independent
   hashes; an element is left as soon as its ranks exceed all slots, for most texts after one or two
   steps. Equal sets become one node before anything else, so copies never meet in a bucket.
2. Banding. Nodes that agree in a whole band are candidates. Only an edge from each node to the
   smallest node of its bucket is made, and their connected components are the candidate groups:
   every pair that shares a bucket is inside one group, and no pairs are listed.
3. Verification inside each candidate group, on full sets of 64-bit shingle hashes. Shingles are
   ordered from rare to common in the group; two sets can only reach the threshold if their
   first few shingles in this order share one. Neighbours under a shingle are compared first; after
   that only sets outside the largest component look for more, and never inside their own (union-find). This loses no link between nodes that share a bucket, directly or
   not. Groups above ``GROUP_SHINGLES`` are cut into chunks, and each pair of chunks is a task.
4. The tasks' forests are joined by distributed connected components.

With bands of four a pair at the threshold shares no bucket with probability below 1e-6
(``bands_for``); that, and only that, can lose a link.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import WHITE, hash128, map_texts, slices, text_of
from vigilog.llm.components import components
from vigilog.llm.fingerprint import BASE
from vigilog.llm.perfect_hash import mix
from vigilog.session import materialize

ROWS = 4  # slots in a band
MISS = 1e-6
GROUP_SHINGLES = 1_500_000

_WHITE = np.array([ord(c) for c in WHITE], np.uint32)
_POWERS = mix(np.arange(1 << 12, dtype=np.uint64), 3) | np.uint64(1)


def bands_for(percent: int) -> int:
    """Bands that a pair at the threshold misses altogether with a probability below ``MISS``."""
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    joined = "".join(f" {t} " for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    blank = np.isin(codes, _WHITE)
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    size = np.flatnonzero(~blank[:-1] & blank[1:]) + 1 - starts
    inside = np.flatnonzero(~blank)
    first = np.cumsum(size) - size
    place = np.arange(len(inside)) - np.repeat(first, size)
    # Positions beyond the table of powers are told apart by a second factor.
    power = _POWERS[place & (len(_POWERS) - 1)] + (place >> 12).astype(np.uint64)
    parts = mix(codes[inside], 1) * power
    hashes = mix(np.add.reduceat(parts, first), 2) if len(starts) else np.zeros(0, np.uint64)
    ends = np.cumsum([len(t) + 2 for t in texts])
    bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
    out = []
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        own = hashes[s:e]
        width = min(words, len(own))
        found = own[: len(own) - width + 1] if width else own
        for k in range(1, width):
            found = mix(found * BASE ^ own[k : len(own) - width + 1 + k], k)
        # The whole of a short text is no shingle of a longer one.
        found = found ^ np.uint64(width - words & (2**64 - 1)) if width else found
        out.append(np.unique(found))
    return out


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash of each set, a row of ``slots`` numbers; infinite for empty sets.

    All sets take a step together. In step j an element draws a rank in [j, j + 1) for the next
    slot of its permutation. A set is done when its largest slot is below j.
    """
    flat = np.full(len(sets) * slots, np.inf)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate([np.zeros(0, np.uint64), *sets])
    order = None  # each open element's permutation, lazily shuffled
    for j in range(slots):
        draw = mix(items, 2 * j + 11)
        rank = j + (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        swap = j + (mix(draw, 5) % np.uint64(slots - j)).astype(np.int64)
        if order is None:
            slot = swap
        else:
            rows = np.arange(len(items))
            slot = order[rows, swap].astype(np.int64)
            order[rows, swap] = order[rows, j]
        np.minimum.at(flat, of * slots + slot, rank)
        open_ = (flat.reshape(-1, slots).max(1) >= j + 1)[of]
        if not open_.any():
            break
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (int(open_.sum()), 1))
            rows = np.arange(len(order))
            order[rows, swap[open_]] = 0  # the first step's swap
            of, items = of[open_], items[open_]
        elif not open_.all():
            order, of, items = order[open_], of[open_], items[open_]
    return flat.reshape(-1, slots)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    values = np.ascontiguousarray(found).view(np.uint64).reshape(len(found), -1, ROWS)
    keys = np.broadcast_to(np.arange(values.shape[1], dtype=np.uint64), values.shape[:2])
    for k in range(ROWS):
        keys = mix(keys * BASE ^ values[:, :, k], k)
    return keys.view(np.int64)


def set_name(found: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def sign(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, text hash, n, set name a and b, bands) for each row."""
    slots = bands_for(percent) * ROWS

    def make() -> Callable[[list[str]], dict[str, object]]:
        def compute(texts: list[str]) -> dict[str, object]:
            sets = shingle_sets(texts, words)
            names = [set_name(s) for s in sets]
            bands = []
            for s, e in slices(sets, 1 << 17):
                bands += list(band_keys(signatures(sets[s:e], slots)))
            return {"n": [len(s) for s in sets], "a": [a for a, _ in names], "b": [b for _, b in names], "bands": bands}

        return compute

    rows = docs.select("doc_id", hash128(text_of()).alias("copy"), text_of().alias("text"))
    return map_texts(rows, make, "n bigint, a bigint, b bigint, bands array<bigint>")


class UnionFind:
    """Groups of 0..n-1. ``root`` names the group of each; of two that join, the smaller one is relabelled."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self._members = {}

    def join(self, a: int, b: int) -> None:
        a, b = int(self.root[a]), int(self.root[b])
        if a == b:
            return
        big, small = (self._members.pop(r, None) or [r] for r in (a, b))
        if len(big) < len(small):
            big, small, a = small, big, b
        self.root[small] = a
        big.extend(small)
        self._members[a] = big

    def largest(self) -> int:
        """The name of the largest group; of equally large ones any."""
        return max(self._members, key=lambda r: len(self._members[r]), default=0)

    def smallest(self) -> np.ndarray:
        """The smallest member of each one's group."""
        least = np.full(len(self.root), len(self.root))
        np.minimum.at(least, self.root, np.arange(len(self.root)))
        return least[self.root]


def linked(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Root of each set in the graph of all links at or above the threshold.

    With ``side`` only links between sets of different sides count.
    """
    size = np.array([len(s) for s in sets])
    groups = UnionFind(len(sets))
    of = np.repeat(np.arange(len(sets)), size)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rarity = np.empty(len(count), np.int64)
    rarity[np.argsort(count, kind="stable")] = np.arange(len(count))
    token = rarity[token]
    by_set = np.lexsort((token, of))
    first = np.cumsum(size) - size
    place = np.arange(len(of)) - np.repeat(first, size)
    prefix = size - (-(-percent * size // 100)) + 1
    head = by_set[place < np.repeat(prefix, size)]
    head_token, head_set = token[head], of[head]
    order = np.lexsort((head_set, head_token))
    listed = head_set[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(head_token, minlength=len(count)))])
    tokens_of = np.split(head_token, np.cumsum(prefix)[:-1])

    def near_enough(x: int, y: int) -> bool:
        at = np.minimum(np.searchsorted(sets[x], sets[y]), size[x] - 1)
        both = np.count_nonzero(sets[x][at] == sets[y])
        return 100 * both >= percent * (size[x] + size[y] - both)

    # Neighbours in the lists first: most copies of a template are one group after a pass that is linear.
    by_size = np.lexsort((listed, size[listed], head_token[order]))
    row = listed[by_size]
    beside = np.flatnonzero(head_token[order][1:] == head_token[order][:-1])
    for x, y in zip(row[beside], row[beside + 1], strict=True):
        if groups.root[x] != groups.root[y] and (side is None or side[x] != side[y]) and near_enough(x, y):
            groups.join(x, y)
    # Of a pair in different groups at least one set is outside the largest.
    rest = np.flatnonzero(groups.root != groups.largest())
    for x in rest[np.argsort(size[rest], kind="stable")]:
        lists = [listed[starts[t] : starts[t + 1]] for t in tokens_of[x] if starts[t + 1] - starts[t] > 1]
        if not lists:
            continue
        near = np.concatenate(lists)
        fit = groups.root[near] != groups.root[x]
        fit &= (100 * size[near] >= percent * size[x]) & (100 * size[x] >= percent * size[near])
        if side is not None:
            fit &= side[near] != side[x]
        near, shares = np.unique(near[fit], return_counts=True)
        near = near[np.argsort(-shares, kind="stable")]
        while len(near):
            y, near = near[0], near[1:]
            if near_enough(x, y):
                groups.join(x, y)
                near = near[groups.root[near] != groups.root[x]]
    return groups.smallest()


def verify(members: DataFrame, words: int, percent: int) -> DataFrame:
    """(src, dst) forests of verified links from (task, pair, chunk, a, b, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, names, sets, sides, pair = None, [], [], [], False

        def finish() -> pa.RecordBatch:
            # A repeated row gives its set twice; the set counts once.
            _, once = np.unique(np.array(names), axis=0, return_index=True)
            own = [sets[n] for n in once]
            root = linked(own, percent, np.array(sides)[once] if pair else None)
            moved = np.flatnonzero(root != np.arange(len(root)))
            kept = np.array(names)[once]
            columns = [kept[moved, 0], kept[moved, 1], kept[root[moved], 0], kept[root[moved], 1]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list("abcd"))

        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = [batch.column(c).to_pylist() for c in ("task", "pair", "chunk", "a", "b")]
            for s, e in slices(texts):
                for n, found in enumerate(shingle_sets(texts[s:e], words), s):
                    task, is_pair, chunk, a, b = (c[n] for c in rows)
                    if task != current:
                        if len(sets) > 1:
                            yield finish()
                        current, names, sets, sides, pair = task, [], [], [], is_pair
                    names.append((a, b))
                    sets.append(found)
                    sides.append(chunk)
        if len(sets) > 1:
            yield finish()

    found = (
        members.repartition("task")
        .sortWithinPartitions("task")
        .mapInArrow(run, "a bigint, b bigint, c bigint, d bigint")
    )
    return found.select(F.struct("a", "b").alias("src"), F.struct(F.col("c").alias("a"), F.col("d").alias("b")).alias("dst"))


def candidate_tasks(groups: DataFrame, most: int = GROUP_SHINGLES) -> DataFrame:
    """(node, task, pair, chunk): where the nodes of (node, n, component) are compared.

    A group of at most ``most`` shingles is one task. A larger one is dealt into chunks of half
    that size; each chunk is a task, and so is each pair of chunks.
    """
    sizes = groups.groupBy("component").agg(F.sum("n").alias("total"))
    chunks = F.when(F.col("total") <= most, 1).otherwise(F.ceil(2 * F.col("total") / most))
    dealt = groups.join(sizes, "component").withColumn("chunks", chunks.cast("int"))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    return dealt.select("node", "component", "chunk", other).select(
        "node",
        F.xxhash64("component", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("task"),
        (F.col("chunk") != F.col("other")).alias("pair"),
        "chunk",
    )


def group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, copy, n_shingles, root, component_id) for each row of ``docs`` (doc_id, text).

    ``copy`` is a hash of the text, ``root`` names the group (null for empty sets).
    """
    signed = materialize(sign(docs, words, percent), "signed")
    node = F.struct("a", "b")
    full = signed.filter("n > 0")
    sets = materialize(
        full.groupBy(node.alias("node"))
        .agg(F.first("n").alias("n"), F.min(F.struct("doc_id", "copy")).alias("row"), F.min("doc_id").alias("least"), F.first("bands").alias("bands")),
        "sets",
    )
    placed = sets.select("node", F.explode("bands").alias("band"))
    centers = placed.groupBy("band").agg(F.min("node").alias("dst"), F.count("*").alias("c"))
    edges = placed.join(centers.filter("c > 1"), "band").filter("node <> dst")
    candidates = components(edges.select(F.col("node").alias("src"), "dst"), "candidates")
    members = sets.join(candidates, "node").select("node", "n", "row", "component")
    members = materialize(members, "members")
    tasks = candidate_tasks(members.select("node", "n", "component")).join(members.select("node", "row"), "node")
    texts = docs.select("doc_id", text_of().alias("text")).withColumn("copy", hash128(F.col("text")))
    rows = tasks.select("task", "pair", "chunk", "node.*", F.col("row.doc_id").alias("id"), F.col("row.copy").alias("copy"))
    # Both keys, so that copies of one text are spread by their ids.
    own = (texts["copy"] == rows["copy"]) & texts["doc_id"].eqNullSafe(rows["id"])
    fetched = texts.join(rows, own).select("task", "pair", "chunk", "a", "b", "text")
    forest = verify(fetched, words, percent)
    roots = components(forest, "links")
    rooted = sets.select("node", "least").join(roots, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("root")
    )
    rooted = materialize(rooted, "roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("node", "root", "component_id")
    return (
        signed.select("doc_id", "copy", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, node).alias("node"))
        .join(labels, "node", "left")
        .select(
            "doc_id", "copy", "n_shingles", "root",
            F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, kept says whether it is the row's own.

    Null and empty texts have no shingles and form no group. Repeated rows are equal documents. A
    null doc_id is never the smallest unless a group has no other; such a row is not kept where
    another stands for it, and its component_id is null where none does (kept is true then). An
    empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    found = group(docs, words, percent)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id, of equal ones the smallest text
    hash. Rows without words stay. All columns pass through.
    """
    found = group(docs, words, percent)
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "copy")
    first = found.filter("root is not null").groupBy("root").agg(F.min(order).alias("row"))
    # Copies of a text without words have a key each, so that none of them is dropped.
    chosen = first.select(F.col("row.doc_id").alias("__id"), F.col("row.copy").alias("__copy"))
    keyed = docs.withColumns({"__copy": hash128(text_of()), "__words": text_of().rlike(r"[^\x20\x09-\x0D]")})
    match = keyed["__copy"] == chosen["__copy"]
    match &= keyed["doc_id"].eqNullSafe(chosen["__id"])
    survivors = keyed.filter("__words").join(chosen, match).select(keyed["*"])
    survivors = survivors.dropDuplicates(["__copy", "doc_id"])
    return survivors.unionByName(keyed.filter("not __words")).drop("__copy", "__words")
