"""Conversation prefix trie as minimal-perfect-hash node tables.

Conversations are rebuilt with the opening of their block's first one (see ``rebuilt``), and each
distinct sequence of first turns is a node.

1. Turns are put in order by a range shuffle, so a conversation with very many of them is spread
   over tasks; its parts are numbered by their counts. No window holds a whole conversation.
2. A node's digest is the exclusive or of the 128-bit hashes of (place, role, text) of its turns. It
   goes on from band to band of ``BAND`` turns, so that long conversations need no single task.
3. Rows are dealt to shards by conversation and band. A shard enumerates its distinct prefix
   digests and gives them the slots of a minimal perfect hash; every row's digest is compared with the
   one in its slot, and a digest that stands for two different parents or last turns stops the run.
   Counts are scattered into flat arrays by slot; one row for each node of a shard is left, and
   these are added up. A first turn that all conversations share is a single row of each shard.
4. Subtree sums are linear: a node's part in them is booked on its smallest member's row alone. Each
   shard scatters these and adds them up through an array of parent slots, deepest first; the
   sums of the shards are added. What lies in deeper bands is booked on the last row of a band.
5. Ids of the conversations that end at a node are hashed as a sorted stream.

The largest things in memory are the arrays of a shard: about ``SHARD_ROWS`` rows, or a band of
each conversation in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.common import hash128, text_of
from vigilog.llm.perfect_hash import PerfectHash, mix
from vigilog.session import materialize

# Conversations that share an opening, and the longest one.
BLOCK, OPENINGS = 100, 6
BAND = 4096
SHARD_ROWS = 1 << 18
LEAST_SHARDS = 64
#: Parents with more children than this share of all nodes are looked up by broadcast: 10,000 at most.
HUBS = 10_000


def in_order(turns: DataFrame) -> DataFrame:
    """(conv_id, part, at, hash, chars): ``at`` rises with the order of turns in each part.

    Parts are the tasks of a range shuffle; a conversation's parts follow each other.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", text_of("role").alias("role"), text_of().alias("text")
    )
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "conv_id", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        hash128(F.col("role"), F.col("text")).alias("hash"), F.length("text").cast("long").alias("chars"),
    )
    return materialize(rows, "ordered")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, hash, chars, last) of all rebuilt turns, and (conv_id, total) of all
    conversations.

    Conversation c opens with the first h turns of the first conversation of its block (c - c mod 100), h
    being the CRC-32 of its decimal id mod 6, and goes on with its own turns after its first h.
    """
    ordered = in_order(turns)
    own = Window.partitionBy("conv_id").orderBy("part")
    parts = ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = materialize(parts.withColumn("before", before), "parts")
    lengths = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    opening = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(OPENINGS))
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(BLOCK))
    convs = lengths.select("conv_id", "n", opening.alias("h"), base.alias("base"))
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("lent"))
    convs = convs.join(bases, "base", "left").withColumn("k", F.least("h", F.coalesce("lent", F.lit(0))))
    convs = convs.withColumn("total", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv_id", "base", "h", "k", "total"), "conversations")
    known = parts.join(convs, "conv_id").drop("n")
    placed = ordered.join(known, ["conv_id", "part"]).withColumn(
        "place", F.col("before") + F.col("at") - F.col("first")
    )
    mine = placed.filter("place >= h").select(
        "conv_id", (F.col("k") + F.col("place") - F.col("h") + 1).alias("depth"), "hash", "chars", "total"
    )
    heads = placed.filter(F.col("place") < OPENINGS - 1).select(
        F.col("conv_id").alias("base"), "place", "hash", "chars"
    )
    lent = convs.join(heads, "base").filter("place < h").select(
        "conv_id", (F.col("place") + 1).alias("depth"), "hash", "chars", "total"
    )
    rows = mine.unionByName(lent).withColumn("last", F.col("depth") == F.col("total")).drop("total")
    return rows, convs.select("conv_id", "total")


def band_of(depth: Column, band: int) -> Column:
    return F.floor(F.greatest(depth - 1, F.lit(0)) / band).cast("long")


def _digest(a: Column, b: Column, depth: Column) -> Column:
    return hash128(depth.cast("long"), a, b)


def memberships(turns: DataFrame, band: int) -> DataFrame:
    """(conv_id, depth, band, node, parent, hash, chars, last): a row for each conversation and node
    on its path, the root included (hash and parent null).
    """
    rows, convs = rebuilt(turns)
    term = hash128(F.col("depth"), F.col("hash"))
    rows = rows.withColumns({"term": term, "band": band_of(F.col("depth"), band)})
    upto = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    xored = {f"x{k}": F.bit_xor(f"term.{k}").over(upto) for k in "ab"}
    rows = materialize(rows.withColumns(xored), "terms")
    # What the bands before add; only conversations of more than one band have any.
    bands = rows.groupBy("conv_id", "band").agg(*[F.bit_xor(f"term.{k}").alias(f"y{k}") for k in "ab"])
    longer = bands.groupBy("conv_id").agg(F.max("band").alias("b")).filter("b > 0").select("conv_id")
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.join(longer, "conv_id", "left_semi")
    bands = bands.select("conv_id", "band", *[F.bit_xor(f"y{k}").over(earlier).alias(f"y{k}") for k in "ab"])
    rows = rows.join(bands, ["conv_id", "band"], "left")
    upto_a, upto_b = (F.col(f"x{k}").bitwiseXOR(F.coalesce(f"y{k}", F.lit(0))) for k in "ab")
    parent = _digest(
        upto_a.bitwiseXOR(F.col("term.a")), upto_b.bitwiseXOR(F.col("term.b")), F.col("depth") - 1
    )
    rows = rows.select(
        "conv_id", "depth", "band", _digest(upto_a, upto_b, F.col("depth")).alias("node"),
        parent.alias("parent"), "hash", "chars", "last",
    )
    zero = F.lit(0).cast("long")
    nothing = F.lit(None).cast("struct<a:bigint,b:bigint>")
    roots = convs.select(
        "conv_id", zero.alias("depth"), zero.alias("band"), _digest(zero, zero, zero).alias("node"),
        nothing.alias("parent"), nothing.alias("hash"), zero.alias("chars"), (F.col("total") == 0).alias("last"),
    )
    return rows.unionByName(roots)


class NodeTable:
    """The nodes of a shard's rows: flat arrays by slot, a row's slot in ``slot``."""

    def __init__(self, rows: dict[str, np.ndarray]):
        a, b, pa_, pb = (rows[c].view(np.uint64) for c in ("a", "b", "pa", "pb"))
        order = np.lexsort((b, a))
        first = order[np.concatenate([[True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)])]
        salt = 0
        while True:
            keys = mix(a[first], salt) ^ b[first]
            if len(np.unique(keys)) == len(keys):
                break
            salt += 1  # two digests met in one key
        self.hash = PerfectHash.build(keys)
        self.size = len(first)
        at = self.hash.index(keys)
        self.a, self.b = np.empty(self.size, np.uint64), np.empty(self.size, np.uint64)
        self.a[at], self.b[at] = a[first], b[first]
        self.slot = self.find(a, b, salt)
        if (self.slot < 0).any():
            raise ValueError("a prefix digest did not find its slot")
        self.row = np.empty(self.size, np.int64)  # a row of each node
        self.row[self.slot] = np.arange(len(a))
        like = self.row[self.slot]
        for column in ("pa", "pb", "ha", "hb", "depth", "chars"):
            if (rows[column] != rows[column][like]).any():
                raise ValueError("one prefix digest stands for two different prefixes")
        # Parents in an earlier band are not among a shard's nodes.
        self.parent = self.find(pa_[self.row], pb[self.row], salt)
        self.parent[rows["depth"][self.row] == 0] = -1
        self.depth = rows["depth"][self.row]

    def find(self, a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
        """Slots of digests, compared in full; -1 for foreign ones."""
        slot = self.hash.index(mix(a, salt) ^ b)
        known = (slot >= 0) & (self.a[slot] == a) & (self.b[slot] == b)
        return np.where(known, slot, -1)

    def scatter(self, values: np.ndarray) -> np.ndarray:
        sums = np.zeros(self.size, np.int64)
        np.add.at(sums, self.slot, values)
        return sums

    def accumulate(self, values: np.ndarray) -> np.ndarray:
        """Each slot's value and those below it, through the parent slots, deepest first."""
        sums = values.copy()
        order = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        for level in np.split(order, cuts):
            level = level[self.parent[level] >= 0]
            np.add.at(sums, self.parent[level], sums[level])
        return sums


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def by_shard(
    rows: DataFrame,
    shards: int,
    values: list[str],
    compute: Callable[[NodeTable, dict[str, np.ndarray]], dict[str, np.ndarray]],
    schema: str,
) -> DataFrame:
    """``compute`` on the node table of each shard; ``values`` are further bigint columns it gets."""
    columns = ["conv_id", "depth", "a", "b", "pa", "pb", "ha", "hb", "chars", *values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []

        def finish() -> pa.RecordBatch:
            own = {c: np.concatenate([h[c] for h in held]) for c in columns}
            found = compute(NodeTable(own), own)
            names = _names(schema)
            return pa.RecordBatch.from_arrays([pa.array(found[c]) for c in names], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            own = {c: batch.column(c).fill_null(0).to_numpy() for c in columns}
            shard, band = (batch.column(c).to_numpy() for c in ("shard", "band"))
            cuts = np.flatnonzero((np.diff(shard) != 0) | (np.diff(band) != 0)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(shard)], strict=True):
                if (shard[s], band[s]) != current and held:
                    yield finish()
                    held = []
                current = (shard[s], band[s])
                held.append({c: x[s:e] for c, x in own.items()})
        if held:
            yield finish()

    flat = rows.select(
        F.pmod(F.xxhash64("conv_id"), F.lit(shards)).cast("int").alias("shard"), "band", "conv_id", "depth",
        "node.a", "node.b", F.col("parent.a").alias("pa"), F.col("parent.b").alias("pb"),
        F.col("hash.a").alias("ha"), F.col("hash.b").alias("hb"), "chars", *values,
    )
    return flat.repartition("shard", "band").sortWithinPartitions("shard", "band").mapInArrow(run, schema)


NODES = (
    "a bigint, b bigint, pa bigint, pb bigint, ha bigint, hb bigint, depth bigint, chars bigint, "
    "n_convs bigint, conv_id bigint, deeper bigint"
)


def node_table(members: DataFrame, shards: int) -> DataFrame:
    """(node, parent, depth, chars, n_convs, conv_id, leaf) for each node."""

    def compute(table: NodeTable, rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        least = np.full(table.size, np.iinfo(np.int64).max)
        np.minimum.at(least, table.slot, rows["conv_id"])
        found = {c: rows[c][table.row] for c in ("a", "b", "pa", "pb", "ha", "hb", "depth", "chars")}
        ones = np.ones(len(table.slot), np.int64)
        return found | {
            "n_convs": table.scatter(ones), "conv_id": least, "deeper": table.scatter(rows["more"])
        }

    rows = members.withColumn("more", F.when(F.col("last"), 0).otherwise(1).cast("long"))
    local = by_shard(rows, shards, ["more"], compute, NODES)
    same = ("pa", "pb", "ha", "hb", "depth", "chars")
    merged = local.groupBy("a", "b").agg(
        *[F.min(c).alias(c) for c in same],
        F.max(F.struct(*same)).alias("most"), F.min(F.struct(*same)).alias("least"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("deeper").alias("deeper"),
    )
    # Shards compare the digests in their slots; so do the rows that shards hand on.
    clash = F.raise_error(F.lit("one prefix digest stands for two different prefixes")).cast("bigint")
    depth = F.when(F.col("most") == F.col("least"), F.col("depth")).otherwise(clash)
    return merged.select(
        F.struct("a", "b").alias("node"),
        F.when(F.col("depth") > 0, F.struct(F.col("pa").alias("a"), F.col("pb").alias("b"))).alias("parent"),
        depth.alias("depth"), "chars", "n_convs", "conv_id", (F.col("deeper") == 0).alias("leaf"),
    )


def subtree_sums(members: DataFrame, nodes: DataFrame, shards: int, band: int) -> DataFrame:
    """(node, n_leaves, saved_tokens) for each node with a sum that is not zero."""
    booked = nodes.select(
        "conv_id", "depth", F.col("leaf").cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
    )
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    bands = booked.groupBy("conv_id", band_of(F.col("depth"), band).alias("band")).agg(*sums)
    deepest = bands.groupBy("conv_id").agg(F.max("band").alias("deepest")).filter("deepest > 0")
    every = deepest.select("conv_id", F.explode(F.expr("sequence(0L, deepest)")).alias("band"))
    below = Window.partitionBy("conv_id").orderBy("band").rowsBetween(1, Window.unboundedFollowing)
    carried = every.join(bands, ["conv_id", "band"], "left").select(
        "conv_id", ((F.col("band") + 1) * band).alias("depth"),
        *[F.sum(c).over(below).alias(c) for c in ("n_leaves", "saved_tokens")],
    )
    booked = booked.unionByName(carried.filter("n_leaves is not null"))
    booked = booked.groupBy("conv_id", "depth").agg(*sums)
    rows = members.join(booked, ["conv_id", "depth"], "left")

    def compute(table: NodeTable, rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        found = {c: table.accumulate(table.scatter(rows[c])) for c in ("n_leaves", "saved_tokens")}
        keep = (found["n_leaves"] != 0) | (found["saved_tokens"] != 0)
        found |= {"a": table.a.view(np.int64), "b": table.b.view(np.int64)}
        return {c: x[keep] for c, x in found.items()}

    schema = "a bigint, b bigint, n_leaves bigint, saved_tokens bigint"
    local = by_shard(rows, shards, ["n_leaves", "saved_tokens"], compute, schema)
    return local.groupBy(F.struct("a", "b").alias("node")).agg(*sums)


def ends(members: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, some = None, None, False
        done: list[tuple[int, int, str]] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[], [], []]
            types = (pa.int64(), pa.int64(), pa.string())
            made = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, ["a", "b", "ends_sha256"])

        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            for s, e in zip([0, *cuts], [*cuts, len(a)], strict=True):
                if (a[s], b[s]) != current:
                    if current is not None:
                        done.append((int(current[0]), int(current[1]), digest.hexdigest()))
                    current, digest, some = (a[s], b[s]), hashlib.sha256(), False
                digest.update((b"," if some else b"") + ",".join(map(str, ids[s:e].tolist())).encode())
                some = True
            yield batch_of()
        if current is not None:
            done.append((int(current[0]), int(current[1]), digest.hexdigest()))
            yield batch_of()

    rows = members.filter("last").select("node.a", "node.b", "conv_id")
    found = (
        rows.repartition("a", "b")
        .sortWithinPartitions("a", "b", "conv_id")
        .mapInArrow(run, "a bigint, b bigint, ends_sha256 string")
    )
    return found.select(F.struct("a", "b").alias("node"), "ends_sha256")


def prefix_trie(turns: DataFrame, band: int = BAND, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row for each node of the trie of the rebuilt conversations of ``turns`` (conv_id, turn,
    role, text).

    Columns: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (n_convs - 1) times the code points of a node's last
    text) and ends_sha256 (of the ids of the conversations that end there).

    Turns go by turn (null first), rows with the same turn by role and text; repeated rows stay
    and are turns of their own. Null roles and texts are empty. Rows without conv_id belong to no
    conversation. A negative id's block is the one below it. Texts of any length are hashed in
    place. An empty table has no conversation, hence no root and no row. Other columns of ``turns``
    are not read.
    """
    members = materialize(memberships(turns, band), "members")
    shards = max(LEAST_SHARDS, -(-members.count() // shard_rows))
    nodes = materialize(node_table(members, shards), "nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    full = nodes.join(children.filter("node is not null"), "node", "left")
    full = full.join(subtree_sums(members, nodes, shards, band), "node", "left")
    full = full.join(ends(members), "node", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_children", "n_leaves", "saved_tokens")}
    full = full.withColumns(zero | {"ends_sha256": F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))})
    full = materialize(full, "full")
    parents = full.filter("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    # At most HUBS parents have more children than this.
    many = F.col("n_children") > max(1, full.count() // HUBS)
    hubs = F.broadcast(parents.filter(many).drop("n_children"))
    under_hub = full.join(hubs, "parent")
    others = full.join(hubs, "parent", "left_anti").join(parents.filter(~many).drop("n_children"), "parent", "left")
    return under_hub.unionByName(others).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
