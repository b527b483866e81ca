"""Main text of web pages by differencing each page with its nearest by URL.

Pages are put in order of host and URL path, so a page's neighbours are those of its host with the
nearest paths. Each page's lines are aligned with both neighbours' by a longest common subsequence.
A line that a page shares with a neighbour comes from the site's template and is deleted.

Differencing alone can't give right results where neighbours hold the same article, or where a
site's menus and adverts change from page to page. So markup decides first where it says something:
lines inside ``article`` or ``main`` are main text, shared or not; lines of menus, headers, footers,
sidebars, notices, adverts, forms and reader comments are not, even if no neighbour has them; and
where a page has an article, nothing outside it is main text. All other lines are decided by
differencing. Pages of a host with exactly the same lines are copies: they count as one page, which
stands at the first one's place, and all get its text.

Order without gathering a host: a hash picks pages as block starts (a number bounded by
``MOST_BLOCKS`` whatever the size of the corpus), so blocks cut through large hosts, and the first
and last page of each block are lent to the block beside. As copies are one page before blocks are
formed, a page's neighbours are the same wherever blocks begin. Tasks stream over sorted blocks and
hold two pages at a time. Pages whose markup decides every line are aligned only with others' open
lines.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm.common import hash128, slices, text_of
from vigilog.llm.html_lines import MAIN, OPEN, common, page_lines
from vigilog.llm.url_filter import host_of, path_of
from vigilog.session import materialize

BLOCK_ROWS = 64
LEAST_BLOCKS = 256
MOST_BLOCKS = 100_000


def main_text(lines: list[tuple[str, str]], shared: set[int]) -> str:
    """The main lines' text; ``shared`` are the places of lines that a neighbour has too."""
    has_main = any(kind == MAIN for _, kind in lines)
    kept = (
        text
        for n, (text, kind) in enumerate(lines)
        if kind == MAIN or (kind == OPEN and not has_main and n not in shared)
    )
    return " ".join(kept)


def lines_of(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, place, alike, hashes, texts, kinds, text: the lines of each page, and a hash of them all.

    hashes has a 64-bit hash for each line, which is all that neighbours need. text is the main text
    where markup decides every line; texts and kinds of lines are there only where it does not.
    """
    rows = pages.select(
        *keys, text_of("html").alias("html"),
        F.struct(
            host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
            F.coalesce("url", F.lit("")).alias("url"), hash128(*[F.col(k) for k in keys])["a"].alias("a"),
            hash128(*[F.col(k) for k in keys])["b"].alias("b"),
        ).alias("place"),
    )
    kept = [*keys, "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_ = batch.column("html").to_pylist()
            for s, e in slices(pages_, 1 << 22):
                alike, hashes, texts, kinds, final = [], [], [], [], []
                for page in pages_[s:e]:
                    lines = page_lines(page)
                    open_ = is_open(lines)
                    alike.append(hashlib.sha256(repr(lines).encode("utf-8", "surrogatepass")).hexdigest())
                    hashes.append([line_hash(t) for t, _ in lines])
                    texts.append([t for t, _ in lines] if open_ else None)
                    kinds.append([k for _, k in lines] if open_ else None)
                    final.append(None if open_ else main_text(lines, set()))
                own = [batch.column(c).slice(s, e - s) for c in kept]
                many = pa.list_(pa.string())
                own += [pa.array(alike, pa.string()), pa.array(hashes, pa.list_(pa.int64()))]
                own += [pa.array(texts, many), pa.array(kinds, many), pa.array(final, pa.string())]
                yield pa.RecordBatch.from_arrays(own, [*kept, "alike", "hashes", "texts", "kinds", "text"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*kept).schema]
    added = ["alike string, hashes array<bigint>, texts array<string>, kinds array<string>, text string"]
    return rows.mapInArrow(run, ", ".join(fields + added))


def line_hash(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def is_open(lines: list[tuple[str, str]]) -> bool:
    """Whether differencing decides any of the lines."""
    kinds = {kind for _, kind in lines}
    return OPEN in kinds and MAIN not in kinds


def by_url(parsed: DataFrame) -> DataFrame:
    """(block, own, host, alike, hashes, texts, kinds): sorted blocks of unlike pages with those beside them."""
    # A page at a time for each host and its lines; repeated rows share a place.
    first = parsed.groupBy("place.host", "alike").agg(F.min("place").alias("place"))
    first = materialize(first.select("place", "alike"), "unlike")
    total = first.count()
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, total // BLOCK_ROWS))
    share = min(1.0, blocks / max(total, 1))
    chosen = first.filter(F.xxhash64("place") <= min(2**63 - 1, int(share * 2**64) - 2**63))
    starts = sorted({tuple(r.place) for r in chosen.select("place").collect()})

    @F.pandas_udf("int")
    def block_of(place: pd.DataFrame) -> pd.Series:
        found = zip(*(place[c] for c in ("host", "path", "url", "a", "b")), strict=True)
        return pd.Series([bisect.bisect_right(starts, x) for x in found], dtype="int32")

    rows = parsed.select("place", "alike", "hashes", "texts", "kinds").join(first, ["place", "alike"], "left_semi")
    placed = rows.withColumn("block", block_of("place"))
    ends = first.withColumn("block", block_of("place")).groupBy("block")
    ends = ends.agg(F.min("place").alias("first"), F.max("place").alias("last"))
    # One row a block, so at most MOST_BLOCKS + 1 rows are broadcast.
    bounded = placed.join(F.broadcast(ends), "block")
    own = F.struct("block", F.lit(True).alias("own"))
    to_before = F.struct((F.col("block") - 1).alias("block"), F.lit(False).alias("own"))
    to_after = F.struct((F.col("block") + 1).alias("block"), F.lit(False).alias("own"))
    copies = F.array_compact(
        F.array(
            own,
            F.when(F.col("place") == F.col("first"), to_before),
            F.when(F.col("place") == F.col("last"), to_after),
        )
    )
    return (
        bounded.withColumn("copy", F.explode(copies))
        .select("copy.*", "place", "alike", "hashes", "texts", "kinds")
        .repartition(max(1, blocks // 16), "block")
        .sortWithinPartitions("block", "place", "alike")
        .select("block", "own", F.col("place.host").alias("host"), "alike", "hashes", "texts", "kinds")
    )


def extract_main(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for each row of ``pages`` (page_id, url, html).

    Text is empty where nothing is left. Null html is an empty page; null urls have an empty host
    and path. Rows with the same place in the order are ordered by a hash of page_id and url;
    repeated rows are copies, and all get a row. An empty table gives an empty result. Other columns of
    ``pages`` are not read.
    """
    keys = ["page_id", "url"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The page that waits for the next: [block, host, own, alike, hashes, lines if open, shared]
        waiting = None
        done: list[tuple] = []

        def finish(page) -> None:
            if page is not None and page[2] and page[5] is not None:
                done.append((page[1], page[3], main_text(page[5], page[6])))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) if done else [[]] * 3
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "alike", "open_text"])
            done.clear()
            return made

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "host", "own", "alike", "hashes", "texts", "kinds"))
            for block, host, own, alike, hashes, texts, kinds in zip(*columns, strict=True):
                lines = None if texts is None else list(zip(texts, kinds, strict=True))
                shared = set()
                if waiting is not None and waiting[:2] == [block, host]:
                    if waiting[3] == alike:  # a repeated row
                        continue
                    if lines is not None or waiting[5] is not None:
                        pairs = common(waiting[4], hashes)
                        waiting[6].update(i for i, _ in pairs)
                        shared = {j for _, j in pairs}
                finish(waiting)
                waiting = [block, host, own, alike, hashes, lines, shared]
            yield batch_of()
        finish(waiting)
        if done:
            yield batch_of()

    parsed = materialize(lines_of(pages, keys), "lines")
    differenced = by_url(parsed).mapInArrow(run, "host string, alike string, open_text string")
    rest = parsed.filter("text is null").select(*keys, F.col("place.host").alias("host"), "alike")
    rest = rest.join(differenced, ["host", "alike"]).select(*keys, F.col("open_text").alias("text"))
    found = parsed.filter("text is not null").select(*keys, "text").unionByName(rest)
    return found.withColumn("n_chars", F.length("text").cast("long"))
