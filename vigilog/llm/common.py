"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence, Sized

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that the operators strip or split at, [\x20\x09-\x0D].
WHITE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Texts that a task works on at once; bounds its temporary arrays, not its results.
SLICE_CHARS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def hash128(*columns: Column) -> Column:
    """Two independent 64-bit hashes as one key, wide enough for the lines of any corpus."""
    return F.struct(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("b"), *columns).alias("b")
    )


def slices(texts: Sequence[Sized], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts (or arrays) of about ``most`` elements, at least one text."""
    start = held = 0
    for n, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, n
            start, held = n, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str]], dict[str, object]]],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Replace the column ``text`` by columns computed from it in Arrow batches.

    ``make()`` runs once per task and returns a function from texts (null is the empty text)
    to lists or arrays by column name. The other columns pass through unchanged.
    """
    kept = [c for c in df.columns if c != text]
    out = df.select(*kept, text).schema
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out if f.name != text]
    added = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        compute = make()
        types = {f.name: to_arrow_type(f.dataType) for f in added}
        for batch in batches:
            texts = [x or "" for x in batch.column(text).to_pylist()]
            for start, end in slices(texts):
                found = compute(texts[start:end])
                columns = [batch.column(c).slice(start, end - start) for c in kept]
                columns += [pa.array(found[c], types[c]) for c in types]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *types])

    return df.select(*kept, text).mapInArrow(run, ", ".join([*fields, schema]))
