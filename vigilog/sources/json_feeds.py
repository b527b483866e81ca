"""JSON-lines feeds: declared schemas, permissive parsing, bad lines kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilog.schemas import CORRUPT, RAW_SCHEMAS, with_corrupt

#: Fields that the declared schema does not know.
RESCUED = "rescued"


def read_feed(spark: SparkSession, family: str, path: str) -> DataFrame:
    """Batch read of a feed directory."""
    return (
        spark.read.schema(with_corrupt(RAW_SCHEMAS[family]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def stream_feed(
    spark: SparkSession, family: str, path: str, max_files: int = 10, rescue: bool = False
) -> DataFrame:
    """The same feed as a stream, at most ``max_files`` new files per micro-batch.

    With ``rescue`` fields that the declared schema does not know are kept, see ``unknown_fields``.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if rescue:
        return parse_lines(reader.text(path), family, F.col("value"), rescue=True)
    return (
        reader.schema(with_corrupt(RAW_SCHEMAS[family]))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def parse_lines(df: DataFrame, family: str, line: Column, rescue: bool = False) -> DataFrame:
    """Parse JSON text held in a column exactly as the file source would.

    ``inline`` puts the parsed record behind a generator. A filter on one of its fields
    stays above it; through a plain projection it would be pushed down together with a
    second copy of the parser.
    """
    parsed = F.from_json(
        line,
        with_corrupt(RAW_SCHEMAS[family]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    if rescue:
        return df.select(unknown_fields(line, family).alias(RESCUED), F.inline(F.array(parsed)))
    return df.select(F.inline(F.array(parsed)))


def unknown_fields(line: Column, family: str) -> Column:
    """The fields of a record and of its message that the declared schema does not have: a map from
    ``name`` or ``message.name`` to the value, objects and arrays as JSON text. Null if there are none.
    """
    declared = RAW_SCHEMAS[family]
    message = declared["message"].dataType
    record = F.from_json(line, "map<string,string>")
    inner = F.from_json(F.try_element_at(record, F.lit("message")), "map<string,string>")

    def others(fields: Column, known: list[str]) -> Column:
        left = F.map_filter(fields, lambda name, _: ~name.isin(known))
        return F.coalesce(left, F.create_map().cast("map<string,string>"))

    inside = F.transform_keys(
        others(inner, message.fieldNames()), lambda name, _: F.concat(F.lit("message."), name)
    )
    # A record may spell a name of the message out; the message's own field goes first.
    outside = F.map_filter(
        others(record, declared.fieldNames()), lambda name, _: ~F.map_contains_key(inside, name)
    )
    found = F.map_concat(outside, inside)
    return F.when(F.size(found) > 0, found)


def is_corrupt_line(family: str) -> Column:
    """True for a line of which nothing could be read.

    A record with a single bad field also fills the corrupt column, but its other fields
    are there and it stays an ordinary row.
    """
    corrupt = F.col(CORRUPT).isNotNull()
    for name in RAW_SCHEMAS[family].fieldNames():
        corrupt = corrupt & F.col(f"`{name}`").isNull()
    return corrupt


def split_corrupt(df: DataFrame, family: str) -> tuple[DataFrame, DataFrame]:
    """(rows, lines that could not be read, as text)."""
    corrupt = is_corrupt_line(family)
    return df.filter(~corrupt), df.filter(corrupt).select(F.col(CORRUPT).alias("line"))


def write_feed(df: DataFrame, path: str) -> None:
    """Append a batch as JSON lines; every call adds new files, none is replaced."""
    df.write.mode("append").json(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Append a single text column as it is, one line per row."""
    df.write.mode("append").text(path)
