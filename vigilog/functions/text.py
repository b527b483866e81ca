"""Text rendering of values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int) -> Column:
    """Fixed-point text. Exact ties go to the even digit, as in C and Python.

    ``format_string('%.2f')`` would round them up; a DecimalFormat pattern does not.
    """
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value, F.lit(pattern))


def moment(value: Column) -> Column:
    """``2024-01-29 00:00:00``, with microseconds only where there are any."""
    text = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.regexp_replace(text, r"\.000000$", "")


def shown(value: Column) -> Column:
    """True where a value is worth a line: neither NULL nor zero."""
    return F.coalesce(value != 0, F.lit(False))


def filled(value: Column) -> Column:
    """True where a text is worth a line: neither NULL nor empty."""
    return F.coalesce(value != "", F.lit(False))


def stable_id(*parts: Column) -> Column:
    """The same parts give the same id, so a rerun repeats its ids.

    Each part is preceded by its length (NULL has none), so different parts never join to
    the same text.
    """
    texts = [p.cast("string") for p in parts]
    sized = [F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.md5(F.concat_ws("|", *[F.coalesce(s, F.lit("~")) for s in sized]))


def constant_map(entries: dict[str, str], key: Column) -> Column:
    """Look ``key`` up in a handful of fixed entries."""
    pairs = [F.lit(item) for pair in entries.items() for item in pair]
    return F.create_map(*pairs)[key]
