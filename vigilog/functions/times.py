"""Instants, closed ranges and epoch-aligned buckets."""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilog.config import Span, utc

# Shapes of the timestamps that the feeds write, with three and four digits of
# a second. The zone is part of them, so the session's own zone cannot shift the instant.
OFFSET_SHAPE = r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3})([+-]\d\d)(\d\d)$"
ZULU_SHAPE = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{4}(Z|[+-]\d\d(\d\d)?)$"

# Milliseconds of 0001-01-01 and 9999-12-31, the range of a timestamp.
MIN_MILLIS = -62_135_596_800_000
MAX_MILLIS = 253_402_300_799_999


def instant(when: datetime, zoneless: bool = False) -> Column:
    """A literal that has the type of the column it is compared with.

    A comparison across the two timestamp types would wrap the column in a cast and
    keep the filter out of the Parquet scan.
    """
    if zoneless:
        return F.lit(utc(when).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return F.lit(utc(when))


def is_zoneless(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def within(df: DataFrame, column: str, span: Span) -> Column:
    zoneless = is_zoneless(df, column)
    return F.col(column).between(instant(span.start, zoneless), instant(span.end, zoneless))


def prune_dates(df: DataFrame, date_column: str, spans: list[Span]) -> DataFrame:
    """Add a partition filter where the table is partitioned by date.

    One day of slack on both sides keeps it a pure optimisation in every session zone.
    """
    if date_column not in df.columns:
        return df
    keep = F.lit(False)
    for span in spans:
        low = (utc(span.start) - timedelta(days=1)).date()
        high = (utc(span.end) + timedelta(days=1)).date()
        keep = keep | F.col(date_column).between(F.lit(low), F.lit(high))
    return df.filter(keep)


def in_any(df: DataFrame, column: str, spans: list[Span], date_column: str) -> DataFrame:
    """Rows inside at least one closed range."""
    keep = within(df, column, spans[0])
    for span in spans[1:]:
        keep = keep | within(df, column, span)
    return prune_dates(df, date_column, spans).filter(keep)


def utc_date(df: DataFrame, column: str) -> Column:
    """The calendar day in UTC, whatever the session's zone is."""
    if is_zoneless(df, column):
        return F.to_date(column)
    return utc_day(F.col(column))


def utc_day(moment: Column) -> Column:
    """The calendar day in UTC of a column that is an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / 86_400).cast("int"))


def _iso(text: Column, shape: str) -> Column:
    """Texts of a shape by the native ISO parser, which is several times as fast as a pattern.

    A cast reads offsets with a colon only, so ``+0000`` and ``+00`` are completed first.
    """
    with_colon = F.regexp_replace(text, r"([+-]\d\d)(\d\d)$", "$1:$2")
    with_minutes = F.regexp_replace(with_colon, r"(\.\d+[+-]\d\d)$", "$1:00")
    whole = F.when(text.endswith("Z"), text).otherwise(with_minutes)
    return F.when(text.rlike(shape), whole.try_cast("timestamp"))


def parse_zulu(text: Column) -> Column:
    return _iso(text, ZULU_SHAPE)


def parse_offset(text: Column) -> Column:
    return _iso(text, OFFSET_SHAPE)


def epoch_millis(millis: Column) -> Column:
    """Whole seconds of an epoch in milliseconds; NULL outside the calendar's range."""
    seconds = F.when(
        millis.between(MIN_MILLIS, MAX_MILLIS), F.call_function("div", millis, F.lit(1000))
    )
    return F.timestamp_seconds(seconds)


_UNIT_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(text: str) -> int:
    """``1 hour`` → 3600."""
    match = re.fullmatch(r"\s*(\d+)\s+(minute|hour|day)s?\s*", text)
    if not match:
        raise ValueError(f"not a whole number of minutes, hours or days: {text!r}")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)]


def bucket(moment: Column, seconds: int) -> Column:
    """Number of the epoch-aligned bucket that holds ``moment``."""
    return F.floor(F.unix_timestamp(moment) / F.lit(seconds))


def bucket_start(moment: Column, seconds: int) -> Column:
    return F.timestamp_seconds(bucket(moment, seconds) * F.lit(seconds))
