"""Metric profiles: custom metrics per time window and slice, and their drift.

A profile has one row per granularity, window and slice. Slices are taken one dimension
at a time; the row of all rows together has a NULL ``slice_key``.

Metrics are built from parts that add up. The big scan is reduced once, to one row per
finest window and combination of slice values; granularities and slices are fanned out
only afterwards, on that small result. Exact percentiles take the same road with counts
per value bucket, and so do one's own metrics that are composed of sums, counts, minima and maxima. A
metric given as free SQL cannot be taken apart, so it is aggregated from the fanned-out rows
themselves.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.functions import times
from vigilog.operators.percentiles import Keep, exact_percentiles

GRANULARITIES = ("1 hour", "1 day")
PROFILE_KEYS = ["granularity", "window_start", "window_seconds", "slice_key", "slice_value"]


ADDITIVE = ("mean", "total", "maximum", "composed", "sketch")


@dataclass(frozen=True)
class Metric:
    """``kind`` says how ``source`` is aggregated.

    mean, total, maximum: an SQL expression per row. distinct: a column; percentile: an
    integer column and a ``fraction``. composed: SQL over named ``parts``, each a sum, count, min or
    max. sketch: a column whose distinct values are estimated. custom: any SQL aggregate expression.
    """

    name: str
    kind: str
    source: str
    type: str = "double"
    fraction: float | None = None
    parts: tuple[tuple[str, str, str], ...] = ()


#: What a sketch of distinct values costs and gives: 2**12 registers, a standard error of 1.6 %.
SKETCH_LG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG / 2)
_PART = re.compile(r"\s*(sum|count|min|max)\s*\((.*)\)\s*", re.DOTALL | re.IGNORECASE)


def mean(name: str, source: str) -> Metric:
    return Metric(name, "mean", source)


def total(name: str, source: str, type: str = "bigint") -> Metric:
    return Metric(name, "total", source, type)


def maximum(name: str, source: str, type: str = "double") -> Metric:
    return Metric(name, "maximum", source, type)


def distinct(name: str, column: str) -> Metric:
    return Metric(name, "distinct", column, "bigint")


def percentile(name: str, column: str, fraction: float) -> Metric:
    return Metric(name, "percentile", column, fraction=fraction)


def composed(name: str, definition: str, type: str = "double", **parts: str) -> Metric:
    """A metric of one's own that adds up: ``definition`` is SQL over the names of ``parts``, each of which
    is ``sum(…)``, ``count(…)``, ``min(…)`` or ``max(…)`` of an SQL expression per row.

    Rows are reduced to the parts once, before anything is fanned out, and states can be merged.
    """
    taken = []
    for part, text in parts.items():
        if not (found := _PART.fullmatch(text)):
            raise ValueError(f"part {part} of {name} is not a sum, count, min or max: {text}")
        taken.append((part, found[1].lower(), found[2]))
    return Metric(name, "composed", definition, type, parts=tuple(taken))


def distinct_sketch(name: str, column: str) -> Metric:
    """The number of distinct values, within ``SKETCH_ERROR`` (a standard error; few values are exact).

    A group keeps a sketch of bounded size instead of its values, and hours merge to days.
    """
    return Metric(name, "sketch", column, "bigint")


def custom(name: str, definition: str, type: str = "double") -> Metric:
    return Metric(name, "custom", definition, type)


def _of_kind(metrics: list[Metric], *kinds: str) -> list[Metric]:
    return [metric for metric in metrics if metric.kind in kinds]


def _fan_out(
    df: DataFrame, moment: str, granularities: tuple[str, ...], slices: list[str]
) -> DataFrame:
    """Each row once per granularity and per slice dimension (and once unsliced)."""
    periods = []
    for text in granularities:
        seconds = times.interval_seconds(text)
        periods.append(
            F.struct(
                F.lit(text).alias("granularity"),
                times.bucket_start(F.col(moment), seconds).alias("window_start"),
                F.lit(seconds).cast("bigint").alias("window_seconds"),
            )
        )
    nothing = F.lit(None).cast("string")
    dimensions = [F.struct(nothing.alias("slice_key"), nothing.alias("slice_value"))]
    for column in slices:
        dimensions.append(
            F.struct(
                F.lit(column).alias("slice_key"),
                F.col(column).cast("string").alias("slice_value"),
            )
        )
    return (
        df.withColumn("_period", F.explode(F.array(*periods)))
        .withColumn("_slice", F.explode(F.array(*dimensions)))
        .select("*", "_period.*", "_slice.*")
    )


def _parts(metric: Metric) -> list[Column]:
    if metric.kind == "composed":
        return [F.expr(f"{how}({text})").alias(_part_name(metric, part, how)) for part, how, text in metric.parts]
    value = F.expr(metric.source)
    if metric.kind == "mean":
        number = value.cast("double")
        return [
            F.sum(number).alias(f"{metric.name}__sum"),
            F.count(number).alias(f"{metric.name}__rows"),
        ]
    if metric.kind == "total":
        return [F.sum(value).alias(f"{metric.name}__sum")]
    if metric.kind == "sketch":
        return [F.hll_sketch_agg(metric.source, SKETCH_LG).alias(f"{metric.name}__sketch")]
    return [F.max(value).alias(f"{metric.name}__max")]


def _part_name(metric: Metric, part: str, how: str) -> str:
    return f"{metric.name}__{part}__{how}"


def _whole(metric: Metric) -> str:
    """The definition of a composed metric over what its parts add up to."""
    sums = {}
    for part, how, _ in metric.parts:
        again = "sum" if how == "count" else how
        sums[part] = f"{again}(`{_part_name(metric, part, how)}`)"
    names = re.compile(r"\b(" + "|".join(map(re.escape, sums)) + r")\b")
    return names.sub(lambda found: sums[found[1]], metric.source)


def _combined(metric: Metric) -> Column:
    if metric.kind == "composed":
        value = F.expr(_whole(metric))
    elif metric.kind == "sketch":
        value = F.hll_sketch_estimate(F.hll_union_agg(f"{metric.name}__sketch"))
    elif metric.kind == "mean":
        value = F.try_divide(F.sum(f"{metric.name}__sum"), F.sum(f"{metric.name}__rows"))
    elif metric.kind == "total":
        value = F.sum(f"{metric.name}__sum")
    elif metric.kind == "maximum":
        value = F.max(f"{metric.name}__max")
    else:
        value = F.count_distinct(F.col(f"{metric.name}__value"))
    return value.cast(metric.type).alias(metric.name)


def _finest(granularities: tuple[str, ...]) -> int:
    finest = 0
    for text in granularities:
        finest = gcd(finest, times.interval_seconds(text))
    return finest


def _measured_columns(metrics: list[Metric]) -> dict[str, dict[str, float]]:
    """Column → names and fractions of its percentiles."""
    by_column: dict[str, dict[str, float]] = {}
    for metric in _of_kind(metrics, "percentile"):
        by_column.setdefault(metric.source, {})[metric.name] = metric.fraction
    return by_column


def _base_keys(metrics: list[Metric], slices: list[str]) -> list[str]:
    return ["_moment", *slices, *[f"{m.name}__value" for m in _of_kind(metrics, "distinct")]]


def _base(rows: DataFrame, metrics: list[Metric], slices: list[str]) -> DataFrame:
    """One row for each finest window, combination of slices and value that is counted once."""
    values = {f"{m.name}__value": F.col(m.source) for m in _of_kind(metrics, "distinct")}
    parts = [p for m in _of_kind(metrics, *ADDITIVE) for p in _parts(m)]
    keyed = [F.col(c) for c in ["_moment", *slices]] + [v.alias(n) for n, v in values.items()]
    return rows.groupBy(*keyed).agg(F.count(F.lit(1)).alias("row_count"), *parts)


def _from_parts(
    base: DataFrame,
    cells: dict[str, DataFrame],
    weight: str | None,
    metrics: list[Metric],
    slices: list[str],
    granularities: tuple[str, ...],
    keep: Keep | None = None,
) -> DataFrame:
    """Profile rows from base rows and the measured cells of each percentile's column."""
    result = (
        _fan_out(base, "_moment", granularities, slices)
        .groupBy(*PROFILE_KEYS)
        .agg(
            F.sum("row_count").alias("row_count"),
            *[_combined(metric) for metric in _of_kind(metrics, *ADDITIVE, "distinct")],
        )
    )
    for column, fractions in _measured_columns(metrics).items():
        measured = exact_percentiles(
            cells[column],
            ["_moment", *slices],
            "_measured",
            fractions,
            spread=lambda counts: _fan_out(counts, "_moment", granularities, slices),
            groups=PROFILE_KEYS,
            weight=weight,
            keep=keep,
        )
        result = _attach(result, measured, list(fractions))
    return result


def profile(
    df: DataFrame,
    time_column: str,
    metrics: list[Metric],
    slices: list[str],
    granularities: tuple[str, ...] = GRANULARITIES,
) -> DataFrame:
    """One row per granularity, window and slice with ``row_count`` and the metrics."""
    period = times.bucket_start(F.col(time_column), _finest(granularities)).alias("_moment")
    rows = df.filter(F.col(time_column).isNotNull())
    dated = rows.withColumn("_moment", period)
    cells = {
        column: dated.select("_moment", *slices, F.col(column).alias("_measured"))
        for column in _measured_columns(metrics)
    }
    base = _base(dated, metrics, slices)
    result = _from_parts(base, cells, None, metrics, slices, granularities)

    free = _of_kind(metrics, "custom")
    if free:
        measured = (
            _fan_out(rows, time_column, granularities, slices)
            .groupBy(*PROFILE_KEYS)
            .agg(*[F.expr(m.source).cast(m.type).alias(m.name) for m in free])
        )
        result = _attach(result, measured, [m.name for m in free])

    return _shaped(result, metrics)


def _shaped(result: DataFrame, metrics: list[Metric]) -> DataFrame:
    window = F.struct(
        F.col("window_start").alias("start"),
        F.timestamp_seconds(F.unix_timestamp("window_start") + F.col("window_seconds")).alias(
            "end"
        ),
    )
    return result.select(
        "granularity",
        window.alias("window"),
        "slice_key",
        "slice_value",
        "row_count",
        *[metric.name for metric in metrics],
    )


# --- state that can be merged -------------------------------------------------------

#: Column of a state that says what a row holds: base rows, or counts of a column's values.
KIND, BASE = "_kind", "base"


def profile_state(
    df: DataFrame,
    time_column: str,
    metrics: list[Metric],
    slices: list[str],
    granularities: tuple[str, ...] = GRANULARITIES,
) -> DataFrame:
    """What has to be kept of rows so that their profile can be made later, with that of others.

    Base rows hold sums, counts, maxima and the values that are counted once; the rest are counts of
    the distinct values that percentiles need. All of it adds up: see ``merged_state``.
    A custom metric can't be taken apart and is refused.
    """
    if free := [m.name for m in _of_kind(metrics, "custom")]:
        raise ValueError(f"custom metrics have no state: {free}")
    period = times.bucket_start(F.col(time_column), _finest(granularities))
    dated = df.filter(F.col(time_column).isNotNull()).withColumn("_moment", period)
    state = _base(dated, metrics, slices).withColumn(KIND, F.lit(BASE))
    for column in _measured_columns(metrics):
        values = (
            dated.filter(F.col(column).isNotNull())
            .groupBy("_moment", *slices, F.col(column).cast("bigint").alias("_measured"))
            .agg(F.count(F.lit(1)).alias("_rows"))
        )
        state = state.unionByName(values.withColumn(KIND, F.lit(column)), allowMissingColumns=True)
    return state


def merged_state(states: DataFrame, metrics: list[Metric], slices: list[str]) -> DataFrame:
    """The state of all rows together from several states' rows (equal keys become one row)."""
    keys = {KIND, "_measured", *_base_keys(metrics, slices)} & set(states.columns)
    ordered = [c for c in states.columns if c in keys]
    parts = [c for c in states.columns if c not in keys]
    again = {"max": F.max, "min": F.min, "sketch": F.hll_union_agg}
    return states.groupBy(*ordered).agg(
        *[again.get(c.rpartition("__")[2], F.sum)(c).alias(c) for c in parts]
    )


def profile_from_state(
    state: DataFrame,
    metrics: list[Metric],
    slices: list[str],
    granularities: tuple[str, ...] = GRANULARITIES,
    keep: Keep | None = None,
) -> DataFrame:
    """The same rows as ``profile`` of the rows that the state is made from.

    ``keep`` stores what the percentiles need between their passes, see ``exact_percentiles``.
    """
    base = state.filter(F.col(KIND) == BASE)
    cells = {
        column: state.filter(F.col(KIND) == column).select("_moment", *slices, "_measured", "_rows")
        for column in _measured_columns(metrics)
    }
    result = _from_parts(base, cells, "_rows", metrics, slices, granularities, keep)
    return _shaped(result, metrics)


def _attach(result: DataFrame, measured: DataFrame, names: list[str]) -> DataFrame:
    """Add columns by profile key; slice keys and values may be NULL."""
    left, right = result.alias("l"), measured.alias("r")
    same = F.lit(True)
    for key in PROFILE_KEYS:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return left.join(right, same, "left").select("l.*", *[F.col(f"r.{name}") for name in names])


def drift(profile_rows: DataFrame, metrics: list[Metric]) -> DataFrame:
    """Change of every metric against the previous window of the same slice.

    The window function sees one row per period of a slice, never raw rows.
    """
    names = [metric.name for metric in metrics]
    order = Window.partitionBy("granularity", "slice_key", "slice_value").orderBy("window.start")
    shifted = profile_rows.select(
        "granularity",
        "window",
        F.lag("window").over(order).alias("window_cmp"),
        "slice_key",
        "slice_value",
        *[
            F.struct(
                F.col(name).cast("double").alias("value"),
                F.lag(F.col(name).cast("double")).over(order).alias("previous_value"),
            ).alias(name)
            for name in names
        ],
    )
    long = shifted.filter(F.col("window_cmp").isNotNull()).unpivot(
        ["granularity", "window", "window_cmp", "slice_key", "slice_value"],
        names,
        "metric_name",
        "pair",
    )
    change = F.col("pair.value") - F.col("pair.previous_value")
    return long.select(
        "granularity",
        "window",
        "window_cmp",
        "slice_key",
        "slice_value",
        "metric_name",
        F.col("pair.value").alias("value"),
        F.col("pair.previous_value").alias("previous_value"),
        change.alias("absolute_change"),
        F.try_divide(change, F.col("pair.previous_value")).alias("relative_change"),
    )
