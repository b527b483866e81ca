"""Exact interpolated percentiles in two passes, without gathering any group.

The built-in ``percentile`` keeps every distinct value of a group in the memory of one
task, and ordering the values would shuffle all of them. Instead:

1. The first pass counts equal values, and from that rows per value bucket. Buckets are few whatever the number of
   rows, and partial counts leave each task before the shuffle. Running totals over the
   buckets of a group tell which bucket holds the wanted ranks.
2. The second pass looks at the values again but keeps only those in these buckets, a
   small share of them, orders each bucket and reads off the two neighbours of the wanted
   position.

Rows may be counted in fine cells that are later spread over many groups (hours into days
and slices). Then only the counts are spread; each row is matched once with the groups
that need its bucket.

Nothing runs while the plan is built, and adaptive execution chooses the joins. A caller that runs
jobs anyway may have the intermediate results written once (``keep``): without it the plan holds the
plan of the values six times, and the driver keeps all of it with every step of adaptive execution.
A task orders the
distinct values of one narrowed bucket of one group: all there are below 2^7, 8192 for milliseconds up
to 17 minutes. A bucket of more than 2^13 values, around 2^20 and above, is cut into parts of half its
binary digits, of which only those with a wanted rank go on. So around 2^n a task orders at most
2^((n-6)/2) values or parts, rounded up: 2^22 around 2^50.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Leading binary digits that name a bucket: a value below 2^7 has a bucket of its own, one
# below 2^20 (17 minutes in milliseconds) shares it with at most 8191 other values.
BUCKET_DIGITS = 7
#: Stores a result under a name and reads it back.
Keep = Callable[[DataFrame, str], DataFrame]
#: Buckets of more binary digits than these are narrowed before their values are ordered.
ORDERED_DIGITS = 13


def with_bucket(df: DataFrame) -> DataFrame:
    """Adds ``bucket``: the lower bound of the bucket of ``value``.

    The leading digits are kept and the others zeroed. It works for negative values too:
    the shift rounds down, and ``~v`` is ``-v - 1``. The logarithm of a large number may
    be off by one, so the exponent is corrected by comparing whole numbers.
    """
    guess = "CAST(least(floor(log2(magnitude)), 62) AS INT)"
    correction = """CASE WHEN shiftleft(1L, guess) > magnitude THEN -1
        WHEN guess < 62 AND shiftleft(1L, guess + 1) <= magnitude THEN 1 ELSE 0 END"""
    return (
        df.withColumn("magnitude", F.greatest("value", F.bitwise_not("value"), F.lit(1)))
        .withColumn("guess", F.expr(guess))
        .withColumn(
            "dropped",
            F.expr(f"greatest(guess + {correction} - {BUCKET_DIGITS - 1}, 0)"),
        )
        .withColumn("bucket", F.expr("shiftleft(shiftright(value, dropped), dropped)"))
        .drop("magnitude", "guess", "dropped")
    )


def with_part(df: DataFrame) -> DataFrame:
    """Adds ``part``: the lower bound of the part of its bucket that ``value`` is in.

    A part has half the bucket's open binary digits, rounded up; narrow buckets are one part.
    """
    # The bounds of a bucket have as many digits as its values.
    width = f"length(bin(greatest(bucket, ~bucket, 1L))) - {BUCKET_DIGITS}"
    digits = f"IF({width} > {ORDERED_DIGITS}, shiftright({width} + 1, 1), {ORDERED_DIGITS})"
    return (
        df.withColumn("digits", F.expr(digits))
        .withColumn("part", F.expr("bucket + shiftleft(shiftright(value - bucket, digits), digits)"))
        .drop("digits")
    )


def _same(keys: list[str], left: str, right: str) -> Column:
    """Keys may be NULL, hence the null-safe comparison of every one."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def _position(fraction: float) -> Column:
    return (F.col("value_count") - 1) * F.lit(fraction)


def _holds(rank: Column, before: str, rows: str) -> Column:
    return (F.col(before) <= rank) & (rank < F.col(before) + F.col(rows))


def _wanted_buckets(
    cells: DataFrame, groups: list[str], fractions: dict[str, float]
) -> DataFrame:
    """The buckets that hold a wanted rank, with the number of rows in earlier ones."""
    group = Window.partitionBy(*groups)
    earlier = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    histogram = (
        cells.groupBy(*groups, "bucket")
        .agg(F.sum("rows").alias("bucket_rows"), F.sum("total").alias("bucket_total"))
        .select(
            *groups,
            "bucket",
            "bucket_rows",
            F.coalesce(F.sum("bucket_rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("bucket_rows").over(group).alias("value_count"),
            (F.sum("bucket_total").over(group) / F.sum("bucket_rows").over(group)).alias(
                "value_mean"
            ),
        )
    )
    return histogram.filter(_holds_any(fractions)).drop("bucket_rows")


def _holds_any(fractions: dict[str, float]) -> Column:
    wanted = F.lit(False)
    for fraction in fractions.values():
        for rank in (F.floor(_position(fraction)), F.ceil(_position(fraction))):
            wanted = wanted | _holds(rank, "rows_before", "bucket_rows")
    return wanted


def _narrowed(kept: DataFrame, names: list[str], fractions: dict[str, float]) -> DataFrame:
    """The values in the parts of their buckets that hold a wanted rank, with the rows before a part."""
    parted = with_part(kept)
    earlier = (
        Window.partitionBy(*names, "bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = (
        parted.groupBy(*names, "bucket", "part")
        .agg(
            F.sum("rows").alias("bucket_rows"),
            F.max("rows_before").alias("rows_before"),
            F.max("value_count").alias("value_count"),
        )
        .withColumn("rows_before", F.col("rows_before") + F.coalesce(F.sum("bucket_rows").over(earlier), F.lit(0)))
        .filter(_holds_any(fractions))
    )
    return (
        parted.alias("v")
        .join(parts.alias("p"), _same([*names, "part"], "v", "p"))
        .select(
            *[F.col(f"v.{c}") for c in [*names, "part", "value", "rows", "value_count", "value_mean"]],
            "p.rows_before",
        )
    )


def exact_percentiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    fractions: dict[str, float],
    spread: Callable[[DataFrame], DataFrame] | None = None,
    groups: list[str] | None = None,
    weight: str | None = None,
    keep: Keep | None = None,
) -> DataFrame:
    """Per group: ``value_count``, ``value_mean`` and one column per named fraction.

    ``value`` is an integer column; NULLs do not count. A row stands for as many as its column
    ``weight`` says, where one is named. Groups are the ``keys``, unless
    ``spread`` turns a row with the keys into one row per group, with columns ``groups``.
    ``keep`` stores a named intermediate result and reads it back.
    """
    groups, keep = groups or keys, keep or (lambda rows, _: rows)
    rows = with_bucket(
        df.filter(F.col(value).isNotNull()).select(
            *keys,
            F.col(value).cast("bigint").alias("value"),
            (F.lit(1) if weight is None else F.col(weight)).alias("weight"),
        )
    )
    # Equal values are counted once, before anything is shuffled or joined. Both passes read
    # this one exchange.
    number = F.count(F.lit(1)) if weight is None else F.sum("weight")
    counted = keep(rows.groupBy(*keys, "bucket", "value").agg(number.alias("rows")), "counted-values")
    cells = counted.groupBy(*keys, "bucket").agg(
        F.sum(F.col("value").cast("double") * F.col("rows")).alias("total"),
        F.sum("rows").alias("rows"),
    )
    facts = ["rows_before", "value_count", "value_mean"]
    if spread is None:
        wanted = _wanted_buckets(cells, keys, fractions)
        named = {key: key for key in keys}
    else:
        fanned = spread(cells)
        targets = _wanted_buckets(fanned, groups, fractions)
        # Group columns get names of their own; cells and groups may share some.
        named = {key: f"group_{key}" for key in groups}
        wanted = (
            fanned.alias("c")
            .join(targets.alias("g"), _same([*groups, "bucket"], "c", "g"))
            .select(
                *[F.col(f"c.{key}").alias(key) for key in [*keys, "bucket"]],
                *[F.col(f"g.{key}").alias(name) for key, name in named.items()],
                *facts,
            )
        )

    wanted = keep(wanted, "wanted-buckets")
    names = list(named.values())
    extra = [name for name in names if name not in keys]
    kept = (
        counted.alias("r")
        .join(wanted.alias("w"), _same([*keys, "bucket"], "r", "w"))
        .select("r.*", *[F.col(f"w.{name}") for name in [*extra, *facts]])
        .groupBy(*names, "bucket", "value")
        .agg(F.sum("rows").alias("rows"), *[F.max(fact).alias(fact) for fact in facts])
    )
    kept = _narrowed(keep(kept, "kept-values"), names, fractions)
    smaller = (
        Window.partitionBy(*names, "part")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = kept.withColumn(
        "before", F.col("rows_before") + F.coalesce(F.sum("rows").over(smaller), F.lit(0))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(_holds(rank, "before", "rows"), F.col("value"))).cast("double")

    picks = []
    for name, fraction in fractions.items():
        picks.append(at(F.floor(_position(fraction))).alias(f"{name}_low"))
        picks.append(at(F.ceil(_position(fraction))).alias(f"{name}_high"))
    picked = ranked.groupBy(*names).agg(
        F.max("value_count").alias("value_count"), F.max("value_mean").alias("value_mean"), *picks
    )

    results = []
    for name, fraction in fractions.items():
        place = _position(fraction)
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    return picked.select(
        *[F.col(name).alias(key) for key, name in named.items()],
        "value_count",
        "value_mean",
        *results,
    )


def approximate_percentiles(
    df: DataFrame, keys: list[str], value: str, fractions: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """One pass with a bounded sketch per group; the values are not exact."""
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("value_count"),
            F.avg(value).alias("value_mean"),
            *[
                F.percentile_approx(value, fraction, accuracy).cast("double").alias(name)
                for name, fraction in fractions.items()
            ],
        )
    )
