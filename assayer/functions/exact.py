"""Sums of doubles that are exact whatever their sizes and order.

A value goes to a bin of sixteen powers of two, and its digits there to four whole numbers, which
add up as BIGINT without loss. The sums of all bins make a double once, at the end, correctly
rounded: as ``math.fsum``, but over any partitioning.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import is_finite

#: Powers of two of a bin, and bits of each whole number but the highest, which has the sign. A
#: part is below 2**21, so sums have room for 2**42 rows.
BIN_BITS = 16
PART_BITS = 21
PARTS = 4


def _scaled(x: Column, power: Column) -> Column:
    """``x * 2**power`` in two steps, since a double holds no power beyond 1023."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def exact_bin(x: Column) -> Column:
    """The bin of a finite double; a value next to a border may go to either side."""
    size = F.when(x != 0, F.log2(F.abs(x)))
    return F.coalesce(F.floor(size / BIN_BITS), F.lit(0)).cast("int")


def exact_parts(x: Column, own_bin: Column) -> list[Column]:
    """The digits of a finite double in its bin, lowest first."""
    rest = _scaled(x, -BIN_BITS * own_bin)
    parts = []
    for _ in range(PARTS - 1):
        whole = F.floor(rest)
        parts.append(whole)
        rest = (rest - whole) * float(1 << PART_BITS)
    return [F.floor(rest), *parts[::-1]]


def exact_total(bins: Column) -> Column:
    """The sum of an array of ``struct(bin, part_0, ..., part_3)``, rounded once."""

    def doubles(one: Column) -> Column:
        found = []
        for i in range(PARTS):
            power = BIN_BITS * one["bin"] - PART_BITS * (PARTS - 1 - i)
            # Truncated, so that neither is larger than the part.
            high = F.call_function("div", one[f"part_{i}"], F.lit(1 << 32))
            low = one[f"part_{i}"] - high * F.lit(1 << 32)
            found += [_scaled(low.cast("double"), power), _scaled(high.cast("double"), power + 32)]
        return F.array(*found)

    def two_sum(a: Column, b: Column) -> tuple[Column, Column]:
        total = a + b
        other = total - a
        return total, (a - (total - other)) + (b - other)

    def grow(partials: Column, x: Column) -> Column:
        """Doubles that do not overlap, with ``x`` added to them."""

        def step(state: Column, y: Column) -> Column:
            total, lost = two_sum(state["sum"], y)
            kept = F.when(lost != 0, F.concat(state["kept"], F.array(lost))).otherwise(state["kept"])
            return F.struct(total.alias("sum"), kept.alias("kept"))

        start = F.struct(x.alias("sum"), F.expr("array()").cast("array<double>").alias("kept"))
        return F.aggregate(
            partials, start, step, lambda s: F.concat(s["kept"], F.array(s["sum"]))
        )

    partials = F.aggregate(
        F.flatten(F.transform(bins, doubles)), F.array(F.lit(0.0)), grow
    )

    def down(state: Column, y: Column) -> Column:
        """From the largest on until something is lost; then the sign of what follows."""
        total, lost = two_sum(state["sum"], y)
        going = state["lost"] == 0
        return F.struct(
            F.when(going, total).otherwise(state["sum"]).alias("sum"),
            F.when(going, lost).otherwise(state["lost"]).alias("lost"),
            F.when(~going & (state["next"] == 0), y).otherwise(state["next"]).alias("next"),
        )

    def rounded(state: Column) -> Column:
        # Exactly between two doubles: what follows decides, not the even digit.
        twice = state["lost"] * 2
        moved = state["sum"] + twice
        past = (F.signum(state["lost"]) == F.signum(state["next"])) & (state["lost"] != 0)
        return F.when(past & (moved - state["sum"] == twice), moved).otherwise(state["sum"])

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0.0).alias("lost"), F.lit(0.0).alias("next"))
    return F.aggregate(F.reverse(partials), start, down, rounded)


def exact_total_of(name: str) -> Column:
    """``exact_total`` of a column by name. The expression takes half a second to put together, so
    it is kept for the session's JVM."""
    return _total_of(name, id(SparkContext._gateway))


@functools.cache
def _total_of(name: str, gateway: int) -> Column:
    return exact_total(F.col(name))


def part_sums(parts: Sequence[Column], name: str) -> list[Column]:
    return [F.sum(part).alias(f"{name}_{i}") for i, part in enumerate(parts)]


def exact_sums(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and ``total``, the exact sum of a column of doubles, rounded once.

    Nulls do not count; without any value the total is 0. NaN gives NaN, an infinity itself, and
    both infinities NaN. A group has at most some 135 bins, however many rows.
    """
    x = F.col(value).cast("double")
    rows = df.select(*by, x.alias("__x")).withColumn("__bin", F.when(is_finite(F.col("__x")), exact_bin(F.col("__x"))))
    finite = F.when(F.col("__bin").isNotNull(), F.col("__x"))
    parts = exact_parts(finite, F.col("__bin"))
    special = F.sum(F.when(~is_finite(F.col("__x")), F.col("__x"))).alias("__special")
    bins = rows.groupBy(*by, "__bin").agg(*part_sums(parts, "part"), special)
    one = F.struct(F.col("__bin").alias("bin"), *[f"part_{i}" for i in range(PARTS)])
    found = bins.groupBy(*by).agg(
        F.collect_list(F.when(F.col("__bin").isNotNull(), one)).alias("__bins"),
        F.sum("__special").alias("__special"),
    )
    return found.select(*by, F.coalesce("__special", exact_total_of("__bins")).alias("total"))
