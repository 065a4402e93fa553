"""Sums of doubles that do not depend on the order of the rows.

A double is a whole number times a power of two. Values are split by exponent into stretches of 32 binary
places; within a stretch each value is two whole numbers, and whole numbers add up the same in any order. The stretches
of a group, a few dozen at most, are put together once, and rounded once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES = 32
# Stretches that doubles can fall in; bits below 2^-1052 are dropped.
LOWEST, HIGHEST = -31, 31
# A whole number counts units of 2^-60 of its stretch.
_HIGH, _LOW = 20, 40
_WHOLE = "decimal(38,0)"
_DIGIT = float(1 << PLACES)


def _stretch(value: Column) -> Column:
    return F.greatest(F.floor(F.log2(F.abs(value)) / PLACES), F.lit(LOWEST)).cast("int")


def _finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) < float("inf"))


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast(_WHOLE)


def _digits(parts: Column, sign: int) -> Column:
    """Digits of base 2^32 from the lowest stretch up, with what is carried out of the last one."""

    def add(state: Column, k: Column) -> Column:
        own = F.filter(parts, lambda p: p["stretch"] == k)
        total = (state["carry"] + F.coalesce(F.get(own, F.lit(0))["units"], _whole(0)) * _whole(sign)).cast(_WHOLE)
        digit = F.pmod(total, _whole(1 << PLACES)).cast(_WHOLE)
        carry = ((total - digit) / _whole(1 << PLACES)).cast(_WHOLE)
        return F.struct(carry.alias("carry"), F.array_append(state["digits"], digit).alias("digits"))

    start = F.struct(_whole(0).alias("carry"), F.array().cast(f"array<{_WHOLE}>").alias("digits"))
    return F.aggregate(F.sequence(F.lit(LOWEST), F.lit(HIGHEST + 4)), start, add)


def _value(digits: Column) -> Column:
    """The number that non-negative digits stand for, rounded once."""
    places = F.sequence(F.lit(1), F.size(digits))
    top = F.array_max(F.filter(places, lambda i: F.element_at(digits, i) != 0))
    at = lambda i: F.when(i >= 1, F.element_at(digits, F.greatest(i, F.lit(1)))).otherwise(_whole(0))
    lead = (at(top) * _whole(1 << 64) + at(top - 1) * _whole(1 << 32) + at(top - 2)).cast(_WHOLE)
    # 65 bits and one that says whether anything is below them decide the rounding.
    more = F.exists(F.slice(digits, 1, F.greatest(top - 3, F.lit(0))), lambda d: d != 0)
    lead = (lead * _whole(2) + F.when(more, _whole(1)).otherwise(_whole(0))).cast(_WHOLE)
    exponent = (top - 3 + LOWEST) * PLACES - (_HIGH + _LOW) - 1
    # In two steps, as the scale itself may be beyond a double.
    half = F.floor(exponent / 2)
    power = lambda e: F.pow(F.lit(2.0), e.cast("double"))
    return F.coalesce(lead.cast("double") * power(half) * power(exponent - half), F.lit(0.0))


def exact_sums(df: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """``(*by, out, ...)``: for each ``{out: column}`` the sum of a column, with the same bits in any partitioning.

    The sum is that of the exact values, rounded to the nearest double. Nulls do not count, a group without values
    has a null sum, and NaN or infinity among the values shows in the result. ``by`` may be empty.
    """
    outs = list(columns)
    values = df.select(*by, *[F.col(c).cast("double").alias(out) for out, c in columns.items()])
    long = values.unpivot(list(by), outs, "_out", "_v").filter("_v IS NOT NULL") if outs else values
    fine = _finite(F.col("_v"))
    stretch = F.when(fine & (F.col("_v") != 0), _stretch(F.col("_v"))).otherwise(0)
    scaled = F.when(fine, F.col("_v") * F.pow(F.lit(2.0), (-PLACES * F.col("_stretch") + _HIGH).cast("double"))).otherwise(0.0)
    high = F.floor(F.col("_scaled"))
    split = long.withColumn("_stretch", stretch).withColumn("_scaled", scaled).select(
        *by, "_out", "_stretch", high.cast("decimal(18,0)").alias("_high"),
        ((F.col("_scaled") - high) * float(1 << _LOW)).cast("bigint").cast("decimal(18,0)").alias("_low"),
        F.when(~fine, F.col("_v")).alias("_odd"),
    )
    added = split.groupBy(*by, "_out", "_stretch").agg(F.sum("_high").alias("_high"), F.sum("_low").alias("_low"), F.sum("_odd").alias("_odd"))
    units = (F.col("_high").cast(_WHOLE) * _whole(1 << _LOW) + F.col("_low")).cast(_WHOLE)
    # At most 63 stretches a group.
    part = F.struct(F.col("_stretch").alias("stretch"), units.alias("units"))
    whole = added.groupBy(*by).pivot("_out", outs).agg(F.collect_list(part).alias("parts"), F.sum("_odd").alias("odd"))

    def put_together(out: str) -> Column:
        parts, odd = F.col(f"`{out}_parts`"), F.col(f"`{out}_odd`")
        up, down = _digits(parts, 1), _digits(parts, -1)
        total = F.when(up["carry"] < 0, -_value(down["digits"])).otherwise(_value(up["digits"]))
        return F.when(odd.isNotNull(), odd).when(F.size(parts) > 0, total).alias(out)

    sums = whole.select(*by, *[put_together(out) for out in outs])
    if not by:
        return sums
    # Groups without any value are there too.
    groups = df.select(*by).distinct()
    renamed = sums.withColumnsRenamed({k: f"_sum_{k}" for k in by})
    same = [groups[k].eqNullSafe(renamed[f"_sum_{k}"]) for k in by]
    return groups.join(renamed, same, "left").select(*[groups[k] for k in by], *outs)
