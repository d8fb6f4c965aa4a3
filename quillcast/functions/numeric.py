"""Numeric helpers with pandas-like missing values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def missing(c: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(c), c)


def round3(c: Column) -> Column:
    """Three decimals, ties to even."""
    return F.rint(c * 1000) / 1000


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def flag(c: Column) -> Column:
    """A condition that is false where it can't be told."""
    return F.coalesce(c, F.lit(False))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.when(b != 0, b)


def sign_of_level(c: Column) -> Column:
    return F.when(c == "high", 1.0).when(c == "low", -1.0)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole with an empty whole counted as one."""
    return 100.0 * part / F.greatest(whole, F.lit(1))


def semitones(hz: Column) -> Column:
    return 12 * F.log2(F.when(hz > 0, hz))


def array_mean(a: Column) -> Column:
    return ratio(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a).cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return ratio(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
