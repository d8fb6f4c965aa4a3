"""Deduplication, resumption, seeded samples, folds and slices with a defined order.

Seeded orders hash (seed, key), so they are the same on any number of partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded(seed: int, key: Column) -> Column:
    """A sort key that shuffles rows the same way each time."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the first in ``order``. An aggregate, so hot keys combine on the map side."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    whole = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.min_by(whole, by).alias("w")).select(*[F.col(c) if c in keys else F.col(f"w.{c}").alias(c) for c in df.columns])


def content_dedup(df: DataFrame, content: str, name: str) -> DataFrame:
    """The first name of each distinct content, by hash of the content."""
    return df.groupBy(F.md5(F.col(content)).alias("content_md5")).agg(F.min(name).alias(name), F.count(F.lit(1)).alias("copies"))


def not_done(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not in ``done`` yet."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def without(df: DataFrame, key: str, *used: DataFrame) -> DataFrame:
    """Rows whose key is in none of the tables ``used``."""
    for u in used:
        df = df.join(u.select(key).distinct(), key, "left_anti")
    return df


def only(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    return df.join(listed.select(key), key, "left_semi")


def disjoint_samples(df: DataFrame, key: str, sizes: dict[str, int], seed: int = 42) -> DataFrame:
    """Rows of disjoint samples of exact sizes, with column ``sample``.

    Only as many rows as the samples need are sorted into one place (a distributed top-k).
    """
    need = sum(sizes.values())
    top = df.withColumn("_o", seeded(seed, F.col(key))).orderBy("_o", key).limit(need)
    have = top.count()
    if have < need:
        raise ValueError(f"{have} rows, but {need} are wanted")
    ranked = top.withColumn("_r", F.row_number().over(Window.orderBy("_o", key)))
    which, start = None, 0
    for name, n in sizes.items():
        hit = F.col("_r").between(start + 1, start + n)
        which = F.when(hit, name) if which is None else which.when(hit, name)
        start += n
    return ranked.withColumn("sample", which).drop("_o", "_r")


def sample_per_group(df: DataFrame, keys: Sequence[str], row: str, n: int, seed: int = 0) -> DataFrame:
    """At most ``n`` rows of each group, seeded. Spark keeps n rows a group before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(seeded(seed, F.col(row)), row)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """(key, fold) for the distinct keys: dealt in turn after a seeded shuffle, so sizes differ by one at most."""
    w = Window.orderBy(seeded(seed, F.col(key)), key)  # keys are books: a small list
    return df.select(key).distinct().withColumn("fold", F.pmod(F.row_number().over(w) - 1, F.lit(k)).cast("int"))


def page(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in both tables; an empty result proves disjointness."""
    return a.select(key).intersect(b.select(key))


def ensure_columns(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The declared columns in order: missing ones null, further ones dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])
