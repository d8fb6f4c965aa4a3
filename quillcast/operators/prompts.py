"""Prompt ensembling and zero-shot classes in a joint space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.functions.numeric import cosine


def fill(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)


def centroids(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, centroid): the mean vector of each class. One row a (class, dimension) is shuffled after partial sums."""
    parts = df.select(key, F.posexplode(vector).alias("dim", "x"))
    means = parts.groupBy(key, "dim").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda p: p["m"]).alias("centroid"))


def zero_shot(df: DataFrame, classes: DataFrame, row: str, vector: str, key: str) -> DataFrame:
    """(row, best, score): the class whose centroid has the highest cosine; ties go to the smaller class.

    The classes (a prompt suite, tens of rows) become one array that every row scans in place, not a product of rows.
    """
    all_ = classes.agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col("centroid").alias("c")))).alias("classes"))
    v = F.transform(vector, lambda x: x.cast("double"))
    scored = F.transform("classes", lambda c: F.struct((F.rint(cosine(v, c["c"]) * 1e9) / 1e9).alias("s"), c["k"].alias("k")))
    best = F.aggregate(scored, F.get(scored, F.lit(0)), lambda a, x: F.when((x["s"] > a["s"]) | a["s"].isNull(), x).otherwise(a))
    joined = df.join(F.broadcast(all_), F.lit(True))  # one row
    return joined.select(row, best.alias("b")).select(row, F.col("b.k").alias("best"), F.col("b.s").alias("score"))
