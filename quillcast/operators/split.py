"""Reader-disjoint train, validation and test parts by greedy longest-first assignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.operators.sampling import seeded

RATIOS = {"train": 0.8, "val": 0.1, "test": 0.1}


def reader_hours(df: DataFrame, reader: str = "reader", gender: str = "reader_gender", seconds: str = "duration_s") -> DataFrame:
    """Hours by reader; readers or genders that are null take no part."""
    known = df.filter(F.col(reader).isNotNull() & F.col(gender).isNotNull())
    return known.groupBy(F.col(reader).alias("reader"), F.col(gender).alias("reader_gender")).agg((F.sum(seconds) / 3600).alias("hours"))


def lpt_split(hours: DataFrame, ratios: dict[str, float] = RATIOS, seed: int = 0) -> DataFrame:
    """(reader, reader_gender, hours, split): per gender, longest reader first, into the part that lacks most.

    Hours are one row a reader; a gender's readers are folded as one array, whose size is the number of readers.
    """
    if abs(sum(ratios.values()) - 1) > 1e-6:
        raise ValueError("ratios must sum to 1")
    names = list(ratios)
    item = F.struct((-F.col("hours")).alias("neg"), seeded(seed, F.col("reader")).alias("tie"), F.col("reader").alias("reader"), F.col("hours").alias("hours"))
    lists = hours.groupBy("reader_gender").agg(F.array_sort(F.collect_list(item)).alias("readers"), F.sum("hours").alias("total"))
    zero = F.struct(
        F.array(*[F.col("total") * ratios[n] for n in names]).alias("lack"),
        F.array().cast("array<struct<reader:string,hours:double,split:string>>").alias("out"),
    )

    def step(acc: Column, x: Column) -> Column:
        lack = acc["lack"]
        best = F.array_position(lack, F.array_max(lack)).cast("int")
        row = F.struct(x["reader"].cast("string").alias("reader"), x["hours"].cast("double").alias("hours"), F.element_at(F.array(*[F.lit(n) for n in names]), best).alias("split"))
        less = F.transform(lack, lambda v, i: F.when(i + 1 == best, v - x["hours"]).otherwise(v))
        return F.struct(less.alias("lack"), F.concat(acc["out"], F.array(row)).alias("out"))

    folded = lists.select("reader_gender", F.explode(F.aggregate("readers", zero, step)["out"]).alias("r"))
    return folded.select("r.reader", "reader_gender", "r.hours", "r.split")


def assign(df: DataFrame, split: DataFrame, reader: str = "reader") -> DataFrame:
    """Each row's part by its reader; readers are few, so Spark may broadcast them."""
    return df.join(split.select(F.col("reader").alias(reader), "split"), reader, "left")


def summary(split: DataFrame) -> DataFrame:
    return split.groupBy("reader_gender", "split").agg(F.count(F.lit(1)).alias("readers"), F.sum("hours").alias("hours"))
