"""Recognised speech: words on a time line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillcast.sources.tables import staged

ASR_SCHEMA = "start double, end double, words array<struct<word:string,start:double,end:double,score:double>>"


def flatten_words(segments: DataFrame, key: str, order: str = "seg") -> DataFrame:
    """One row a word: key, word_idx, word, start, end, score (1.0 where missing)."""
    words = F.posexplode("words").alias("k", "w")
    flat = segments.select(key, order, words).select(key, order, "k", "w.*")
    idx = F.row_number().over(Window.partitionBy(key).orderBy(order, "k")) - 1
    return flat.select(key, idx.alias("word_idx"), "word", "start", "end", F.coalesce("score", F.lit(1.0)).alias("score"))


def repair_overlaps(words: DataFrame, key: str, order: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Where a word ends after the next one starts, both move to the midpoint."""
    w = Window.partitionBy(key).orderBy(*order)
    nxt, prev = F.lead(start).over(w), F.lag(end).over(w)
    return words.withColumns(
        {
            f"fixed_{end}": F.when(F.col(end) > nxt, (F.col(end) + nxt) / 2).otherwise(F.col(end)),
            f"fixed_{start}": F.when(prev > F.col(start), (prev + F.col(start)) / 2).otherwise(F.col(start)),
        }
    )


def char_offsets(words: DataFrame, key: str, order: list[str], word: str = "word") -> DataFrame:
    """Add ``char_start``: where the word begins in the words joined by spaces."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return words.withColumn("char_start", F.coalesce(F.sum(F.length(word) + 1).over(w), F.lit(0)).cast("long"))


def joined_text(words: DataFrame, key: str, order: str = "word_idx", word: str = "word") -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct(order, F.col(word).alias("_w"))))
    return words.groupBy(key).agg(F.lower(F.array_join(F.transform(pairs, lambda x: x["_w"]), " ")).alias("joined_text"))


def confidence(scores: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """Mean and minimum of scores[first..last]."""
    part = F.slice(scores, first + 1, last - first + 1)
    return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part), F.array_min(part)


def expanding_threshold(df: DataFrame, key: str, order: list[str], value: str, default: float = 0.55, margin: float = 0.2, floor: float = 0.5, ceiling: float = 0.85, least: int = 5) -> DataFrame:
    """Add ``threshold``: clamp(median of the earlier values + margin), or the default while these are few."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # Spark has no ordered-frame median, so the earlier values are sorted in place; a key is one book
    seen = F.sort_array(F.collect_list(value).over(w))
    n = F.size(seen)
    med = F.when(n > 0, (F.get(seen, F.floor((n - 1) / 2).cast("int")) + F.get(seen, F.floor(n / 2).cast("int"))) / 2)
    clamped = F.least(F.greatest(med + margin, F.lit(floor)), F.lit(ceiling))
    return df.withColumn("threshold", F.when(F.count(value).over(w) >= least, clamped).otherwise(F.lit(default)))


def fragment_ids(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``fragment_id``: the 0-based position in the given order, ranked by ranges rather than in one task."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    # written once: the ranges must be the same where they are counted and where they are read
    placed = staged(placed, "fragment-ids").withColumn("_p", F.shiftright("_m", 33))
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_s"))
    place = F.col("_s") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    # one row for each range
    return placed.join(F.broadcast(starts), "_p").withColumn("fragment_id", place.cast("long")).drop("_p", "_m", "_s")
