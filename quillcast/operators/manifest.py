"""Assembling the manifest and its public edition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.operators.sampling import keep_first
from quillcast.operators.scores import hard_filter

ACCEPTED = ("skipped_exists",)


def index_pivot(indexes: DataFrame, key: str, models: list[str], prefix: str = "embedding_row_") -> DataFrame:
    """(key, model, row) to one row a key with a column for each model: one shuffle instead of a join for each model."""
    cells = [F.max(F.when(F.col("model") == m, F.col("row"))).alias(f"{prefix}{m}") for m in models]
    return indexes.groupBy(key).agg(*cells)


def build(scores: DataFrame, dataset: DataFrame, registry: DataFrame, gender: DataFrame, text_index: DataFrame | None = None, audio_index: DataFrame | None = None, accept_statuses=ACCEPTED) -> DataFrame:
    """Scores that pass the hard filters and were really cut, with genre, gender and embedding rows.

    Registry and gender have a row a book or reader; the large joins are by fragment_id and description.
    """
    kept = hard_filter(scores).drop("junk_any_hard", "junk_badmatch", "junk_few_words", "junk_few_asr_words")
    cut = dataset.filter(F.col("cut_status").isin(*accept_statuses)).drop("cut_status")
    out = kept.join(cut, "fragment_id")
    genres = keep_first(registry.select("path_book", "book_genres"), ["path_book"], ["book_genres"])
    out = out.join(genres, "path_book", "left").join(gender.select("reader", F.col("gender").alias("reader_gender")), "reader", "left")
    if text_index is not None:
        out = out.join(text_index, "description", "left")
    if audio_index is not None:
        out = out.join(audio_index, "fragment_id", "left")
    return out


def publish(manifest: DataFrame, registry: DataFrame, checksums: DataFrame, columns: list[str]) -> DataFrame:
    """The public columns with source link and checksum, a left join each."""
    links = keep_first(registry.select("path_book", "link"), ["path_book"], ["link"])
    sums = keep_first(checksums.select("reader", "book_name", "sha256"), ["reader", "book_name"], ["sha256"])
    return manifest.join(links, "path_book", "left").join(sums, ["reader", "book_name"], "left").select(*columns, "link", "sha256")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls) for each column from one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])).alias("x")).select("x.*")


def union_present(spark, paths: list[str], reader) -> DataFrame | None:
    """One table of the files that exist, by name; None if none does."""
    from quillcast.sources.tables import exists

    found = [reader(p) for p in paths if exists(spark, p)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None
