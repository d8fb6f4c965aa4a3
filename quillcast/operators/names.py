"""Removing characters' names from descriptions of their manner of speech."""

from __future__ import annotations

import re
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.functions.text import NOBODY, strip, tidy

#: Characters of kept words (50 more a word) and of texts that a task holds beside its batch. No result depends on them.
KEPT_CHARS, SLICE_CHARS = 3_000_000, 500_000


class Lemmatizer(Protocol):
    def __call__(self, word: str) -> str: ...


def suffix_lemma(word: str) -> str:
    """A rough stand-in for a morphological dictionary: common Russian case endings are cut off (approximate)."""
    w = word.lower()
    for ending in ("ами", "ями", "ого", "его", "ому", "ему", "ыми", "ими", "ах", "ях", "ов", "ев", "ом", "ем", "ой", "ей", "ую", "ая", "ый", "ий", "а", "я", "у", "ю", "ы", "и", "е", "о"):
        if len(w) - len(ending) >= 4 and w.endswith(ending):
            return w[: -len(ending)]
    return w


def character_sets(df: DataFrame, description: str = "description", character: str = "character") -> DataFrame:
    """(description, names): the real characters each description was given for, longest first."""
    name = strip(F.col(character))
    real = F.when(name.isNotNull() & (name != "") & ~F.lower(name).isin(*NOBODY), name)
    names = F.collect_set(real)
    order = F.array_sort(F.transform(names, lambda n: F.struct((-F.length(n)).alias("l"), n.alias("n"))))
    return df.groupBy(description).agg(F.transform(order, lambda x: x["n"]).alias("names"))


def _whole(name: Column) -> Column:
    return F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?!\w)"))


def remove_exact(text: Column, names: Column) -> Column:
    """Each name as a whole word becomes a space, in the order given."""
    return F.aggregate(names, text, lambda t, n: F.regexp_replace(t, _whole(n), F.lit(" ")))


def remove_lemmas(df: DataFrame, text: str, names: str, lemmatizer: Lemmatizer = suffix_lemma) -> DataFrame:
    """Words whose lemma is that of a word of a name become spaces, by slices of Arrow batches."""

    def run(batches):
        cache: dict[str, str] = {}
        chars = 0

        def lemma(w: str) -> str:
            nonlocal chars
            if w not in cache:
                if chars > KEPT_CHARS:
                    cache.clear()
                    chars = 0
                cache[w] = lemmatizer(w)
                chars += len(w) + 50
            return cache[w]

        def without(t: str | None, ns: list[str | None] | None) -> str | None:
            gone = {lemma(w) for n in ns or [] for w in word.findall(n)}
            return t if t is None or not gone else word.sub(lambda m: " " if lemma(m[0]) in gone else m[0], t)

        word = re.compile(r"\w+")
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts, sets = batch.column(at), batch.column(batch.schema.get_field_index(names))
            since, held, out = 0, 0, []
            for k in range(batch.num_rows):
                out.append(without(texts[k].as_py(), sets[k].as_py()))
                held += len(out[-1] or "") + 1
                if held >= SLICE_CHARS or k == batch.num_rows - 1:
                    own = batch.slice(since, k + 1 - since)
                    yield pa.RecordBatch.from_arrays([pa.array(out, texts.type) if i == at else c for i, c in enumerate(own.columns)], schema=batch.schema)
                    since, held, out = k + 1, 0, []

    return df.mapInArrow(run, df.schema)


def anonymize(df: DataFrame, lemmatizer: Lemmatizer | None = suffix_lemma, description: str = "description", character: str = "character") -> DataFrame:
    """(description, description_anon, changed, names) for each distinct description.

    A description that would become empty stays as it was, unchanged.
    """
    sets = character_sets(df.filter(F.col(description).isNotNull()), description, character)
    out = sets.withColumn("_t", remove_exact(F.col(description), F.col("names")))
    if lemmatizer is not None:
        out = remove_lemmas(out, "_t", "names", lemmatizer)
    touched = F.col("_t") != F.col(description)
    clean = tidy(F.col("_t"))
    return out.select(
        description,
        F.when(clean == "", F.col(description)).otherwise(clean).alias("description_anon"),
        F.when(clean == "", False).otherwise(touched).alias("changed"),
        "names",
    )


def leaks(text: Column, names: Column) -> Column:
    """Does any name still stand in the text as a whole word?"""
    return F.coalesce(F.exists(names, lambda n: F.regexp_like(text, _whole(n))), F.lit(False))


def report(anonymized: DataFrame, description: str = "description") -> DataFrame:
    back = (F.size("names") > 0) & ~F.col("changed") & leaks(F.col(description), F.col("names"))
    return anonymized.agg(
        F.count(F.lit(1)).alias("descriptions"),
        F.count_if(F.size("names") > 0).alias("with_name"),
        F.count_if("changed").alias("changed"),
        F.count_if(leaks(F.col("description_anon"), F.col("names"))).alias("leaks"),
        F.count_if(back).alias("reverted"),
    )


def as_pandas_lemmas(lemmatizer: Lemmatizer):
    """A pandas UDF of a lemmatizer, for use in expressions."""

    @F.pandas_udf("string")
    def run(words: pd.Series) -> pd.Series:
        return words.map(lambda w: None if w is None else lemmatizer(w))

    return run
