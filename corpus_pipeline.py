"""From raw documents to packed training sequences: five stages, each written and read again.

Defined results, stage by stage: a null or blank text fails the quality rules; texts without letters and those of no learned language go at language ID (all go, if no
row has a language to learn from); of near duplicates, repeated rows and equal texts one row stays, whether ids are null or repeat, and ties go to the smallest id; mixing
samples by id, so rows that share one stay or go together, and null languages or sources are values of their own; packing gives every remaining
text, however long, its pieces. Empty tables stay empty, and further columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.llm import dedup, langid, mixing, packing, quality
from quillcast.llm.common import crc_text, materialize, table

#: Near duplicates: shingles of five words, similarity 0.8 or more.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"
#: Share of the tokens that mixing keeps.
TOKEN_BUDGET = 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the base rules and their language's and source's fences."""
    return quality.filter_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which the random field finds one of the languages it learned."""
    model = langid.fit(docs, F.pmod(crc_text(F.col("doc_id")), F.lit(4)) != 2)
    return langid.filter_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return dedup.keep_one(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target weights of source, language and topic."""
    return mixing.sample(docs, public_tokenizers.path(TOKENIZER), budget=TOKEN_BUDGET)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [("quality rules", quality_rules), ("language ID", language), ("near duplicates", near_duplicates), ("mixing", mix), ("packing", pack)]

#: SQL can't express the learned and hashed stages; tests hold each against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, name.replace(" ", "-"))
    return docs
