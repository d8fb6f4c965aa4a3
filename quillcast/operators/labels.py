"""Labels from outside services: one call for each distinct text, joined back."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ("low", "neutral", "high")
AXES = ("loudness", "pitch", "tempo", "tension")
FRAGMENTS_SCHEMA = "struct<fragments:array<struct<speech:string,description:string,character:string>>>"
AXES_SCHEMA = "struct<loudness:string,pitch:string,tempo:string,tension:string>"


class Client(Protocol):
    """Answers a prompt with JSON text. Real ones talk to a service; tests use ``Fake``."""

    def __call__(self, prompt: str) -> str: ...


class Fake:
    """Deterministic stand-in: axis levels by the length of the text, quoted parts as fragments."""

    def __init__(self, kind: str = "axes"):
        self.kind = kind

    def __call__(self, prompt: str) -> str:
        if self.kind == "axes":
            return json.dumps({a: LEVELS[(len(prompt) + i) % 3] for i, a in enumerate(AXES)})
        import re

        return json.dumps({"fragments": [{"speech": s, "description": "тихо", "character": None} for s in re.findall("«([^»]+)»", prompt)]}, ensure_ascii=False)


def ask(df: DataFrame, text: str, client: Client, retries: int = 3, pause: float = 1.0) -> DataFrame:
    """Add ``reply`` and ``reply_status`` (ok or error:<type>); a failing call is a status, never a failed job.

    Concurrency is the number of partitions of ``df``.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies, states = [], []
            for t in pdf[text]:
                reply, state = None, "ok"
                for k in range(retries):
                    try:
                        reply, state = client(t), "ok"
                        break
                    except Exception as e:  # noqa: BLE001
                        state = f"error:{type(e).__name__}"
                        if k + 1 < retries:
                            time.sleep(min(pause * 2**k, 20))
                replies.append(reply)
                states.append(state)
            yield pdf.assign(reply=replies, reply_status=states)

    schema = ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", reply string, reply_status string"
    return df.mapInPandas(run, schema)


def known_level(c: Column) -> Column:
    return F.when(c.isin(*LEVELS), c).otherwise("neutral")


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """Distinct non-blank texts, trimmed, in order."""
    from quillcast.functions.text import strip

    return df.filter(F.col(text).isNotNull()).select(strip(F.col(text)).alias(text)).filter(F.col(text) != "").distinct().orderBy(text)


def join_back(df: DataFrame, labels: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """Labels of distinct texts to all rows; ``names`` gives the default of each label that misses."""
    return df.join(labels.select(text, *names), text, "left").withColumns({k: F.coalesce(k, F.lit(v)) for k, v in names.items()})


def axes_of(df: DataFrame, client: Client, text: str = "description") -> DataFrame:
    """(text, loudness, pitch, tempo, tension, axes_status) for each distinct text."""
    asked = ask(distinct_texts(df, text), text, client)
    got = F.from_json("reply", AXES_SCHEMA)
    return asked.select(text, *[known_level(got[a]).alias(a) for a in AXES], F.col("reply_status").alias("axes_status"))


def fragments_of(chunks: DataFrame, client: Client, chunk: str = "chunk_text") -> DataFrame:
    """One row for each fragment a service finds in a chunk; none on failure."""
    asked = ask(chunks, chunk, client)
    found = F.coalesce(F.from_json("reply", FRAGMENTS_SCHEMA)["fragments"], F.array().cast("array<struct<speech:string,description:string,character:string>>"))
    return asked.select(*chunks.columns, F.explode(found).alias("f")).select(*chunks.columns, "f.*")


def guarded(fragments: DataFrame, chunk: str = "chunk_text") -> tuple[DataFrame, DataFrame]:
    """The fragments that pass the guard and have a real description, and one row of counts of what was dropped."""
    from quillcast.functions.numeric import percent
    from quillcast.functions.text import is_junk_description, speech_in_chunk

    s, c = F.col("speech"), F.col(chunk)
    marked = fragments.withColumns({"_exact": speech_in_chunk(s, c, exact=True), "_near": speech_in_chunk(s, c), "_junk": is_junk_description(F.col("description"), s)})
    counts = marked.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if("_exact").alias("kept_exact"),
        F.count_if("_near").alias("kept_normalized"),
        F.count_if("_near and not _junk").alias("kept"),
    )
    counts = counts.withColumns({"exact_pct": percent(F.col("kept_exact"), F.col("raw")), "kept_pct": percent(F.col("kept"), F.col("raw"))})
    return marked.filter("_near and not _junk").drop("_exact", "_near", "_junk"), counts
