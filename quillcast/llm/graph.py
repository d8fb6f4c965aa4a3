"""Connected components by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import discard, materialize


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b): comp is the smallest node it reaches.

    Rounds grow with the logarithm of the longest chain. Each round's edges are written to the shared
    folder; only a count and a checksum come to the driver. A hub's edges are joined by equality, which Spark can split.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = materialize(e, "edges")
    state = _state(e)
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
        old, e = e, materialize(small.select("p.a", "p.b").filter("a <> b").distinct(), "edges")
        discard(old)
        now = _state(e)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(e.select("b", "b")).distinct()
