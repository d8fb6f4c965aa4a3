"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are rotated to principal axes (fitted on a bounded sample) and projected, a few axes at a time, to ``CURVES`` Hilbert
orderings with shifted grids. Each ordering is range-partitioned and ranked by Spark; a query looks at the window of
keys around its own place in every ordering, the windows' finds are merged, and the score of each find is the
inner product of the original vectors in double precision.

How far a window must reach depends on the vectors: clustered ones lie close on some curve, isotropic ones hardly closer than others. So the reach is measured:
for a stated sample of queries (``TRIAL``) the true neighbours are found by reading all rows once, and the reach is the distance in rows
within which ``TARGET`` of them lie on at least one curve. Equal keys have an order of each curve's own, so windows inside a group of near copies see different
rows. Equal vectors are one entry that remembers its smallest ids, so a vector that a third of
the rows share costs no more than another; ids beyond these can't be among the nearest, as ties go to smaller ids.

Defined results: vectors that are null, zero, of an uncommon length or with null or non-finite components take no part, nor do null ids; repeated
ids are rows of their own; fewer candidates than asked for are all returned; very long vectors are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillcast.llm.common import Lean, materialize, ranked

#: AXES * CELL_BITS bits make a key; cells are fine enough that near copies of one vector spread over many.
CURVES, AXES, CELL_BITS = 16, 4, 15
#: A block holds as many rows as the windows reach to one side, within these bounds, so a window meets three blocks whatever its reach; past the upper bound, which keeps a task's memory bounded, it meets more.
BLOCK, BLOCK_MOST = 256, 65_536
FIT_ROWS = 20_000
#: Queries whose true neighbours set the reach, and the share of these that must be inside it.
TRIAL, TARGET = 128, 0.97
#: Products held at once, and the first step's share of the merge of equal vectors.
PRODUCTS_AT_ONCE, SALTS = 1 << 20, 64


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of rows of integer coordinates below 2**bits (Skilling's transform, all rows at once)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        p = (1 << b) - 1
        for i in range(n):
            has = (x[i] >> b) & 1 == 1
            swap = np.where(has, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(has, p, swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | (((x[i] ^ turn) >> b) & 1)
    return out


def _classes(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    """Equal vectors of a batch as one row with their ``keep`` smallest ids."""
    import xxhash

    for batch in batches:
        found: dict[bytes, list] = {}
        for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found.setdefault(np.array(v, "<f8").tobytes(), []).append(vec_id)
        rows = [(int(np.array([xxhash.xxh3_64_intdigest(v)], np.uint64).view(np.int64)[0]), v, sorted(i)[:keep]) for v, i in found.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))],
            ["cid", "vec", "ids"],
        )


def _keys(batches: Iterator[pa.RecordBatch], basis: np.ndarray, scale: np.ndarray, shifts: np.ndarray) -> Iterator[pa.RecordBatch]:
    d = len(basis)
    side = (1 << CELL_BITS) / 9.0
    for batch in batches:
        if not batch.num_rows:
            continue
        z = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<f8").reshape(-1, d) @ basis / scale
        for c in range(len(shifts)):
            axes = [(c * AXES + j) % d for j in range(AXES)]
            cells = np.clip((z[:, axes] + 4 + shifts[c]) * side, 0, (1 << CELL_BITS) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(batch.num_rows, c, np.int32)), pa.array(hilbert(cells, CELL_BITS)), batch.column(0), batch.column(1), batch.column(2)],
                ["curve", "key", "cid", "vec", "least"],
            )


def _nearest(q: np.ndarray, x: np.ndarray, least: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """(query row, entry row) of the ``keep`` best entries of ``x`` for each row of ``q``, some queries at a time."""
    out_q, out_x = [], []
    at_once = max(1, PRODUCTS_AT_ONCE // max(1, len(x)))
    for a in range(0, len(q), at_once):
        for i, row in enumerate(q[a : a + at_once] @ x.T):
            if len(row) > keep:
                # all that tie with the last one stay in until ids decide
                edge = np.partition(row, len(row) - keep)[len(row) - keep]
                near = np.nonzero(row >= edge - 1e-12)[0]
                near = near[np.lexsort((least[near], -row[near]))][: keep + 8]
            else:
                near = np.arange(len(row))
            out_q.append(np.full(len(near), a + i))
            out_x.append(near)
    return (np.concatenate(out_q), np.concatenate(out_x)) if out_q else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _scan(key, queries: pd.DataFrame, block: pd.DataFrame, dims: int, keep: int) -> pd.DataFrame:
    """The best entries of one block of an ordering for each query that looks at it."""
    if not len(queries) or not len(block):
        return pd.DataFrame({"q": [], "cid": [], "score": [], "least": []})
    q = np.frombuffer(b"".join(queries["vec"]), "<f8").reshape(-1, dims)
    x = np.frombuffer(b"".join(block["vec"]), "<f8").reshape(-1, dims)
    least = block["least"].to_numpy()
    a, b = _nearest(q, x, least, keep)
    return pd.DataFrame({"q": queries["cid"].to_numpy()[a], "cid": block["cid"].to_numpy()[b], "score": (q[a] * x[b]).sum(axis=1), "least": least[b]})


def _trial(batches: Iterator[pa.RecordBatch], names: np.ndarray, q: np.ndarray, keep: int) -> Iterator[pa.RecordBatch]:
    """The best entries among all rows for the trial queries."""
    for batch in batches:
        if batch.num_rows:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<f8").reshape(-1, q.shape[1])
            a, b = _nearest(q, x, batch.column(2).to_numpy(), keep)
            cid = batch.column(0).to_numpy()[b]
            yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(cid), pa.array((q[a] * x[b]).sum(axis=1))], ["q", "cid", "score"])


def reach(index: DataFrame, placed: DataFrame, wanted: DataFrame, n: int, k: int, dims: int, trial: int = TRIAL, target: float = TARGET) -> int:
    """The distance in rows within which ``target`` of the true neighbours of some queries lie on at least one curve."""
    some = wanted.join(index.select("cid", "vec"), "cid").orderBy(F.xxhash64("cid", F.lit("trial"))).limit(trial).collect()
    names, q = np.array([r["cid"] for r in some], np.int64), np.array([np.frombuffer(r["vec"], "<f8") for r in some]).reshape(-1, dims)
    found = index.select("cid", "vec", "least").mapInArrow(Lean(_trial, names=names, q=q, keep=k + 1), "q long, cid long, score double")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "cid")
    true = found.filter("q <> cid").withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).select("q", "cid")
    true = F.broadcast(materialize(true, "trial"))  # at most trial * k rows
    at = placed.select("curve", "cid", "at")
    mine = at.select("curve", F.col("cid").alias("q"), F.col("at").alias("q_at")).join(F.broadcast(true.select("q").distinct()), "q")
    far = at.join(true, "cid").join(mine, ["curve", "q"]).groupBy("q", "cid").agg(F.min(F.abs(F.col("at") - F.col("q_at"))).alias("far"))
    gaps = np.array(sorted(r["far"] for r in far.collect()) or [0])
    return int(min(n, max(k, gaps[min(len(gaps) - 1, math.ceil(target * len(gaps)) - 1)])))


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v: array of doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite).filter(F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (common[0]["n"] if common else 0))


def search(vectors: DataFrame, query_filter, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", curves: int = CURVES, half: int | None = None, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found for rows that ``query_filter`` (a Column on vec_id) picks.

    ``half`` is a window's reach to either side in rows; left out, it is measured.
    """
    spark, keep = vectors.sparkSession, k + 1
    rows = usable(vectors, vec_id, vector)
    grouped = rows.mapInArrow(Lean(_classes, keep=keep), "cid long, vec binary, ids array<long>")
    # equal vectors meet in two steps, so that one with a third of all rows is merged by many tasks first
    smallest = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids")
    grouped = grouped.groupBy("cid", F.pmod(F.xxhash64(F.element_at("ids", 1)), F.lit(SALTS)).alias("salt")).agg(F.any_value("vec").alias("vec"), smallest)
    merged = grouped.groupBy("cid").agg(F.any_value("vec").alias("vec"), smallest)
    index = materialize(merged.withColumn("least", F.element_at("ids", 1)), "index")
    n = index.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    # the fit sees a bounded sample, the index every row
    some = index.select("vec").filter(F.pmod(F.xxhash64("cid"), F.lit(1_000_000)) < int(min(1.0, FIT_ROWS / n) * 1_000_000)).limit(2 * FIT_ROWS).collect()
    some = some or index.select("vec").limit(1).collect()
    x = np.stack([np.frombuffer(r["vec"], "<f8") for r in some])
    dims = x.shape[1]
    basis = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    scale = np.maximum((x @ basis).std(axis=0), 1e-9)
    shifts = np.random.default_rng(seed).uniform(0, 1, (curves, 1))
    keyed = index.select("cid", "vec", "least").mapInArrow(Lean(_keys, basis=basis, scale=scale, shifts=shifts), "curve int, key long, cid long, vec binary, least long")
    # each curve has its own order of equal keys, so the windows inside a tight group differ
    placed = ranked(keyed, [F.col("curve"), F.col("key"), F.xxhash64("curve", "cid"), F.col("cid")], "at", "total", "curves")
    placed = placed.withColumn("at", F.col("at") - F.col("curve") * n)
    asked = rows.filter(query_filter).select(F.col("vec_id").alias("query_id"), "v")
    asked = asked.select("query_id", "v").mapInArrow(Lean(_named), "query_id long, q long")
    asked = materialize(asked, "queries")
    wanted = asked.select(F.col("q").alias("cid")).distinct()
    half = reach(index, placed, wanted, n, k, dims) if half is None else half
    size = min(max(half, BLOCK), BLOCK_MOST)
    # a block meets the queries of its window only: at most 2 * half + size of them, as each place holds one entry
    blocks = placed.select("curve", F.expr(f"at div {size}").alias("block"), "cid", "vec", "least")
    own_places = placed.select(*[F.col(c).alias(f"q_{c}") for c in placed.columns]).toDF(*placed.columns)
    looks = own_places.join(wanted, "cid", "left_semi").select(
        "curve",
        F.explode(F.sequence(F.expr(f"greatest(at - {half}, 0) div {size}"), F.expr(f"least(at + {half}, {n - 1}) div {size}"))).alias("block"),
        "cid",
        "vec",
    )
    keys = ["curve", "block"]
    finds = (
        looks.select(*[F.col(c).alias(c) for c in looks.columns])
        .groupBy(*keys)
        .cogroup(blocks.groupBy(*keys))
        .applyInPandas(partial(_scan, dims=dims, keep=keep), "q long, cid long, score double, least long")
    )
    merged = finds.groupBy("q", "cid").agg(F.max("score").alias("score"), F.min("least").alias("least"))
    w = Window.partitionBy("q").orderBy(F.desc("score"), "least")
    best = materialize(merged.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= keep), "best")
    lists = best.join(index.select("cid", "ids"), "cid").groupBy("q").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids")).alias("found"))
    flat = F.flatten(F.transform("found", lambda c: F.transform(c["ids"], lambda i: F.struct(c["far"].alias("far"), i.alias("vec_id")))))
    lists = lists.select("q", F.slice(F.sort_array(flat), 1, keep).alias("found"))
    joined = asked.join(lists, "q")
    own = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    out = joined.select("query_id", F.posexplode(own).alias("pos", "f"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.far")).alias("score"))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each query's class: the hash that ``_classes`` gives its vector."""
    import xxhash

    for batch in batches:
        names = np.array([xxhash.xxh3_64_intdigest(np.array(v, "<f8").tobytes()) for v in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names.view(np.int64))], ["query_id", "q"])
