"""Mixing sources to target weights by iterative proportional fitting.

Tokens (byte-pair ids, as packing counts them) of the cells (source, lang, topic) are raked to target marginals of the three dimensions
under the bound that no cell can give more than it has: cells at their bound stay there and the others are raked again, until
every marginal is met. A cell's calibrated probability is its raked tokens over its tokens; documents are
sampled by comparing a hash of their id with it. So the expected sample meets its targets and its budget.

A target above all that a value has is capped there, and the rest of its dimension shares the difference; ``capped`` names such values. Where the
three marginals cannot be met together, raking stops after ``ROUNDS`` rounds and warns with the largest gap. ``marginals`` reports target and expectation.

Topics, where no column has them, are learned: k-means over hashed token vectors less their language's mean. The languages' means, the start and
every round take every row (equal texts of a language count once), and rounds go on until the centres stay where they are. Vectors are
whole numbers (``UNIT`` is 1), so sums are exact and no dealing of the rows changes them.

Cells come to the driver up to ``MAX_CELLS`` rows; beyond that the same steps with the same stopping rule run on a DataFrame of cells.

Defined results: nulls are a value of their own in each dimension; null text has one token (its end) and topic ``none``, as all texts without tokens; very
long texts count whole; targets are scaled over the values that occur; repeated rows share one decision; an empty table stays empty; other
columns pass through, whatever their names.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from quillcast.llm.common import Lean, discard, fresh, materialize
from quillcast.llm.packing import Encoder

MAX_CELLS, MAX_BROADCAST_CELLS = 1_000_000, 100_000
ROUNDS, TOLERANCE = 500, 1e-7
#: Default target of a value: its share of tokens to this power, scaled to sum to one.
TEMPER = {"source": 0.7, "lang": 0.7, "topic": 0.85}
DIMS = ("source", "lang", "topic")
BUDGET = 0.5
TOPICS, BUCKETS, UNIT, TOPIC_ROUNDS = 8, 256, 32767, 1000
#: The first centres come from cells of all rows: their sides of so many principal axes.
AXES = 6
#: Centred vectors to a row of their table, which every round reads.
PACKED = 4
#: Bytes of partial sums that the driver takes at once, and languages that a task sums up at once.
MAX_PARTIAL, MAX_LANGS = 1 << 25, 1024
_FULL = 1 - 1e-12


def tempered(shares: dict, power: float) -> dict:
    total = sum(shares.values()) or 1
    raised = {k: (v / total) ** power for k, v in shares.items() if v}
    return {k: v / sum(raised.values()) for k, v in raised.items()}


def feasible(share: np.ndarray, have: np.ndarray, budget: float) -> np.ndarray:
    """Tokens wanted of each value: ``share`` of the budget, but never more than it has; the others make up for it."""
    want, free = np.zeros(len(share)), np.ones(len(share), bool)
    for _ in range(len(share)):
        left, shares = budget - have[~free].sum(), share[free].sum()
        want = np.where(free, share * (left / shares if shares else 0.0), have)
        over = free & (want > have)
        if not over.any():
            break
        free &= ~over
    return np.minimum(want, have)


def rake(weights: np.ndarray, codes: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS, tol: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """Amounts of at most ``weights`` whose sums by each dimension's code are its targets; and the largest gap left, as a share of the whole."""
    w, total = weights.astype(float), max(float(targets[0].sum()), 1e-300) if targets else 1.0
    x, gap = w * (total / (w.sum() or 1)), 0.0
    for _ in range(rounds):
        gap = 0.0
        for code, target in zip(codes, targets, strict=True):
            full = x >= w * _FULL
            now, held = np.bincount(code, x, len(target)), np.bincount(code, np.where(full, x, 0.0), len(target))
            gap = max(gap, float(np.abs(now - target).max(initial=0)) / total)
            free = now - held
            down = np.where(now > 0, target / np.where(now > 0, now, 1), 0.0)
            up = np.where(free > 0, (target - held) / np.where(free > 0, free, 1), 1.0)
            grow = (target > now)[code]
            x = np.where(grow, np.where(full, x, np.minimum(w, x * up[code])), x * down[code])
        if gap < tol:
            break
    return x, gap


def rake_frame(cells: DataFrame, dims: list[str], targets: list[DataFrame], rounds: int = ROUNDS, tol: float = TOLERANCE) -> tuple[DataFrame, float]:
    """The same on a DataFrame of cells (columns dims and w), with column ``x``: for more cells than the driver should hold.

    Each target has its dimension's column and ``want``; a round is one grouped sum and one join a dimension.
    """
    total = targets[0].agg(F.sum("want")).first()[0] or 1e-300
    weight = cells.agg(F.sum("w")).first()[0] or 1
    out, gap = cells.withColumn("x", F.col("w").cast("double") * (total / weight)), 0.0
    full = F.col("x") >= F.col("w") * _FULL
    for _ in range(rounds):
        gap, before = 0.0, out
        for d, target in zip(dims, targets, strict=True):
            t = target.select(F.col(d).alias("t"), "want")
            sums = out.groupBy(F.col(d).alias("k")).agg(F.sum("x").alias("now"), F.sum(F.when(full, F.col("x")).otherwise(0.0)).alias("held"))
            sums = materialize(sums.join(t, F.col("k").eqNullSafe(F.col("t")), "left").withColumn("want", F.coalesce("want", F.lit(0.0))).drop("t"), "sums")
            gap = max(gap, (sums.agg(F.max(F.abs(F.col("now") - F.col("want")))).first()[0] or 0.0) / total)
            free = F.col("now") - F.col("held")
            up = F.when(free > 0, (F.col("want") - F.col("held")) / free).otherwise(1.0)
            factors = sums.select("k", (F.col("want") > F.col("now")).alias("grow"), up.alias("up"), F.when(F.col("now") > 0, F.col("want") / F.col("now")).otherwise(0.0).alias("down"))
            grown = F.when(full, F.col("x")).otherwise(F.least(F.col("w").cast("double"), F.col("x") * F.col("up")))
            moved = out.join(factors, F.col(d).eqNullSafe(F.col("k"))).select(*dims, "w", F.when(F.col("grow"), grown).otherwise(F.col("x") * F.col("down")).alias("x"))
            out, old = materialize(moved, "raked"), out
            if old is not before:
                discard(old)
        discard(before)
        if gap < tol:
            break
    return out, gap


def _vector(ids: np.ndarray) -> np.ndarray:
    """The hashed token vector of a text, of length ``UNIT``."""
    v = np.log1p(np.bincount((ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS))
    return np.rint(v * (UNIT / (np.linalg.norm(v) or 1.0))).astype("<i2")


def _ids(encoder: Encoder, text: str | None) -> np.ndarray:
    return np.frombuffer(encoder.encode(text or ""), "<u4").astype(np.uint64)


def _matrix(column: pa.Array) -> np.ndarray:
    """The vectors of all rows; a row holds one or more."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], "<i2", (ends[-1] - ends[0]) // 2, ends[0]).reshape(-1, BUCKETS).astype(float)


def _rows(parts: np.ndarray | list) -> pa.Array:
    return pa.array([r.tobytes() for r in parts], pa.binary())


def _language_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict = {}

    def flush() -> pa.RecordBatch:
        parts = [pa.array(list(found), pa.string()), pa.array([n for n, _ in found.values()], pa.int64()), _rows([t for _, t in found.values()])]
        found.clear()
        return pa.RecordBatch.from_arrays(parts, ["lang", "n", "total"])

    for batch in batches:
        langs, at = np.unique(np.array(batch.column(0).to_pylist(), object), return_inverse=True)
        order, n = np.argsort(at, kind="stable"), np.bincount(at)
        sums = np.add.reduceat(_matrix(batch.column(1))[order], np.cumsum(n) - n)
        for lang, k, total in zip(langs, n.tolist(), sums, strict=True):
            old = found.get(lang, (0, 0.0))
            found[lang] = (old[0] + k, old[1] + total)
        if len(found) > MAX_LANGS:
            yield flush()
    if found:
        yield flush()


def _language_mean(parts: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(t) for t in parts.column("total").to_pylist())
    mean = np.rint(total / sum(parts.column("n").to_pylist())).astype("<i2")
    return pa.table({"lang": parts.column("lang").slice(0, 1).cast(pa.string()), "mean": _rows(mean[None])})


def _centred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = (_matrix(batch.column(0)) - _matrix(batch.column(1))).astype("<i2")
        yield pa.RecordBatch.from_arrays([_rows([x[i : i + PACKED] for i in range(0, len(x), PACKED)])], ["x"])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, as ``Lean`` has them, but without its collection at the end: a round's tasks are short and leave little behind."""
    return (b.slice(i, Lean.ROWS) for b in batches for i in range(0, b.num_rows, Lean.ROWS))


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BUCKETS, BUCKETS))
    for batch in _slices(batches):
        x = _matrix(batch.column(0))
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([_rows(total.reshape(1, -1))], ["total"])


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _sides(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return (x @ axes.T > 0) @ (1 << np.arange(len(axes)))


def _sums(batches: Iterator[pa.RecordBatch], code, by: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """By ``code``, the number of vectors and their sum, as one row."""
    total = np.zeros((size, 1 + BUCKETS))
    for batch in _slices(batches):
        x = _matrix(batch.column(0))
        at = code(x, by)
        total[:, 0] += np.bincount(at, minlength=size)
        total[:, 1:] += np.eye(size)[at].T @ x
    yield pa.RecordBatch.from_arrays([_rows(total.reshape(1, -1))], ["total"])


def _added(x: DataFrame, shape: tuple[int, int], run, **given) -> np.ndarray:
    """The sum of the tasks' matrices; as many tasks as the driver can take the matrices of."""
    parts = x.coalesce(max(1, MAX_PARTIAL // (8 * shape[0] * shape[1]))).mapInArrow(partial(run, **given), "total binary").collect()
    return sum((np.frombuffer(r["total"]).reshape(shape) for r in parts), np.zeros(shape))


def _first_centres(n: np.ndarray, total: np.ndarray, topics: int) -> np.ndarray:
    """Centres of the cells' weighted means: the farthest ones first, then k-means over the cells."""
    n, means = n[n > 0], total[n > 0] / n[n > 0, None]
    centres = means[[(n * (means**2).sum(axis=1)).argmax()]] if len(n) else np.zeros((1, BUCKETS))
    while len(centres) < topics and len(n):
        far = n * np.min([((means - c) ** 2).sum(axis=1) for c in centres], axis=0)
        if not far.max() > 0:
            break
        centres = np.vstack([centres, means[far.argmax()]])
    for _ in range(TOPIC_ROUNDS):
        at = _nearest(means, centres)
        moved = np.stack([np.average(means[at == k], axis=0, weights=n[at == k]) if (at == k).any() else c for k, c in enumerate(centres)])
        if np.allclose(moved, centres):
            break
        centres = moved
    return centres


def _offsets(batches: Iterator[pa.RecordBatch], centres: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), _rows((centres**2).sum(axis=1) + 2 * _matrix(batch.column(1)) @ centres.T)], ["lang", "offsets"])


def fit_topics(rows: DataFrame, topics: int = TOPICS) -> tuple[np.ndarray, DataFrame]:
    """Centres of all of ``rows`` (lang, vector, digest of the text), and by language what its mean adds to the distances from them.

    A vector v of language l is nearest to the centre c with the smallest |c|^2 + 2 mean(l) c - 2 v c; the first two terms are the offsets.
    """
    points = materialize(rows.filter(F.col("vector").isNotNull()).distinct().select("lang", "vector"), "points")
    sums = points.coalesce(MAX_PARTIAL // (8 * BUCKETS)).mapInArrow(Lean(_language_sums), "lang string, n bigint, total binary")
    means = materialize(sums.groupBy("lang").applyInArrow(_language_mean, "lang string, mean binary"), "means")
    x = materialize(points.join(means, "lang").select("vector", "mean").mapInArrow(Lean(_centred), "x binary"), "centred")
    axes = np.linalg.eigh(_added(x, (BUCKETS, BUCKETS), _products))[1].T[::-1][:AXES]
    cells = _added(x, (1 << AXES, 1 + BUCKETS), _sums, code=_sides, by=axes, size=1 << AXES)
    centres = _first_centres(cells[:, 0], cells[:, 1:], topics)
    for _ in range(TOPIC_ROUNDS):
        found = _added(x, (len(centres), 1 + BUCKETS), _sums, code=_nearest, by=centres, size=len(centres))
        n, old = found[:, :1], centres
        centres = np.where(n > 0, found[:, 1:] / np.maximum(n, 1), centres)
        if np.allclose(centres, old):
            break
    else:
        warnings.warn(f"topics still moved after {TOPIC_ROUNDS} rounds", stacklevel=2)
    offsets = materialize(means.mapInArrow(Lean(_offsets, centres=centres), "lang string, offsets binary"), "offsets")
    discard(points, means, x)
    return centres, offsets


def _described(batches: Iterator[pa.RecordBatch], path: str, text: int, learn: bool, drop: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        ids = [_ids(encoder, t) for t in batch.column(text).to_pylist()]
        vectors = pa.array([_vector(x).tobytes() if learn and len(x) else None for x in ids], pa.binary())
        keep = [i for i in range(batch.num_columns) if not (drop and i == text)]
        columns = [batch.column(i) for i in keep] + [vectors, pa.array([len(x) + 1 for x in ids], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])


def described(docs: DataFrame, path: str, topic: str, tokens: str, text: str = "text", lang: str = "lang", learn: bool = True, drop_text: bool = False) -> DataFrame:
    """``docs`` with columns ``topic`` (null unless learned) and ``tokens``, written to the shared folder but for the topics, which follow from vectors written there."""
    digest, vector, key, offset = fresh(docs.select("*", F.lit(0).alias(topic), F.lit(0).alias(tokens)), "digest", "vector", "key", "offset")
    hashed = docs.withColumn(digest, F.xxhash64(F.col(text).cast("string")))
    kept = [f for f in hashed.schema.fields if not (drop_text and f.name == text)]
    schema = StructType([*kept, StructField(vector, BinaryType()), StructField(tokens, LongType())])
    rows = materialize(hashed.mapInArrow(Lean(_described, path=path, text=docs.columns.index(text), learn=learn, drop=drop_text), schema), "described")
    names = [f.name for f in kept if f.name != digest]
    if not learn:
        return rows.select(*names, F.lit(None).cast("string").alias(topic), tokens)
    name = F.coalesce(F.col(lang).cast("string"), F.lit(""))
    centres, offsets = fit_topics(rows.select(name.alias("lang"), F.col(vector).alias("vector"), F.col(digest).alias("digest")))

    def nearest(v: pa.Array, o: pa.Array) -> pa.Array:
        o = o.fill_null(bytes(8 * len(centres))).cast(pa.binary(8 * len(centres)))
        base = np.frombuffer(b"".join(o.to_pylist())).reshape(-1, len(centres))
        return pa.array([f"t{k}" for k in (base - 2 * _matrix(v.fill_null(bytes(2 * BUCKETS))) @ centres.T).argmin(axis=1)], pa.string())

    found = F.arrow_udf(nearest, "string")(F.col(vector), F.col(offset))
    rows = rows.join(offsets.toDF(key, offset), name == F.col(key), "left")
    return rows.select(*names, F.when(F.col(vector).isNull(), "none").otherwise(found).alias(topic), tokens)


def probabilities(rows: DataFrame, columns: dict[str, str], tokens: str, into: str, targets: dict | None = None, budget: float = BUDGET) -> tuple[DataFrame, dict]:
    """``rows`` with the calibrated probability ``into``, and the report (gap, capped).

    ``columns`` names the column of each dimension; ``targets`` maps source, lang and topic to {value: share}, and dimensions left out get the
    tempered shares.
    """
    dims = list(DIMS)
    cells = rows.select(*[F.col(columns[d]).cast("string").alias(d) for d in dims], F.col(tokens).alias("w")).groupBy(*dims).agg(F.sum("w").alias("w"))
    cells = materialize(cells, "cells")
    n = cells.count()
    found, report = (_on_driver if n <= MAX_CELLS else _on_cells)(cells, dims, targets or {}, budget)
    if report["gap"] > 1e-4:
        warnings.warn(f"raking left a gap of {report['gap']:.5f} of the budget; the targets cannot all be met together", stacklevel=2)
    names = fresh(rows, *[f"c_{d}" for d in dims], "c_p")
    found = found.toDF(*names)
    if n <= MAX_BROADCAST_CELLS:
        found = F.broadcast(found)
    same = F.lit(True)
    for d, c in zip(dims, names, strict=False):
        same = same & F.col(columns[d]).cast("string").eqNullSafe(F.col(c))
    return rows.join(found, same, "left").withColumn(into, F.col(names[-1])).drop(*names), report


def _on_driver(cells: DataFrame, dims: list[str], targets: dict, budget: float) -> tuple[DataFrame, dict]:
    found = sorted(cells.collect(), key=lambda r: [(r[d] is not None, r[d] or "") for d in dims])
    w = np.array([float(r["w"]) for r in found])
    total, codes, wants, capped = budget * w.sum(), [], [], []
    for d in dims:
        place: dict = {}
        codes.append(np.array([place.setdefault(r[d], len(place)) for r in found], int))
        have = np.bincount(codes[-1], w, len(place))
        want = targets.get(d) or tempered(dict(zip(place, have.tolist(), strict=True)), TEMPER[d])
        share = np.array([float(want.get(k, 0)) for k in place])
        wants.append(feasible(share / (share.sum() or 1), have, total))
        capped += [(d, k) for k, i in place.items() if wants[-1][i] >= have[i] * _FULL and budget < 1]
    x, gap = rake(w, codes, wants) if len(w) else (w, 0.0)
    schema = "c_source string, c_lang string, c_topic string, p double"
    rows = [(*[r[d] for d in dims], float(p)) for r, p in zip(found, np.minimum(1, x / np.where(w > 0, w, 1)), strict=True)]
    return cells.sparkSession.createDataFrame(rows, schema), {"gap": gap, "capped": capped}


def _on_cells(cells: DataFrame, dims: list[str], targets: dict, budget: float) -> tuple[DataFrame, dict]:
    spark, wanted, capped = cells.sparkSession, [], []
    total = budget * (cells.agg(F.sum("w")).first()[0] or 0)
    for d in dims:
        have = cells.groupBy(d).agg(F.sum("w").cast("double").alias("have"))
        if targets.get(d):
            t = spark.createDataFrame([(k, float(v)) for k, v in targets[d].items()], "t string, share double")
            have = have.join(t, F.col(d).eqNullSafe(F.col("t")), "left").select(d, "have", F.coalesce("share", F.lit(0.0)).alias("share"))
        else:
            have = have.withColumn("share", F.pow("have", F.lit(TEMPER[d])))
        t = materialize(have.withColumn("free", F.lit(True)), "wanted")
        while True:
            sums = t.agg(F.sum(F.when(~F.col("free"), F.col("have"))).alias("held"), F.sum(F.when(F.col("free"), F.col("share"))).alias("share")).first()
            per = (total - (sums["held"] or 0.0)) / sums["share"] if sums["share"] else 0.0
            over = F.col("free") & (F.col("share") * per > F.col("have"))
            if t.filter(over).isEmpty():
                break
            t = materialize(t.withColumn("free", F.col("free") & ~over), "wanted")
        want = F.least("have", F.when(F.col("free"), F.col("share") * per).otherwise(F.col("have")))
        wanted.append(materialize(t.select(d, want.alias("want")), "wanted"))
        # a report, so only the first of them are named
        capped += [(d, r[d]) for r in t.filter(~F.col("free")).limit(1000).collect()]
    out, gap = rake_frame(cells, dims, wanted)
    return out.select(*dims, F.least(F.lit(1.0), F.col("x") / F.col("w"))), {"gap": gap, "capped": capped}


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), doc_id.cast("long")), 11) / F.lit(float(1 << 53))


def assign(docs: DataFrame, path: str, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None, targets: dict | None = None, budget: float = BUDGET) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability and sampled for every row."""
    given = [F.col(topic).cast("string").alias("given")] if topic else []
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), *given)
    rows = described(slim, path, "topic", "tokens", learn=not topic, drop_text=True)
    if topic:
        rows = rows.withColumn("topic", F.col("given")).drop("given")
    out, _ = probabilities(rows, {d: d for d in DIMS}, "tokens", "probability", targets, budget)
    return out.withColumn("sampled", uniform(F.col("doc_id"), seed) < F.col("probability"))


def marginals(assigned: DataFrame, dimension: str) -> DataFrame:
    """(value, share, expected) of one dimension: its share of all tokens and of the expected sample's."""
    kept = F.sum(F.col("tokens") * F.col("probability"))
    sums = assigned.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").alias("t"), kept.alias("k"))
    whole = assigned.agg(F.sum("tokens").alias("all_t"), kept.alias("all_k"))
    return sums.join(F.broadcast(whole), F.lit(True)).select("value", (F.col("t") / F.col("all_t")).alias("share"), (F.col("k") / F.col("all_k")).alias("expected"))


def sample(docs: DataFrame, path: str, seed: int = 0, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: str | None = None, targets: dict | None = None, budget: float = BUDGET) -> DataFrame:
    """The sampled rows of ``docs`` with its columns."""
    learned, tokens, p = fresh(docs, "topic", "tokens", "p")
    rows = described(docs, path, learned, tokens, text, lang, learn=not topic)
    out, _ = probabilities(rows, {"source": source, "lang": lang, "topic": topic or learned}, tokens, p, targets, budget)
    return out.filter(uniform(F.col(doc_id), seed) < F.col(p)).select(*docs.columns)
