"""Shards cut from a Hilbert-curve ordering (DataFrame expressions only).

Several metadata columns are quantised to ``BITS`` bits each, a Hilbert index joins them, rows are sorted
by it and cut into equal runs. Rows near each other in all dimensions share a shard, so a reader can skip
files by the minima and maxima of any of the dimensions: ``statistics`` has them by shard, ``touched`` names the shards that a range may be in.

The law is ``rows``: counts differ by one at most. Equal texts take the curve index of the one with the smallest doc_id, and the order is curve
index, hash of the text, doc_id; so a group of equal texts lies side by side whatever its rows' metadata, and is cut only where a shard ends inside it,
because equal counts leave no other way when one group holds a third of all rows.

Dimensions are cut where the cells hold equally many rows, numbers by quantile sketches, strings by the order of whole values.

Defined results: null metadata takes the lowest cell; null text has size 1 and the crc of the empty string; very long texts are read whole;
ties and repeated rows get slots of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import cell_of, let, materialize, ranked

BITS = 5
SHARDS = 16
#: Runs of distinct strings that are counted for the cells' bounds.
FINE = 4096
#: So many groups of equal texts with unequal metadata are broadcast (16 bytes each); more are joined by shuffle.
MAX_BROADCAST_GROUPS = 1_000_000


def hilbert_index(coords: list[Column], bits: int = BITS) -> Column:
    """Hilbert index of integer coordinates below 2**bits, as a fold over bit planes (Skilling's transform).

    The fold's accumulator binds every intermediate value, so the expression stays small.
    """
    n = len(coords)
    if n * bits > 62:
        raise ValueError("dimensions times bits must stay below 63")
    zero = F.array(*[c.cast("long") for c in coords])

    def bit(x: Column, q: Column) -> Column:
        return x.bitwiseAND(q) != 0

    def undo(x: Column, step: Column) -> Column:
        i = (step % n).cast("int")
        q = F.call_function("shiftleft", F.lit(1).cast("long"), (bits - 1 - F.floor(step / n)).cast("int"))
        p = q - 1
        first, own = F.get(x, F.lit(0)), F.get(x, i)
        swap = first.bitwiseXOR(own).bitwiseAND(p)
        inverted = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(p)).otherwise(v))
        # when i is 0 the swap is 0 and nothing changes
        swapped = F.transform(x, lambda v, j: F.when((j == 0) | (j == i), v.bitwiseXOR(swap)).otherwise(v))
        return F.when(bit(own, q), inverted).otherwise(swapped)

    turned = F.aggregate(F.sequence(F.lit(0), F.lit(n * (bits - 1) - 1)), zero, undo)
    # Gray encode: running xor over the dimensions
    gray = let(
        turned,
        lambda x: F.transform(
            x, lambda v, i: F.aggregate(F.slice(x, F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))
        ),
    )

    def finish(g: Column) -> Column:
        last = F.element_at(g, -1)

        def parity(t: Column, b: Column) -> Column:
            q = F.call_function("shiftleft", F.lit(1).cast("long"), b)
            return F.when(bit(last, q), t.bitwiseXOR(q - 1)).otherwise(t)

        t = F.aggregate(F.sequence(F.lit(bits - 1), F.lit(1)), F.lit(0).cast("long"), parity)

        def put(acc: Column, step: Column) -> Column:
            b = (bits - 1 - F.floor(step / n)).cast("int")
            v = F.get(g, (step % n).cast("int")).bitwiseXOR(t)
            one = F.call_function("shiftright", v, b).bitwiseAND(F.lit(1).cast("long"))
            return F.call_function("shiftleft", acc, F.lit(1)).bitwiseOR(one)

        return F.aggregate(F.sequence(F.lit(0), F.lit(n * bits - 1)), F.lit(0).cast("long"), put)

    return let(gray, finish)


def string_bounds(docs: DataFrame, column: str, cells: int = 1 << BITS) -> list[str]:
    """At most ``cells`` - 1 values that cut the ordered strings into runs of about equally many rows.

    The distinct values are range-sorted and gathered into at most ``FINE`` runs, whose first values and row counts come to the driver.
    """
    values = docs.groupBy(F.col(column).cast("string").alias("v")).agg(F.count(F.lit(1)).alias("n")).filter("v is not null")
    runs = ranked(values, [F.col("v")], "rank", "total", "values").groupBy(F.expr(f"(rank * {FINE}) div total")).agg(F.min("v").alias("v"), F.sum("n").alias("n"))
    found = sorted(runs.select("v", "n").collect(), key=lambda r: r["v"].encode("utf-8", "surrogatepass"))
    total, before, bounds = sum(r["n"] for r in found), 0, []
    for r in found:
        # as many bounds as cells that the rows before the run fill; a frequent value has several
        bounds += [r["v"]] * (before * cells // total - len(bounds))
        before += r["n"]
    return bounds


def cells_of(docs: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """Each dimension's cell (0 to 2**bits - 1) as a column over ``docs``."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    kinds, cuts = dict(docs.dtypes), (1 << bits) - 1
    numbers = [d for d in dims if kinds[d] in numeric or kinds[d].startswith("decimal")]
    value = {d: F.nanvl(F.col(d).cast("double"), F.lit(None).cast("double")) for d in numbers}
    at = F.array(*[F.lit((i + 1) / (cuts + 1)) for i in range(cuts)])
    row = docs.agg(*[F.percentile_approx(value[d], at, 2000).alias(f"q{i}") for i, d in enumerate(numbers)]).first() if numbers else []
    bounds = {d: sorted(q or []) for d, q in zip(numbers, row, strict=True)}
    out = []
    for d in dims:
        if d in bounds:
            out.append(cell_of(value[d], bounds[d]))
        else:
            edges = string_bounds(docs, d, 1 << bits)
            out.append(_runs_before(F.col(d).cast("string"), edges) if edges else F.lit(0))
    return out


def _runs_before(text: Column, edges: list[str]) -> Column:
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e <= text)), F.lit(0))


def shard(docs: DataFrame, dims: list[str], shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the curve index for every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"),
        F.xxhash64(t).alias("text_hash"),
        hilbert_index(cells_of(docs, dims)).alias("own"),
    )
    slim = materialize(slim, "keys")
    # only texts whose rows differ in metadata need another key than their own
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("own").alias("own")))
    moved = slim.groupBy("text_hash").agg(first.alias("m"), F.min("own").alias("low"), F.max("own").alias("high")).filter("low < high")
    moved = materialize(moved.select(F.col("text_hash").alias("g_hash"), F.col("m.own").alias("common")), "groups")
    few = moved.count() <= MAX_BROADCAST_GROUPS
    keyed = slim.join(F.broadcast(moved) if few else moved, F.col("text_hash") == F.col("g_hash"), "left")
    placed = ranked(
        keyed.select("doc_id", "size", "text_crc32", "text_hash", F.coalesce("common", "own").alias("curve")),
        [F.col("curve"), F.col("text_hash"), F.col("doc_id")],
        "rank",
        "total",
        "shards",
    )
    # shard s holds the ranks from ceil(s * total / shards) on
    s = F.expr(f"(rank * {shards}) div total")
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", s.cast("int"))
        .withColumn("slot", (F.col("rank") - start).cast("long"))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
            "curve",
        )
    )


def statistics(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """(shard, n, and min_ and max_ of each dimension): what a reader needs to skip shards. Nulls are outside every range."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), *[f(d).alias(f"{n}_{d}") for d in dims for f, n in ((F.min, "min"), (F.max, "max"))])


def touched(stats: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """The shards that may hold rows with every dimension inside its (low, high) range, ends included."""
    for d, (low, high) in ranges.items():
        stats = stats.filter((F.col(f"max_{d}") >= F.lit(low)) & (F.col(f"min_{d}") <= F.lit(high)))
    return stats.select("shard")
