"""Near duplicates by HyperMinHash, confirmed on whole shingle sets.

A text's set of word shingles gives ``REGISTERS`` registers. A shingle falls into one bucket, whose register
keeps the smallest hash; a bucket that no shingle reached takes the smallest hash of all shingles under
a permutation of its own, so two registers agree with probability J whatever the sets' sizes. A register is stored as its
count of leading zeros (6 bits) and ``MANTISSA`` further bits. Bands of ``ROWS`` registers are hashed to keys.

1. Texts with equal sets form a class; all later steps handle classes.
2. In each band key the smallest class is the hub; (hub, member) pairs are candidates.
3. Candidates whose collision-corrected estimate is near the threshold or above are compared on their whole sets.
4. Confirmed links give components. Members outside the component that is most frequent in their key are compared with
   its best linked class; those still outside, with every member of it and with each other. After that every pair of
   a key has been compared or is connected already, though never listed within a tight group.

At J = 0.8 a pair shares no band with probability (1 - 0.8**8)**48 = 1.4e-4; above, less.

Defined results: null or blank texts are empty, linked with nothing and keep their place; ties and repeated rows belong to
one class; very long texts are compared whole; rows of equal doc_id keep their own texts, and component_id is the smallest id of the component. Rows of null doc_id are linked
as others are, but null is never the smallest id unless no row of the component has one. Empty tables give empty results; other columns, whatever their names,
are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import Lean, discard, fresh, materialize, release
from quillcast.llm.graph import components

REGISTERS, ROWS, MANTISSA = 384, 8, 10
#: The estimate's standard deviation at 0.8 is 0.02; pairs this far under the threshold are still compared.
MARGIN = 0.1
#: Expected share of registers that agree by chance at equal sizes, times 2**MANTISSA (HyperMinHash paper).
COLLISION = 0.169919487159739
#: A list of ids up to this long is broadcast (8 bytes each); longer ones are joined by shuffle.
MAX_BROADCAST_IDS = 1_000_000
CACHE_WORDS = 200_000
#: Sizes of the blocks that are compared in one task.
BLOCK_LEFT, BLOCK_RIGHT, BLOCK_SHINGLES, BUNDLE_ROWS = 128, 512, 400_000, 1500

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SEEDS = np.random.default_rng(20240601).integers(1, 1 << 63, size=(2, REGISTERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, kept for words seen before; emptied when it grows over a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``width`` words."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(width, n)
    out = np.full(n - k + 1, np.uint64(k))
    for i in range(k):
        out = mix(out * _STEP + h[i : n - k + 1 + i])
    return np.unique(out)


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed registers (leading zeros << MANTISSA | mantissa) of a non-empty set."""
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    place = ((shingles >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    low = np.full(REGISTERS, top)
    np.minimum.at(low, place.astype(np.int64), mix(shingles + _STEP))
    (empty,) = np.nonzero(low == top)
    if len(empty):
        low[empty] = ((shingles[:, None] ^ _SEEDS[0, empty]) * _SEEDS[1, empty]).min(axis=0)
    _, bits = np.frexp((low >> np.uint64(11)).astype(np.float64))
    zeros = (53 - bits).astype(np.uint64)
    mantissa = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    return ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def band_keys(regs: np.ndarray) -> np.ndarray:
    lanes = regs.view(np.uint64).reshape(REGISTERS // ROWS, -1)
    key = np.arange(len(lanes), dtype=np.uint64)
    for i in range(lanes.shape[1]):
        key = mix(key * _STEP + lanes[:, i])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> float:
    """Jaccard similarity from registers, corrected for chance collisions of compressed values."""
    ratio = max(na, 1) / max(nb, 1)
    chance = COLLISION * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return float((np.count_nonzero(a == b) / REGISTERS - chance) / (1 - chance))


def _class_id(s: np.ndarray) -> int:
    sums = np.array([mix(s + np.uint64(11)).sum(dtype=np.uint64), mix(s ^ _M2).sum(dtype=np.uint64)])
    return int(mix(sums[:1] * _STEP + sums[1:] + np.uint64(len(s))).view(np.int64)[0])


def _sketch(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        n, cid, regs, keys = [], [], [], []
        for text in batch.column(3):
            s = shingle_set(text.as_py(), width, hashes)
            n.append(len(s))
            if len(s):
                r = registers(s)
                cid.append(_class_id(s))
                regs.append(r.tobytes())
                keys.append(band_keys(r))
            else:
                cid.append(None)
                regs.append(None)
                keys.append(None)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(regs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "t1", "t2", "n", "cid", "regs", "keys"],
        )


def _named_texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, t1, t2, text): two hashes name a text, as ids may be null or repeat."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return slim.select("doc_id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text")


def sketch(texts: DataFrame, width: int) -> DataFrame:
    """(doc_id, t1, t2, n, cid, regs, keys) of every row: set size, class, registers and band keys."""
    return texts.mapInArrow(Lean(_sketch, width=width), "doc_id long, t1 long, t2 long, n long, cid long, regs binary, keys array<long>")


def _estimates(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        ra, rb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
        na, nb = (batch.column(i).to_numpy().astype(float) for i in (4, 5))
        ratio = na / nb
        chance = COLLISION * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
        j = ((ra == rb).mean(axis=1) - chance) / (1 - chance)
        yield batch.select([0, 1]).filter(pa.array(j >= threshold - MARGIN))


def _confirmed(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    hashes, last, last_set = WordHashes(), None, None
    for batch in batches:
        keep = []
        hubs = batch.column(0).to_pylist()
        for i, hub in enumerate(hubs):
            if hub != last:
                last, last_set = hub, shingle_set(batch.column(2)[i].as_py(), width, hashes)
            other = shingle_set(batch.column(3)[i].as_py(), width, hashes)
            keep.append(_similar(last_set, other, percent))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _texts(named: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(cid, text) of the classes named, written to the shared folder: the text of each one's chosen row."""
    wanted = materialize(named.join(reps.select("cid", "t1", "t2"), "cid"), "wanted")
    few = wanted.count() <= MAX_BROADCAST_IDS
    texts = docs.join(F.broadcast(wanted) if few else wanted, ["t1", "t2"]).select("cid", "text")
    found = materialize(texts.groupBy("cid").agg(F.any_value("text").alias("text")), "texts")  # copies of a text come as one
    discard(wanted)
    return found


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def _links(pairs: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b: classes) whose sets are similar enough, written to the shared folder."""
    side = reps.select("cid", "regs", "n")
    near = (
        pairs.join(side.select(F.col("cid").alias("a"), F.col("regs").alias("ra"), F.col("n").alias("na")), "a")
        .join(side.select(F.col("cid").alias("b"), F.col("regs").alias("rb"), F.col("n").alias("nb")), "b")
        .select("a", "b", "ra", "rb", "na", "nb")
        .mapInArrow(Lean(_estimates, threshold=percent / 100), "a long, b long")
    )
    near = materialize(near, "near")
    named = near.select(F.col("a").alias("cid")).union(near.select(F.col("b").alias("cid"))).distinct()
    texts = _texts(named, reps, docs)
    left, right = texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), texts.select(F.col("cid").alias("b"), F.col("text").alias("tb"))
    both = near.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
    found = materialize(both.mapInArrow(Lean(_confirmed, width=width, percent=percent), "a long, b long"), "links")
    discard(near, texts)
    return found


def _placed(df: DataFrame, comp: DataFrame, node: str, name: str) -> DataFrame:
    """Add each node's component (itself, where it has no link)."""
    c = comp.select(F.col("node").alias(node), F.col("comp").alias("c"))
    return df.join(c, node, "left").withColumn(name, F.coalesce("c", node)).drop("c")


def _both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _homes(at: DataFrame) -> DataFrame:
    """For each key with several components: the one with most members there, and how many."""
    sizes = at.groupBy("key", "own").agg(F.count(F.lit(1)).alias("k"))
    homes = sizes.groupBy("key").agg(F.max(F.struct("k", "own")).alias("m"), F.count(F.lit(1)).alias("comps"))
    return homes.filter("comps > 1").select("key", F.col("m.own").alias("home"), F.col("m.k").alias("home_k"))


def _through_centres(rows: DataFrame, links: DataFrame, tried: DataFrame, reps: DataFrame, slim: DataFrame, width: int, percent: int):
    """Pair members outside their key's main component with that component's best linked class."""
    comp = materialize(components(links), "components")
    degrees = _both_ways(links).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("d"))
    centres = comp.join(degrees, "node").groupBy("comp").agg(F.max(F.struct("d", "node")).alias("m")).select(F.col("comp").alias("home"), F.col("m.node").alias("centre"))
    at = _placed(rows.select("key", "cid"), comp, "cid", "own")
    out = at.join(_homes(at), "key").filter("own <> home").select("cid", "home").distinct()
    pairs = out.join(centres, "home").select(F.col("centre").alias("a"), F.col("cid").alias("b"))
    pairs = materialize(pairs.distinct().join(_both_ways(tried), ["a", "b"], "left_anti"), "centres")
    more = _links(pairs, reps, slim, width, percent)
    links = links.union(more)
    return links, materialize(components(links), "components")


def _left_over(rows: DataFrame, comp: DataFrame, reps: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links among all pairs that share a key and are not connected yet.

    A member outside its key's main component meets that component either once, through the component's list of
    members, or key by key, whichever is fewer rows; members outside meet each other key by key. Both sides of a meeting are cut
    into blocks of bounded size, each pair of blocks is compared in one task, and only links leave it.
    """
    at = materialize(_placed(rows.select("key", "cid", "n"), comp, "cid", "own"), "places")
    homes = materialize(_homes(at), "homes")
    strays = at.join(homes, "key").filter("own <> home")
    strays = materialize(strays, "strays")
    members = at.select("cid", "n", "own").distinct()
    sizes = members.groupBy(F.col("own").alias("home")).agg(F.count(F.lit(1)).alias("size"))
    meetings = strays.groupBy("cid", "home").agg(F.sum("home_k").alias("by_key")).join(sizes, "home")
    meetings = materialize(meetings.withColumn("listed", F.col("size") <= F.col("by_key")), "meetings")
    what = ["kind", "g", "cid", "n", "own"]
    marked = strays.join(meetings.select("cid", "home", "listed"), ["cid", "home"])
    left = (
        marked.filter("listed").select(F.lit(0).alias("kind"), F.col("home").alias("g"), "cid", "n", "own").distinct()
        .union(marked.filter("not listed").select(F.lit(1).alias("kind"), F.col("key").alias("g"), "cid", "n", "own"))
        .union(strays.select(F.lit(2).alias("kind"), F.col("key").alias("g"), "cid", "n", "own"))
    )
    main = at.join(homes, "key").filter("own = home")
    right = (
        members.join(meetings.filter("listed").select(F.col("home").alias("own")).distinct(), "own").select(F.lit(0).alias("kind"), F.col("own").alias("g"), "cid", "n", "own")
        .union(main.join(marked.filter("not listed").select("key").distinct(), "key").select(F.lit(1).alias("kind"), F.col("key").alias("g"), "cid", "n", "own"))
        .union(strays.select(F.lit(2).alias("kind"), F.col("key").alias("g"), "cid", "n", "own"))
    )
    left, right = materialize(left.select(*what), "left"), materialize(right.select(*what), "right")
    texts = _texts(left.select("cid").union(right.select("cid")).distinct(), reps, docs)
    held = texts.join(reps.select("cid", "regs"), "cid")

    def blocks(df: DataFrame, rows_at_once: int, cut: str) -> DataFrame:
        cuts = F.greatest(F.ceil(F.count(F.lit(1)) / rows_at_once), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
        return df.groupBy("kind", "g").agg(cuts.alias(cut), F.sum("n").alias(f"{cut}_n"), F.count(F.lit(1)).alias(f"{cut}_rows"))

    cuts = materialize(blocks(left, BLOCK_LEFT, "cl").join(blocks(right, BLOCK_RIGHT, "cr"), ["kind", "g"]), "cuts")
    small = cuts.filter("cl * cr = 1").agg(F.sum(F.col("cl_rows") + F.col("cr_rows")).alias("rows"), F.sum(F.col("cl_n") + F.col("cr_n")).alias("n")).first()
    bundles = max(1, (small["rows"] or 0) // BUNDLE_ROWS, (small["n"] or 0) // BLOCK_SHINGLES)
    # meetings of one block each are bundled by hash, so that a task is never for a handful of rows
    task = F.when(F.col("cl") * F.col("cr") == 1, F.pmod(F.xxhash64("kind", "g"), F.lit(bundles))).otherwise(F.xxhash64("kind", "g", "bl", "br"))

    def dealt(df: DataFrame, own: str, other: str, own_block: str, other_block: str) -> DataFrame:
        placed = df.join(cuts.select("kind", "g", "cl", "cr"), ["kind", "g"]).withColumn(own_block, F.pmod(F.xxhash64("cid"), F.col(own)).cast("int"))
        spread = placed.withColumn(other_block, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return spread.join(held, "cid").select(task.alias("task"), "kind", "g", "bl", "br", "cid", "n", "own", "regs", "text")

    one, two = dealt(left, "cl", "cr", "bl", "br"), dealt(right, "cr", "cl", "br", "bl")
    two = two.select(F.col("task").alias("r_task"), *[F.col(c).alias(c) for c in two.columns if c != "task"])
    found = one.groupBy("task").cogroup(two.groupBy("r_task")).applyInPandas(partial(_meet, width=width, percent=percent), "a long, b long")
    links = materialize(found.distinct(), "links")
    discard(at, homes, strays, meetings, left, right, texts, cuts)
    return links


def _meet(left: pd.DataFrame, right: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    """Links between blocks: by estimate first, then on whole sets; one link to a component is enough."""
    out: list[tuple[int, int]] = []
    keys, hashes, sets = ["kind", "g", "bl", "br"], WordHashes(), {}

    def whole(cid: int, text: bytes) -> np.ndarray:
        if cid not in sets:
            sets[cid] = shingle_set(text, width, hashes)
        return sets[cid]

    if len(left) and len(right):
        regs = np.frombuffer(b"".join(right["regs"]), np.uint16).reshape(-1, REGISTERS)
        n, own, cid, texts = right["n"].to_numpy(float), right["own"].to_numpy(), right["cid"].to_numpy(), right["text"].to_numpy()
        at = right.groupby(keys).indices
        for row in left.itertuples():
            i = at.get((row.kind, row.g, row.bl, row.br))
            if i is None:
                continue
            i = i[(own[i] != row.own) & (100 * np.minimum(n[i], row.n) >= percent * np.maximum(n[i], row.n))]
            if row.kind == 2:
                i = i[cid[i] > row.cid]
            if not len(i):
                continue
            ratio = row.n / n[i]
            chance = COLLISION * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
            agree = (regs[i] == np.frombuffer(row.regs, np.uint16)).mean(axis=1)
            met = set()
            for j in i[(agree - chance) / (1 - chance) >= percent / 100 - MARGIN]:
                if own[j] not in met and _similar(whole(row.cid, row.text), whole(cid[j], texts[j]), percent):
                    out.append((row.cid, cid[j]))
                    met.add(own[j])
    sets.clear()
    hashes.clear()
    release()
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id and row for every row of ``docs``."""
    slim = _named_texts(docs, doc_id, text)
    s = materialize(sketch(slim, width), "sketch")
    full = s.filter("n > 0")
    classes = full.groupBy("cid").agg(F.min("doc_id").alias("least"))
    # one row for each class: the first of those with its smallest id
    reps = full.alias("s").join(classes.alias("c"), (F.col("s.cid") == F.col("c.cid")) & F.col("s.doc_id").eqNullSafe(F.col("c.least"))).select("s.*")
    reps = materialize(reps.dropDuplicates(["cid"]), "classes")
    rows = reps.select("cid", "n", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("most")).filter("hub < most").select("key", "hub")
    rows = materialize(rows.join(shared, "key"), "bands")
    fits = (100 * F.least("na", "n") >= percent * F.greatest("na", "n")) & (F.col("a") != F.col("b"))
    hubs = reps.select(F.col("cid").alias("hub"), F.col("n").alias("na"))
    stars = rows.select("hub", "cid", "n").distinct().filter("hub <> cid").join(hubs, "hub").select(F.col("hub").alias("a"), F.col("cid").alias("b"), "na", "n")
    tried = materialize(stars.filter(fits).select("a", "b"), "stars")
    links = _links(tried, reps, slim, width, percent)
    links, comp = _through_centres(rows, links, tried, reps, slim, width, percent)
    more = _left_over(rows, comp, reps, slim, width, percent)
    if not more.isEmpty():
        comp = materialize(components(links.union(more)), "components")
    discard(rows, reps, tried)
    classes = _placed(classes.withColumnRenamed("cid", "node_id"), comp, "node_id", "root")
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = classes.join(smallest, "root").select(F.col("node_id").alias("cid"), "component_id")
    out = s.select("doc_id", "n", "cid").join(labels, "cid", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), F.col("cid").alias("class_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, its smallest id's, with the columns of ``docs``; rows without words all stay."""
    ids = docs.select(F.col(doc_id).cast("long").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("rows"))
    key, g, place = fresh(docs, "key", "g", "place")
    if ids.filter("g is null or rows > 1").isEmpty():
        found = materialize(near_duplicates(docs, width, percent, doc_id, text), "near-duplicates")
        gone = found.filter("not kept").select(F.col("doc_id").alias(g))
        few = gone.count() <= MAX_BROADCAST_IDS
        return docs.join(F.broadcast(gone) if few else gone, F.col(doc_id).cast("long") == F.col(g), "left_anti")
    # ids that are null or repeat name no row, so rows get numbers of their own
    marked = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "rows")
    found = near_duplicates(marked, width, percent, key, text).select(F.col("doc_id").alias("row"), "component_id")
    named = marked.select(F.col(key).alias("row"), F.col(doc_id).cast("long").alias("g")).join(found, "row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("g").isNull().alias("none"), "g", "row")).alias("m"))
    chosen = materialize(first.select(F.col("m.row").alias(place)), "chosen")
    return marked.join(chosen, F.col(key) == F.col(place), "left_semi").select(*docs.columns)
