"""Language-model scoring by a probabilistic suffix tree over words.

Symbols are lower-cased words and one end per text. A state is a context of up to ``DEPTH`` words that training saw ``LEAST`` times or
more and whose next-symbol counts differ from those of its suffix (the context without its oldest word): it is retained when the
divergence of the two empirical distributions over the kept entries, times its count, is ``DIVERGENCE`` or more. An entry (state, next word) is kept when it was
seen ``LEAST`` times or more. These are counts, not shares, so states and entries grow with the corpus.

A state's distribution: each kept entry has its discounted share, and what is left goes to all symbols by the distribution of the
longest retained suffix, down to the root's additive smoothing over all words; so every distribution sums to one. A text's score is the sum
over its symbols from the longest suffix state of its history.

No task and no driver holds the tree or the words. Texts become bundles of word places, written once. Slices of the bundles' words, cut by
hash, are counted and numbered each in one task, and the bundles get their words' counts and numbers back. Each position sends its last four words to the task of
its previous word, in packed blocks; all contexts that end in this word, the branch of the tree, live there, are counted, tested and used there,
and only the texts' sums leave. The branch of a word more frequent than a task should hold is split by the word before it, so that longer contexts stay whole;
the splits first add up the counts of the word's own entries, in packed slices. Branches are dealt to ``WAVES`` waves, one after the other: each wave's
sums are written before the next sends its positions, so that no more than a wave's share of them is on disk at once.

Defined results: null and blank texts have the end only; very long texts are one bundle each; repeated rows are scored alike and all counted in
training; null ids stay; with no training texts N and V are 0 and the score equals the base score; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import Lean, discard, drop_shuffles, materialize, release

DEPTH = 3
LEAST = 2
DISCOUNT, DIVERGENCE = 0.75, 4.0
END = b"\n"  # no word holds a line break
#: Tokens of a bundle of texts, and positions that one task holds of a branch.
BUNDLE_TOKENS, PART_WINDOWS = 800_000, 750_000
#: Words of bundles that one task counts and numbers.
SLICE_WORDS = 1_000_000
#: Shares of the branches that send their positions in turn.
WAVES = 2


def word_hash(word: bytes) -> int:
    """A signed 64-bit number for each word."""
    import xxhash

    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def tokens(text: bytes | None) -> list[bytes]:
    out = (text or b"").lower().split()
    out.append(END)
    return out


def _packed(*columns: np.ndarray) -> bytes:
    """Unsigned 32-bit columns of equal length as compressed byte planes."""
    import zstandard

    planes = [np.ascontiguousarray(c, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(data: bytes, n: int, columns: int = 1) -> np.ndarray:
    """The columns of ``_packed`` as rows of an array (``columns`` counts only where they are empty)."""
    import zstandard

    if not n:
        return np.zeros((columns, 0), "<u4")
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(-1, 4, n).transpose(0, 2, 1)).view("<u4").reshape(-1, n)


def _steps(x: np.ndarray) -> np.ndarray:
    """Differences of neighbours, small where these are near, as unsigned numbers."""
    d = np.diff(x.astype(np.int64), prepend=0)
    return (d << 1) ^ (d >> 63)


def _summed(steps: np.ndarray) -> np.ndarray:
    steps = steps.astype(np.int64)
    return np.cumsum((steps >> 1) ^ -(steps & 1))


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as word places in a bundle's own sorted list of word hashes, with each word's training count."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    docs, learn, sizes, flat, place = [], [], [], [], {}

    def flush() -> pa.RecordBatch:
        nonlocal number
        hashes = np.array([word_hash(w) for w in place], np.int64)
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = rank[np.array(flat, np.int64)]
        counts = np.bincount(at[np.repeat(np.array(learn, bool), sizes)], minlength=len(order))
        lists = pa.array([docs], pa.list_(pa.int64())), pa.array([learn], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int32()))
        words = pa.array([hashes[order]], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64()))
        out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, *words, pa.array([_packed(at)], pa.binary())], ["bundle", "docs", "learn", "sizes", "words", "counts", "data"])
        number += 1
        for x in (docs, learn, sizes, flat, place):
            x.clear()
        return out

    for batch in batches:
        for doc, may, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            words = tokens(text.as_py())
            flat += [place.setdefault(w, len(place)) for w in words]
            docs.append(doc)
            learn.append(bool(may))
            sizes.append(len(words))
            if len(flat) >= BUNDLE_TOKENS:
                yield flush()
    if docs:
        yield flush()


def _slices(batches: Iterator[pa.RecordBatch], slices: int) -> Iterator[pa.RecordBatch]:
    """The words of bundles cut into runs of equal ranges of their (sorted) hashes."""
    edges = np.array([-(1 << 63) + (i << 64) // slices for i in range(1, slices)], np.int64)
    for batch in batches:
        for bundle, words, counts in zip(*(batch.column(k) for k in range(3)), strict=True):
            h, c = words.values.to_numpy(zero_copy_only=False), counts.values.to_numpy(zero_copy_only=False)
            cuts = [0, *np.searchsorted(h, edges).tolist(), len(h)]
            rows = [(i, x, y) for i, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)) if y > x]
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([bundle.as_py()] * len(rows), pa.int64()), pa.array([r[2] - r[1] for r in rows], pa.int64())]
            data = pa.array([h[x:y].tobytes() for _, x, y in rows], pa.binary()), pa.array([_packed(c[x:y]) for _, x, y in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, *data], ["slice", "bundle", "size", "words", "counts"])


def _number(key, table, slices, limit):
    """Counts and numbers of a slice's words, for each bundle; and a row of sums (bundle -1) with the words over ``limit``."""
    at, sizes, names = key[0].as_py(), table.column("size").to_numpy(), table.column("bundle").to_numpy()
    h = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("words")])
    c = np.concatenate([_unpacked(x.as_py(), int(k))[0] for x, k in zip(table.column("counts"), sizes, strict=True)])
    words, place = np.unique(h, return_inverse=True)
    total = np.bincount(place, c, len(words)).astype(np.int64)
    # numbers from 1 on for words seen often enough, the frequent ones of every slice first; 0 for the rest
    order = np.lexsort((words, -total))
    number = np.empty(len(words), np.int64)
    number[order] = np.arange(len(words)) * slices + at + 1
    number[total < LEAST] = 0
    ends = np.cumsum(sizes)
    data = [_packed(total[place[e - k : e]], number[place[e - k : e]]) for e, k in zip(ends, sizes, strict=True)]
    hot = (total > limit) & (words != word_hash(END)) & (number > 0)
    n, lists = len(data), pa.list_(pa.int64())
    return pa.table({
        "slice": pa.array([at] * (n + 1), pa.int64()), "bundle": pa.array([*names, -1], pa.int64()), "size": pa.array([*sizes, 0], pa.int64()), "data": pa.array([*data, None], pa.binary()),
        "n": pa.array([0] * n + [int(total.sum())], pa.int64()), "v": pa.array([0] * n + [int((total > 0).sum())], pa.int64()),
        "hot": pa.array([[]] * n + [number[hot]], lists), "times": pa.array([[]] * n + [total[hot]], lists),
    })


def _with_numbers(key, bundle, numbers):
    """A bundle with the counts and numbers of its words in one block."""
    order = np.argsort(numbers.column("slice").to_numpy())
    sizes, data = numbers.column("size").to_numpy(), numbers.column("data")
    both = np.concatenate([_unpacked(data[int(i)].as_py(), int(sizes[i])) for i in order], axis=1)
    return bundle.append_column("known", pa.array([_packed(*both)], pa.binary())).append_column("n_known", pa.array([both.shape[1]], pa.int64()))


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Bundles with their words' counts and numbers: (bundle, docs, learn, sizes, places, counts, numbers)."""
    for batch in batches:
        for i in range(batch.num_rows):
            col = {n: batch.column(k)[i] for k, n in enumerate(batch.schema.names)}
            sizes = np.array(col["sizes"].values.to_numpy(zero_copy_only=False), np.int64)
            (at,) = _unpacked(col["data"].as_py(), int(sizes.sum()))
            counts, numbers = _unpacked(col["known"].as_py(), col["n_known"].as_py()).astype(np.int64)
            yield col["bundle"].as_py(), col["docs"].values, np.array(col["learn"].as_py(), bool), sizes, at, counts, numbers


def _base(batches: Iterator[pa.RecordBatch], n: int, v: int) -> Iterator[pa.RecordBatch]:
    for bundle, docs, _, sizes, at, counts, _ in _opened(batches):
        first = np.cumsum(sizes) - sizes
        root = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
        base, known = np.add.reduceat(root[at], first), np.add.reduceat((counts > 0)[at].astype(np.int64), first)
        columns = [docs, pa.array(sizes), pa.array(known), pa.array(base)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), c) for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array([bundle], pa.int64()), *lists], ["bundle", "docs", "n_tokens", "known", "base"])


def _spread(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


def _windows(batches: Iterator[pa.RecordBatch], parts: int, hot: dict[int, tuple[int, int]], depth: int, pairs: bool, wave: int, waves: int) -> Iterator[pa.RecordBatch]:
    """Blocks of positions by the task of their previous word: the three words before, the next word, its count, its text.

    With ``pairs``, only what splits share: each frequent word's next words in this bundle, their training counts and counts in all.
    Only branches of this ``wave`` are sent, all splits of a branch in the same one.
    """
    splits = np.ones(max(hot, default=0) + 2, np.int64)
    splits[list(hot)] = [k for k, _ in hot.values()]
    for bundle, _, learn, sizes, at, counts, numbers in _opened(batches):
        word, c = numbers[at], counts[at]
        text = np.repeat(np.arange(len(sizes)), sizes)
        first = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        before = [np.concatenate([np.zeros(k, np.int64), word[:-k] if k < len(word) else word[:0]])[: len(word)] * (first >= k) for k in (1, 2, 3)]
        (some,) = np.nonzero(before[0] > 0)
        w1, w = before[0][some], word[some]
        s = splits[np.minimum(w1, len(splits) - 1)]
        # where no longer context is, the position may go to any split
        j = (_spread(np.where(before[1][some] > 0, before[1][some], some + (1 << 33))) % s.astype(np.uint64)).astype(np.int64)
        rare = (_spread(w1) % np.uint64(parts)).astype(np.int64)
        (now,) = np.nonzero(np.where(s > 1, w1, rare) % waves == wave)
        part = np.where(s > 1, -1 - (w1 << 20 | j), rare)[now]
        some, w1, w, s = some[now], w1[now], w[now], s[now]
        if pairs:
            some, w, part = (x[s > 1] for x in (some, w, part))  # rare words stand together as 0, so every split sends something
            order = np.lexsort((w, part))
            some, w, part = some[order], w[order], part[order]
            new = np.nonzero(np.concatenate([[True], (np.diff(w) != 0) | (np.diff(part) != 0)]))[0] if len(w) else np.zeros(0, np.int64)
            train = learn[text[some]].astype(np.int64)
            columns = w[new], np.add.reduceat(train, new) if len(new) else train, c[some[new]]
            yield _blocks(bundle, part[new], columns)
            continue
        order = np.lexsort((w, w1, part))
        some, part = some[order], part[order]
        w2 = before[1][some] if depth > 1 else np.zeros(len(some), np.int64)
        w3 = before[2][some] * (w2 > 0) if depth > 2 else np.zeros(len(some), np.int64)
        t = text[some]
        columns = w1[order], w2, w3, w[order], c[some], t << 1 | learn[t]
        yield _blocks(bundle, part, columns, _positions)


def _positions(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, w: np.ndarray, c: np.ndarray, t: np.ndarray) -> bytes:
    """Positions sorted by previous and next word; each next word has its count once."""
    words, place = np.unique(w << np.int64(32) | c, return_inverse=True)
    known = _packed(_steps(words >> 32), _steps(words & 0xFFFFFFFF))
    return struct.pack("<II", len(words), len(known)) + known + _packed(_steps(w1), w2, w3, _steps(place), t)


def _opened_positions(data: bytes, n: int) -> np.ndarray:
    """The columns that ``_positions`` was given."""
    n_words, size = struct.unpack_from("<II", data)
    words, c = (_summed(x) for x in _unpacked(data[8 : 8 + size], n_words, 2))
    w1, w2, w3, place, t = _unpacked(data[8 + size :], n, 5)
    place = _summed(place)
    return np.stack([_summed(w1), w2, w3, words[place], c[place], t]).astype("<u4")


def _blocks(bundle: int, part: np.ndarray, columns: tuple, pack=_packed) -> pa.RecordBatch:
    """Columns sorted by ``part`` as one packed block for each."""
    cuts = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]]) if len(part) else np.zeros(1, np.int64)
    data = [pack(*(x[a:b] for x in columns)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[cuts[:-1]], pa.int64()), pa.array(np.full(len(data), bundle), pa.int64()), pa.array(np.diff(cuts), pa.int64()), pa.array(data, pa.binary())],
        ["part", "bundle", "n", "data"],
    )


class Branch:
    """The contexts and entries of one task's positions, for each depth from 1 on.

    ``shared``, of a split branch, is its word's count, its next words with their counts over all splits, and the sums over these.
    """

    def __init__(self, columns: np.ndarray, n_train: int, depth: int, shared: tuple | None = None):
        w1, w2, w3, w, c, text = columns.astype(np.int64)
        train, none = (text & 1).astype(bool), np.full(len(w), -1, np.int64)
        self.c, self.n_train = c, n_train
        self.state, self.entry, self.example, self.seen, self.kept, self.sums = [], [], [], [], [], []
        above_state, above_seen, above_entry = np.zeros(len(w), np.int64), None, None
        for d, older in enumerate((w1, w2, w3)[:depth]):
            ok = (older > 0) & (above_state >= 0)
            state = none.copy()
            _, example, state[ok] = np.unique(above_state[ok] << np.int64(32) | older[ok], return_index=True, return_inverse=True)
            self.example.append(np.nonzero(ok)[0][example])
            n_states = len(example)
            with_entry = ok & (w > 0)
            entry = none.copy()
            _, first, entry[with_entry] = np.unique(state[with_entry] << np.int64(32) | w[with_entry], return_index=True, return_inverse=True)
            first = np.nonzero(with_entry)[0][first]
            if shared and not d:
                total, words, counts, sums = shared
                seen = counts[np.searchsorted(words, w[first])]
                kept = seen >= LEAST
                self.sums.append(tuple(np.array([x]) for x in (total, *sums)))
            else:
                count = np.bincount(state[ok & train], minlength=n_states)
                seen = np.bincount(entry[with_entry & train], minlength=len(first))
                kept = seen >= LEAST
                # an entry's count below the suffix: the word's own count at the root
                below = (c[first] if above_entry is None else above_seen[above_entry[first]]) if len(first) else np.zeros(0)
                s = state[first][kept]
                gain = np.bincount(s, seen[kept] * np.log(seen[kept] / below[kept]), n_states)
                self.sums.append((count, np.bincount(s, seen[kept], n_states).astype(np.int64), np.bincount(s, minlength=n_states), gain))
            for x, y in ((self.state, state), (self.entry, entry), (self.seen, seen), (self.kept, kept)):
                x.append(y)
            above_state, above_seen, above_entry = state, seen, entry

    def gains(self, n: int, v: int) -> np.ndarray:
        """log10 P(word | longest state) - log10 P(word | root) of each position."""
        root = (self.c + 0.5) / (n + 0.5 * (v + 1))
        p = root.copy()
        above = None
        for state, entry, seen, kept, (count, kept_sum, entries, gain) in zip(self.state, self.entry, self.seen, self.kept, self.sums, strict=True):
            if not len(count):
                break
            below = np.full(len(count), self.n_train) if above is None else above[0][above[1]]
            ratio = np.maximum(count, 1) / np.maximum(below, 1)
            retained = (count >= LEAST) & (gain - kept_sum * np.log(ratio) >= DIVERGENCE)
            rest = (count - kept_sum + DISCOUNT * entries) / np.maximum(count, 1)
            share = np.zeros(len(p))
            (have,) = np.nonzero(entry >= 0)
            e = entry[have]
            share[have] = np.where(kept[e], seen[e] - DISCOUNT, 0.0) / np.maximum(count[state[have]], 1)
            (on,) = np.nonzero(state >= 0)
            on = on[retained[state[on]]]
            p[on] = share[on] + rest[state[on]] * p[on]
            above = self._above(count, len(above[2]) if above else 0, state)
        return np.log10(p) - np.log10(root)

    def _above(self, count: np.ndarray, d: int, state: np.ndarray) -> tuple:
        """For the next depth: counts here, and where each longer context's suffix is among them."""
        at = self.example[d + 1] if d + 1 < len(self.example) else np.zeros(0, np.int64)
        return count, state[at], range(d + 1)


def _columns(table: pa.Table, unpack=_unpacked) -> tuple[np.ndarray, np.ndarray]:
    """The columns of all blocks of a task, and the bundle of each position."""
    sizes = table.column("n").to_numpy()
    blocks = [unpack(x.as_py(), int(k)) for x, k in zip(table.column("data"), sizes, strict=True)]
    return np.concatenate(blocks, axis=1), np.repeat(table.column("bundle").to_numpy(), sizes)


def _split_entries(key, table, hot):
    """The next words of a split branch with their training counts, in slices that the branch's splits share."""
    part = key[0].as_py()
    w1 = (-1 - part) >> 20
    (w, times, c), _ = _columns(table)
    words, first, place = np.unique(w, return_index=True, return_inverse=True)
    counts = np.bincount(place, times, len(words)).astype(np.int64)
    slices = hot[w1][0]
    at = (_spread(words) % np.uint64(slices)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(slices + 1))
    columns = words[order], counts[order], c[first][order]
    data = [_packed(*(x[a:b] for x in columns)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.table({"slice": pa.array([w1 << 20 | k for k in range(slices)], pa.int64()), "part": pa.array([part] * slices, pa.int64()), "n": pa.array(np.diff(cuts)), "data": pa.array(data, pa.binary())})


def _shared_entries(key, table):
    """A slice's counts over all splits, for each split; and the slice's sums over kept entries."""
    sizes = table.column("n").to_numpy()
    words, counts, c = np.concatenate([_unpacked(x.as_py(), int(k), 3) for x, k in zip(table.column("data"), sizes, strict=True)], axis=1)
    found, first, place = np.unique(words, return_index=True, return_inverse=True)
    total = np.bincount(place, counts, len(found)).astype(np.int64)
    kept = (total >= LEAST) & (found > 0)
    gain = float((total[kept] * np.log(total[kept] / c[first][kept])).sum())
    ends, rows = np.cumsum(sizes), len(sizes)
    data = [_packed(words[e - k : e], total[place[e - k : e]]) for e, k in zip(ends, sizes, strict=True)]
    sums = {"kept": pa.array([int(total[kept].sum())] * rows, pa.int64()), "entries": pa.array([int(kept.sum())] * rows, pa.int64()), "gain": pa.array([gain] * rows, pa.float64())}
    return pa.table({"part": table.column("part"), "n": table.column("n"), "data": pa.array(data, pa.binary()), **sums})


def _branch_scores(key, table: pa.Table, shared: pa.Table, n: int, v: int, depth: int, hot: dict) -> pa.Table:
    """Per bundle, the sums of gains of its texts over this task's positions."""
    bundles, docs, gains = [], [], []
    if table.num_rows:
        columns, bundle = _columns(table, _opened_positions)
        entries = None
        if shared.num_rows:
            words, counts = np.concatenate([_unpacked(x.as_py(), k.as_py(), 2) for x, k in zip(shared.column("data"), shared.column("n"), strict=True)], axis=1).astype(np.int64)
            order = np.argsort(words)
            # every slice of the branch sent its sums to every split
            sums = [shared.column(x).to_numpy().sum() for x in ("kept", "entries", "gain")]
            entries = hot[int(columns[0, 0])][1], words[order], counts[order], sums
        branch = Branch(columns, n, depth, entries)
        order = np.lexsort((columns[5], bundle))
        name = np.stack([bundle[order], columns[5][order].astype(np.int64) >> 1])
        cuts = np.concatenate([[0], np.nonzero(np.any(name[:, 1:] != name[:, :-1], axis=0))[0] + 1])
        sums, name = np.add.reduceat(branch.gains(n, v)[order], cuts), name[:, cuts]
        edges = np.concatenate([[0], np.nonzero(np.diff(name[0]))[0] + 1, [name.shape[1]]])
        for a, b in zip(edges, edges[1:], strict=False):
            bundles.append(int(name[0, a]))
            docs.append(_packed(name[1, a:b]))
            gains.append(sums[a:b].tobytes())
    del table
    release()
    return pa.table({"bundle": pa.array(bundles, pa.int64()), "texts": pa.array(docs, pa.binary()), "gains": pa.array(gains, pa.binary())})


def _joined(key, base: pa.Table, gains: pa.Table) -> pa.Table:
    """A row for each text of a bundle, with the gains of all branches added to its base score."""
    row = {n: base.column(n).combine_chunks()[0] for n in base.column_names}
    start = np.array(row["base"].values.to_numpy(zero_copy_only=False), np.float64)
    score = start.copy()
    for texts, values in zip(gains.column("texts"), gains.column("gains"), strict=True):
        g = np.frombuffer(values.as_py(), np.float64)
        score[_unpacked(texts.as_py(), len(g))[0]] += g
    return pa.table({"doc_id": row["docs"].values, "n_tokens": row["n_tokens"].values, "n_known": row["known"].values, "base_score": pa.array(start), "score": pa.array(score)})


def score(docs: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, part_windows: int = PART_WINDOWS, waves: int = WAVES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every row, learning from those that ``may_learn`` lets through."""
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(may_learn, F.lit(False)).alias("learn"), F.col(text).cast("binary").alias("text"))
    schema = "bundle long, docs array<long>, learn array<boolean>, sizes array<int>, words array<long>, counts array<long>, data binary"
    bundles = materialize(slim.mapInArrow(Lean(_bundles), schema), "bundles")
    total = bundles.agg(F.sum(F.size("words"))).first()[0] or 0
    slices = max(1, math.ceil(total / SLICE_WORDS))
    cut_words = bundles.select("bundle", "words", "counts").mapInArrow(Lean(_slices, slices=slices), "slice long, bundle long, size long, words binary, counts binary")
    numbered = cut_words.groupBy("slice").applyInArrow(partial(_number, slices=slices, limit=part_windows), "slice long, bundle long, size long, data binary, n long, v long, hot array<long>, times array<long>")
    numbered = materialize(numbered, "numbers")
    n, v = (int(x or 0) for x in numbered.filter("bundle = -1").agg(F.sum("n"), F.sum("v")).first())
    # at most as many words as there are positions over what a task should hold
    hot = {r["w"]: (math.ceil(r["c"] / part_windows) + 1, r["c"]) for r in numbered.select(F.inline(F.arrays_zip(F.col("hot").alias("w"), F.col("times").alias("c")))).collect()}
    schema = "bundle long, docs array<long>, learn array<boolean>, sizes array<int>, data binary"
    texts = bundles.select("bundle", "docs", "learn", "sizes", "data").groupBy("bundle")
    back = numbered.filter("bundle >= 0").select(F.col("bundle").alias("n_bundle"), "slice", "size", "data").groupBy("n_bundle")
    known = materialize(texts.cogroup(back).applyInArrow(_with_numbers, f"{schema}, known binary, n_known long"), "numbered")
    discard(bundles, numbered)
    positions = known.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    parts = max(1, math.ceil(positions / part_windows))
    base = known.mapInArrow(Lean(_base, n=n, v=v), "bundle long, docs array<long>, n_tokens array<long>, known array<long>, base array<double>")
    block = "part long, bundle long, n long, data binary"
    entries = "part long, n long, data binary"
    found = None
    for wave in range(waves):
        cut = partial(Lean, _windows, parts=parts, hot=hot, depth=depth, wave=wave, waves=waves)
        shared = spark.createDataFrame([], f"{entries}, kept long, entries long, gain double")
        if hot:
            split = known.mapInArrow(cut(pairs=True), block).groupBy("part").applyInArrow(partial(_split_entries, hot=hot), f"slice long, {entries}")
            shared = split.groupBy("slice").applyInArrow(_shared_entries, f"{entries}, kept long, entries long, gain double")
        windows = known.mapInArrow(cut(pairs=False), block) if n else spark.createDataFrame([], block)
        sums = windows.groupBy("part").cogroup(shared.withColumnRenamed("part", "s_part").groupBy("s_part"))
        sums = sums.applyInArrow(partial(_branch_scores, n=n, v=v, depth=depth, hot=hot), "bundle long, texts binary, gains binary")
        if wave < waves - 1:
            sums = materialize(sums, "sums")
            drop_shuffles(spark)
        found = sums if found is None else found.unionAll(sums)
    found = found.withColumnRenamed("bundle", "g_bundle")
    rows = base.groupBy("bundle").cogroup(found.groupBy("g_bundle")).applyInArrow(_joined, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return rows.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
