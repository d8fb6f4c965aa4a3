"""Language identification of words in code-switched text by a linear-chain conditional random field.

Words are runs of letters. A word's emission scores come from hashed features: its affixes and inner n-grams (n-grams of
the word between boundary marks) and, for words that training saw often enough, the word itself (the lexicon). Learned
transitions join neighbouring words, and forward-backward gives each word's distribution over languages. A document's
distribution is the mean over its words.

Training learns every language that a label names, from a bounded sample (about ``SAMPLE_DOCS`` documents a language, ``CHUNKS`` word runs of each). Runs of
different languages are strung together, so that switches occur and transitions are learned, not set.

Forward-backward runs over windows of ``CORE`` words with ``EDGE`` words of context on both sides, all windows of many
documents at once; every word of a text is labelled. Only a text's first window begins with the learned start; the others begin evenly, in their context.

Defined results: null texts and texts without letters are ``und`` with score 0; without labelled rows everything is ``und``; very long texts are labelled whole; ties go to
the language that sorts first; repeated rows are labelled alike; empty tables give empty results; ``filter_documents`` keeps all columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import Lean, release

CORE, EDGE = 96, 16
DIMS = 1 << 16
SAMPLE_DOCS, CHUNKS, CHUNK_WORDS = 300, 8, 40
LEXICON_COUNT = 3
EPOCHS = 40
CACHE_WORDS = 200_000
#: Characters that are handled together before forward-backward runs.
CHARS_AT_ONCE = 1_000_000
MIN_SCORE = 0.35


def _pattern():
    import regex

    return regex.compile(r"\p{L}+").findall


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all words in one array, and where each word's begin."""
    joined = "".join(f"\x02{w}\x03" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # codes from here to the word's end
    owner = np.repeat(np.arange(len(words)), sizes)
    ids, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, 5):
        shifted = np.zeros_like(codes)
        shifted[: len(codes) - n + 1] = codes[n - 1 :]
        h = (h * np.uint64(0x9E3779B97F4A7C15) + shifted + np.uint64(n)) * np.uint64(0xBF58476D1CE4E5B9)
        fits = left >= n
        ids.append(((h >> np.uint64(40)) % np.uint64(DIMS))[fits].astype(np.int64))
        owners.append(owner[fits])
    whole = np.array([DIMS + zlib.crc32(w.encode("utf-8", "surrogatepass")) % DIMS for w in words], np.int64)
    ids.append(whole)
    owners.append(np.arange(len(words)))
    all_ids, all_owners = np.concatenate(ids), np.concatenate(owners)
    order = np.argsort(all_owners, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(all_owners, minlength=len(words)))[:-1]]) if len(words) else starts
    return all_ids[order], first


def emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    ids, first = features(words)
    return np.add.reduceat(weights[ids], first, axis=0) if len(words) else np.zeros((0, weights.shape[1]))


def forward_backward(e: np.ndarray, mask: np.ndarray, transitions: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Posteriors (windows, steps, languages) of emission scores ``e``; with ``pairs``, summed transition
    posteriors and the log likelihoods' normalisers as well. Masked steps leave the state as it is."""
    n, steps, k = e.shape
    top = e.max(axis=2, keepdims=True)
    p = np.exp(e - top)
    a = np.exp(transitions)
    alpha, scale = np.empty_like(p), np.ones((n, steps))
    now = np.exp(start) * p[:, 0]  # one start for all, or one a window
    for t in range(steps):
        if t:
            now = np.where(mask[:, t, None], (alpha[:, t - 1] @ a) * p[:, t], alpha[:, t - 1])
        scale[:, t] = now.sum(axis=1)
        alpha[:, t] = now / scale[:, t, None]
        now = alpha[:, t]
    beta = np.ones((n, k))
    post = np.empty_like(p)
    both = np.zeros((k, k))
    for t in range(steps - 1, -1, -1):
        post[:, t] = alpha[:, t] * beta
        if t:
            inner = p[:, t] * beta
            nxt = inner @ a.T
            if pairs:
                x = alpha[:, t - 1, :, None] * a[None] * inner[:, None, :]
                x /= x.sum(axis=(1, 2), keepdims=True)
                both += x[mask[:, t]].sum(axis=0)
            nxt /= nxt.sum(axis=1, keepdims=True)
            beta = np.where(mask[:, t, None], nxt, beta)
    post /= post.sum(axis=2, keepdims=True)
    return (post, both) if pairs else post


def train(chunks: list[tuple[str, str]], seed: int = 3, epochs: int = EPOCHS) -> dict | None:
    """The model (languages, weights, transitions, start) from (language, words joined by spaces) runs."""
    languages = sorted({c[0] for c in chunks})
    if not languages:
        return None
    k, rng = len(languages), np.random.default_rng(seed)
    code = {x: i for i, x in enumerate(languages)}
    runs = [(code[lang], words) for lang, text in sorted(chunks) if (words := text.split())]
    rng.shuffle(runs)
    vocabulary: dict[str, int] = {}
    counts: list[int] = []
    for _, words in runs:
        for w in words:
            i = vocabulary.setdefault(w, len(vocabulary))
            if i == len(counts):
                counts.append(0)
            counts[i] += 1
    ids, first = features(list(vocabulary))
    # the lexicon: only words seen often enough keep their own feature
    seen = np.repeat(np.array(counts), np.diff(np.append(first, len(ids))))
    known = (ids < DIMS) | (seen >= LEXICON_COUNT)
    owner = np.repeat(np.arange(len(counts)), np.diff(np.append(first, len(ids))))[known]
    ids = ids[known]
    # sequences of several runs, switching as they come
    steps, sequences, at = CORE + 2 * EDGE, [], 0
    while at < len(runs):
        words, labels = [], []
        while at < len(runs) and len(words) < steps:
            lang, run = runs[at]
            some = run[: int(rng.integers(3, CHUNK_WORDS + 1))]
            words += [vocabulary[w] for w in some]
            labels += [lang] * len(some)
            at += 1
        sequences.append((words[:steps], labels[:steps]))
    n = len(sequences)
    w_id, y, mask = np.zeros((n, steps), np.int64), np.zeros((n, steps), np.int64), np.zeros((n, steps), bool)
    for i, (words, labels) in enumerate(sequences):
        w_id[i, : len(words)], y[i, : len(words)], mask[i, : len(words)] = words, labels, True
    gold = np.eye(k)[y] * mask[:, :, None]
    gold_pairs = np.zeros((k, k))
    np.add.at(gold_pairs, (y[:, :-1][mask[:, 1:]], y[:, 1:][mask[:, 1:]]), 1)
    weights, transitions, start = np.zeros((2 * DIMS, k)), np.zeros((k, k)), np.zeros(k)
    sums = [np.full_like(x, 1e-6) for x in (weights, transitions, start)]
    total = mask.sum()
    used = np.unique(ids)
    for _ in range(epochs):
        by_word = np.stack([np.bincount(owner, weights[ids, j], len(counts)) for j in range(k)], axis=1)
        post, both = forward_backward(by_word[w_id], mask, transitions, start, pairs=True)
        rest = (gold - post * mask[:, :, None]).reshape(-1, k)
        word_grad = np.stack([np.bincount(w_id.ravel(), rest[:, j], len(counts)) for j in range(k)], axis=1)
        grad = np.stack([np.bincount(ids, word_grad[owner, j], 2 * DIMS) for j in range(k)], axis=1)
        grads = (grad / total - 1e-6 * weights, (gold_pairs - both) / total, (gold[:, 0] - post[:, 0]).sum(axis=0) / total)
        for x, g, s in zip((weights, transitions, start), grads, sums, strict=True):
            s *= 0.9
            s += 0.1 * g * g
            x += 0.1 * g / np.sqrt(s + 1e-12)
    kept = np.zeros_like(weights, dtype=np.float32)
    kept[used] = weights[used]
    return {"languages": languages, "weights": kept, "transitions": transitions, "start": start}


class Labeller:
    """Labels words of many texts at once; remembers the emissions of words it has seen."""

    def __init__(self, model: dict):
        self.model, self.find = model, _pattern()
        self.k = len(model["languages"])
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.zeros((1024, self.k), np.float32)

    def _ids(self, words: list[str]) -> list[int]:
        place = self.place
        return [place.setdefault(w, len(place)) for w in words]

    def label(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the (words, languages) array of posteriors."""
        if len(self.place) > CACHE_WORDS:
            self.clear()
        had = len(self.place)
        docs = [np.array(self._ids(self.find(t.lower())), np.int64) for t in texts]
        new = list(self.place)[had:]
        if new:
            while len(self.table) < len(self.place):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            for i in range(0, len(new), 20_000):
                part = new[i : i + 20_000]
                self.table[had + i : had + i + len(part)] = emissions(part, self.model["weights"])
        steps = CORE + 2 * EDGE
        spans = [(d, s) for d, ids in enumerate(docs) for s in range(0, len(ids), CORE)]
        out = [np.zeros((len(ids), self.k), np.float32) for ids in docs]
        for i in range(0, len(spans), 1024):
            part = spans[i : i + 1024]
            ids, mask = np.zeros((len(part), steps), np.int64), np.zeros((len(part), steps), bool)
            for j, (d, s) in enumerate(part):
                run = docs[d][max(0, s - EDGE) : s + CORE + EDGE]
                ids[j, : len(run)], mask[j, : len(run)] = run, True
            begins = np.array([s == 0 for _, s in part])[:, None]
            start = np.where(begins, self.model["start"].astype(np.float32), np.float32(0))
            post = forward_backward(self.table[ids], mask, self.model["transitions"].astype(np.float32), start)
            for j, (d, s) in enumerate(part):
                skip = s - max(0, s - EDGE)
                n = min(CORE, len(docs[d]) - s)
                out[d][s : s + n] = post[j, skip : skip + n]
        return out

    def documents(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text, a bounded number of characters at a time."""
        out: list[tuple[str, float]] = []
        some, chars = [], 0
        for t in [*texts, None]:
            some.append(t or "")
            chars += len(some[-1])
            if chars > CHARS_AT_ONCE:
                out += self._documents(some)
                some, chars = [], 0
        return (out + self._documents(some))[: len(texts)]

    def _documents(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for post in self.label(texts):
            if not len(post):
                out.append(("und", 0.0))
                continue
            mean = post.mean(axis=0, dtype=np.float64)
            best = int(mean.argmax())
            out.append((self.model["languages"][best], float(min(1.0, max(0.0, mean[best])))))
        return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    find = _pattern()
    for batch in batches:
        langs, texts = [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            lines = [find(x) for x in (text or "").lower().split("\n")]
            runs = [" ".join(x[i : i + CHUNK_WORDS]) for x in lines for i in range(0, len(x), CHUNK_WORDS)]
            some = sorted(runs, key=lambda r: zlib.crc32(r.encode("utf-8", "surrogatepass")))[:CHUNKS]
            langs += [lang] * len(some)
            texts += some
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(texts, pa.string())], ["lang", "text"])


def fit(docs: DataFrame, may_learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict | None:
    """Train on a bounded sample of the labelled rows that ``may_learn`` lets through."""
    rows = docs.filter(may_learn & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = rows.groupBy(F.col(lang).alias("lang")).count().collect()  # a row for each language to be learned
    if not counts:
        return None
    shares = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, sample_docs / r["count"]))])
    hit = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("sample")), F.lit(1_000_000)) < F.element_at(shares, F.col(lang)) * 1_000_000
    some = rows.filter(hit).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    # a run that copies repeat counts once, and one that stands under several languages tells nothing
    runs = some.mapInArrow(Lean(_chunks), "lang string, text string").groupBy("text").agg(F.min("lang").alias("lang"), F.max("lang").alias("other"))
    chunks = runs.filter("lang = other").collect()
    model = train([(r["lang"], r["text"]) for r in chunks])
    release()
    return model


def _predict(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    labeller = Labeller(model)
    for batch in batches:
        found = labeller.documents(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"]
        )


def _kept(batches: Iterator[pa.RecordBatch], model: dict, at: int, min_score: float) -> Iterator[pa.RecordBatch]:
    labeller = Labeller(model)
    for batch in batches:
        found = labeller.documents(batch.column(at).to_pylist())
        yield batch.filter(pa.array([f[0] != "und" and f[1] >= min_score for f in found], pa.bool_()))


def predict(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; reads the text only."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if model is None:
        return slim.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return slim.mapInArrow(Lean(_predict, model=model), "doc_id long, lang_pred string, score double")


def filter_documents(docs: DataFrame, model: dict | None, min_score: float = MIN_SCORE, text: str = "text") -> DataFrame:
    """The rows whose language is found with ``min_score`` at least, with all columns of ``docs``."""
    if model is None:
        return docs.limit(0)
    return docs.mapInArrow(Lean(_kept, model=model, at=docs.columns.index(text), min_score=min_score), docs.schema)
