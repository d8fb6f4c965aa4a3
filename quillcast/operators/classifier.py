"""Paragraph classifier: character n-gram TF-IDF of the paragraph and its context, flags, logistic regression.

n-grams are counted as numbers, a row's counts are kept in a few bytes each, and L-BFGS in the driver sums loss and gradient over them. Morphology is an interface; the tagger that ships is a rough suffix rule for Russian and is labelled approximate.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quillcast.operators.paragraphs import context_text, neighbour_flags
from quillcast.operators.sampling import overlap

# Verbs of speech with a manner, nouns of sound, and prepositions that open a manner phrase.
MANNER_VERBS = (
    "шептать", "прошептать", "зашептать", "крикнуть", "кричать", "закричать", "выкрикнуть", "заорать", "орать", "гаркнуть", "рявкнуть",
    "пробормотать", "забормотать", "бормотать", "простонать", "стонать", "взвыть", "выть", "взвизгнуть", "визжать", "прохрипеть", "хрипеть",
    "процедить", "пролепетать", "лепетать", "выдохнуть", "всхлипнуть", "всхлипывать", "промычать", "мычать", "буркнуть", "прорычать", "рычать",
    "провизжать", "пропищать", "пищать", "проворчать", "воскликнуть", "завопить", "прошипеть", "шепнуть", "вскричать", "пропеть", "выдавить",
    "отрезать", "фыркнуть", "хмыкнуть", "пробасить", "просипеть", "скомандовать", "напеть", "прокричать", "взреветь",
)
SOUND_NOUNS = ("голос", "тон", "шёпот", "крик", "хрип", "интонация", "дрожь")
MANNER_PREPOSITIONS = ("с", "со", "без")
# Fixed value: what counts as a spoken span.
SPEECH_SPAN = re.compile(r'«[^»]+»|"[^"\n]{2,}"|(?:^|\n)\s*[—–-]\s+[^—–\n]*')


#: A paragraph's flags and its neighbours'.
FLAGS = ("v1", "v2", "prev_v1", "prev_v2", "next_v1", "next_v2")


class Tagger(Protocol):
    """(part of speech, lemma, cases) of a word."""

    def __call__(self, word: str) -> tuple[str, str, frozenset[str]]: ...


def suffix_tagger(word: str) -> tuple[str, str, frozenset[str]]:
    """Approximate: the lexicons by stem, adverbs in -о, gerunds in -я/-в, instrumental endings."""
    w = word.lower()
    for v in MANNER_VERBS:
        if len(w) > 3 and w[: max(4, len(v) - 3)] == v[: max(4, len(v) - 3)]:
            return "VERB", v, frozenset()
    for n in SOUND_NOUNS:
        if w[: len(n) - 1] == n[:-1] or w == n:
            return "NOUN", n, frozenset({"ablt"} if w.endswith(("ом", "ой", "ью")) else ())
    if w.endswith(("ом", "ью", "ами", "ями")) and len(w) > 4:
        return "NOUN", w, frozenset({"ablt"})
    if w.endswith("о") and len(w) > 4:
        return "ADVB", w, frozenset()
    if w.endswith(("ив", "ав", "вшись", "ая", "уя", "яя")) and len(w) > 4:
        return "GRND", w, frozenset()
    return ("ADJF" if w.endswith(("ый", "ий", "ое", "ые")) else "NOUN"), w, frozenset()


def manner_flags(text: str, tagger: Tagger = suffix_tagger) -> tuple[bool, bool]:
    """(narrow, extended): does the text look like a description of a manner of speech?"""
    words = [(w.lower(), *tagger(w)) for w in re.findall("[а-яёА-ЯЁ]+", text or "")]
    narrow = any(pos in ("ADVB", "GRND") or (pos == "VERB" and lemma in MANNER_VERBS) or (pos == "NOUN" and lemma in SOUND_NOUNS) for _, pos, lemma, _ in words)
    phrase = any(w in MANNER_PREPOSITIONS and nxt[1] in ("NOUN", "ADJF") for (w, *_), nxt in zip(words, words[1:], strict=False))
    return narrow, narrow or phrase or any(pos == "NOUN" and "ablt" in case for _, pos, _, case in words)


def tag_window(text: str, k: int | None) -> str:
    """What follows each spoken span for ``k`` characters, up to the next span; the whole text without spans or k."""
    spans = list(SPEECH_SPAN.finditer(text)) if k is not None else []
    if not spans:
        return text
    starts = [s.start() for s in spans[1:]] + [len(text)]
    return " ".join(text[s.end() : min(s.end() + k, nxt)] for s, nxt in zip(spans, starts, strict=True))


def with_flags(df: DataFrame, text: str, tagger: Tagger = suffix_tagger, window: int | None = None) -> DataFrame:
    """Add v1 and v2 (0.0 or 1.0), by Arrow batches."""

    def run(batches):
        for pdf in batches:
            both = [manner_flags(tag_window(t or "", window), tagger) for t in pdf[text]]
            yield pdf.assign(v1=[float(a) for a, _ in both], v2=[float(b) for _, b in both])

    return df.mapInPandas(run, ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", v1 double, v2 double")


def pos_filter(df: DataFrame, text: str, tagger: Tagger = suffix_tagger, extended: bool = True, window: int | None = None) -> DataFrame:
    """Rows whose text looks like a description of a manner of speech by its parts of speech alone."""

    def run(batches):
        for pdf in batches:
            yield pdf[[manner_flags(tag_window(t or "", window), tagger)[extended] for t in pdf[text]]]

    return df.mapInPandas(run, df.schema)


def with_neighbours(df: DataFrame, book: str, index: str, text: str = "text", tagger: Tagger = suffix_tagger) -> DataFrame:
    """Add ``context`` (the paragraphs before and after) and the six ``FLAGS``: a paragraph's own and its neighbours', 0 at a book's ends."""
    return neighbour_flags(with_flags(context_text(df, book, index, text), text, tagger), book, index, ["v1", "v2"])


#: Runs of anything but Unicode white space.
WORD = re.compile("[^\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
#: Terms that a task counts before it sends them on, and counts in a block of rows. No result depends on them.
HELD_TERMS, BLOCK = 500_000, 1_000_000
#: n-grams are numbers of up to five digits, none of them 0, so that lengths differ too; BASE ** 5 < 2 ** 63. Digits are given to letters as they come, the last one to letters without.
SIZES, BASE = (3, 4, 5), 6200


def padded(text: str | None) -> str:
    """The lower-case words between single spaces."""
    return f" {' '.join(WORD.findall((text or '').lower()))} "


def char_ngrams(text: str | None) -> Counter[str]:
    """Character n-grams inside words padded by a space on both sides."""
    return Counter(f" {w} "[i : i + n] for w in padded(text).split(" ") if w for n in SIZES for i in range(len(w) + 3 - n))


class Letters:
    """Digits of letters: of given ones, or of all as they come."""

    def __init__(self, given: list[str] | None = None):
        self.digits, self.points, self.grows = np.zeros(0x110000, np.int64), [0], given is None
        self.add(np.array([ord(c) for c in given or []], np.int64))

    def add(self, points: np.ndarray) -> bool:
        """Is there a digit for each of these code points?"""
        new = np.unique(points[self.digits[points] == 0])
        if len(new) + len(self.points) > BASE - 1:
            return False
        self.digits[new] = np.arange(len(self.points), len(self.points) + len(new))
        self.points += new.tolist()
        return True

    def count(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """``char_ngrams`` as (numbers in order, counts); None if there are more letters than digits."""
        points = np.frombuffer(padded(text).encode("utf-32-le"), np.uint32)
        if len(points) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.grows and not self.add(points):
            return None
        c, spaces = self.digits[points], np.flatnonzero(points == 32)
        if not self.grows:
            c[c == 0] = BASE - 1
        room = np.repeat(spaces[1:], np.diff(spaces)) - np.arange(len(points) - 1)  # up to the space that ends the word
        number, found = c[:-1] * BASE + c[1:], []
        for n in SIZES:
            number = number[:-1] * BASE + c[n - 1 :]
            found.append(number[room[: len(number)] >= n - 1])
        found = np.sort(np.concatenate(found))
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        return found[first], np.diff(first, append=len(found))

    def numbers(self, terms: list[str]) -> np.ndarray:
        out = np.zeros(len(terms), np.int64)
        for n in range(SIZES[-1]):
            out = np.array([self.digits[ord(t[n])] + x * BASE if n < len(t) else x for t, x in zip(terms, out, strict=True)], np.int64)
        return out

    def terms(self, numbers: np.ndarray) -> list[str]:
        """Of numbers in order."""
        points, out = np.array(self.points, np.uint32), []
        for n in SIZES:
            own = numbers[(numbers >= BASE ** (n - 1)) & (numbers < BASE**n)] if n < SIZES[-1] else numbers[numbers >= BASE ** (n - 1)]
            if len(own):
                digits = np.stack([own // BASE**i % BASE for i in reversed(range(n))], axis=1)
                out += np.ascontiguousarray(points[digits]).view(f"<U{n}").ravel().tolist()
        return out


class Vocabulary:
    """Looks up a text's n-grams: (ids of those that are terms, counts). Short texts are kept."""

    def __init__(self, terms: list[str]):
        letters = sorted(set("".join(terms)))
        self.size, self.kept, self.ids = len(terms), {}, None
        if len(letters) < BASE - 1:
            self.letters = Letters(letters)
            numbers = self.letters.numbers(terms)
            self.order = np.argsort(numbers)
            self.sorted = numbers[self.order]
        else:
            self.ids = {t: i for i, t in enumerate(terms)}

    def look_up(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if not self.size:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.ids is not None:
            found = [(i, n) for g, n in char_ngrams(text).items() if (i := self.ids.get(g)) is not None]
            return np.array([i for i, _ in found], np.int64), np.array([n for _, n in found], np.int64)
        numbers, counts = self.letters.count(text)
        at = np.minimum(np.searchsorted(self.sorted, numbers), self.size - 1)
        known = self.sorted[at] == numbers
        return self.order[at[known]], counts[known]

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if text is not None and len(text) > 200:
            return self.look_up(text)
        if text not in self.kept:
            if len(self.kept) > 5000:
                self.kept.clear()
            self.kept[text] = self.look_up(text)
        return self.kept[text]


def summed(counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers in order, sums, sums) of such triples together."""
    numbers, tf, df = (np.concatenate(x) for x in zip(*counts, strict=True))
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    first = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]])) if len(numbers) else np.zeros(0, np.int64)
    return numbers[first], *((np.add.reduceat(x[order], first) if len(first) else x) for x in (tf, df))


class Counts:
    """Sums (term, tf, df) over texts."""

    def __init__(self):
        self.letters, self.parts, self.held, self.least = Letters(), [], 0, 2 * HELD_TERMS

    def taken(self) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
        """What has been counted, to begin anew."""
        numbers, tf, df = summed(self.parts) if self.parts else (np.zeros(0, np.int64),) * 3
        out = [(self.letters.terms(numbers), tf, df)]
        self.__init__()
        return out

    def add(self, text: str | None) -> list[tuple[list[str], np.ndarray, np.ndarray]]:
        """Count a text; gives what is to be sent on."""
        out, got = [], self.letters.count(text)
        if got is None:
            out, got = self.taken(), self.letters.count(text)
        if got is None:  # one text with more letters than digits
            grams = char_ngrams(text)
            return [*out, (list(grams), np.array(list(grams.values())), np.ones(len(grams), np.int64))]
        self.parts.append((*got, np.ones(len(got[0]), np.int64)))
        self.held += len(got[0])
        if self.held > self.least:
            self.parts = [summed(self.parts)]
            self.held = len(self.parts[0][0])
            self.least = self.held + 2 * HELD_TERMS
            if self.held > HELD_TERMS:
                out += self.taken()
        return out


def term_counts(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """(column, term, tf, df): occurrences of a column's n-grams and its rows that have them, over labelled rows; in column -1 the rows of each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(column, terms, tf, df):
            return pa.RecordBatch.from_arrays([pa.array([column] * len(terms), pa.int32()), pa.array(terms, pa.string()), pa.array(tf, pa.int64()), pa.array(df, pa.int64())], ["column", "term", "tf", "df"])

        counts, labels = [Counts() for _ in columns], Counter()
        for batch in batches:
            known = batch.column(0).to_pylist()
            labels.update(known)
            for k, c in enumerate(counts):
                for y, text in zip(known, batch.column(1 + k), strict=True):
                    if y is not None:
                        yield from (sent(k, *x) for x in c.add(text.as_py()))
        for k, c in enumerate(counts):
            yield from (sent(k, *x) for x in c.taken())
        yield sent(-1, [None if y is None else repr(y) for y in labels], list(labels.values()), [0] * len(labels))

    parts = df.select(F.col(label).cast("double"), *columns).mapInArrow(run, "column int, term string, tf bigint, df bigint")
    return parts.groupBy("column", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _small(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


@dataclass
class Part:
    """Rows' counts of one column: tf of ``ids``, ``lengths`` of them a row, and 1 / the row's length as a vector of tf * idf."""

    ids: np.ndarray
    tf: np.ndarray
    lengths: np.ndarray
    scale: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> Part:
        norms = [math.sqrt(np.square(n * idf[ids]).sum()) for ids, n in rows]
        return cls(_small(np.concatenate([r[0] for r in rows])), _small(np.concatenate([r[1] for r in rows])), np.array([len(r[0]) for r in rows]), np.array([1 / x if x else 0.0 for x in norms]))

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Products of the rows' unit vectors with idf * coefficients."""
        at = np.repeat(np.arange(len(self.lengths)), self.lengths)
        return np.bincount(at, weights[self.ids] * self.tf, len(self.lengths)) * self.scale

    def back(self, residuals: np.ndarray, n_terms: int) -> np.ndarray:
        """The rows' unit vectors before idf, times residuals, summed by term."""
        return np.bincount(self.ids, np.repeat(residuals * self.scale, self.lengths) * self.tf, n_terms)


@dataclass
class HybridModel:
    """Columns with their terms (most frequent first) and idf, flag columns, coefficients (terms of the columns in turn, then flags)."""

    columns: list[str]
    terms: list[list[str]]
    idf: list[np.ndarray]
    flags: list[str]
    coefficients: np.ndarray
    intercept: float = 0.0

    def blocks(self, batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[list[Part], np.ndarray, pa.RecordBatch]]:
        """(parts, flags, rows): whole batches or slices of them, cut where they hold ``least`` counts."""
        grams = [Vocabulary(t) for t in self.terms]
        for batch in batches:
            texts = [batch.column(batch.schema.get_field_index(c)) for c in self.columns]
            flags = np.array([batch.column(batch.schema.get_field_index(f)).to_numpy(zero_copy_only=False) for f in self.flags], float).reshape(len(self.flags), -1)
            if np.isnan(flags).any():
                raise ValueError(f"null or NaN among the flags {', '.join(self.flags)}")
            rows, since, held = [[] for _ in texts], 0, 0
            for k in range(batch.num_rows):
                for column, g, t in zip(rows, grams, texts, strict=True):
                    column.append(g(t[k].as_py()))
                    held += len(column[-1][0]) + 1
                if held >= least or k == batch.num_rows - 1:
                    yield [Part.of(c, i) for c, i in zip(rows, self.idf, strict=True)], flags[:, since : k + 1], batch.slice(since, k + 1 - since)
                    rows, since, held = [[] for _ in texts], k + 1, 0

    def weights(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """idf * coefficients by column, and the flags' coefficients."""
        cuts = np.cumsum([len(t) for t in self.terms])
        *own, flags = np.split(x[: cuts[-1] + len(self.flags)], cuts)
        return [i * w for i, w in zip(self.idf, own, strict=True)], flags


def margins(parts: list[Part], flags: np.ndarray, weights: tuple[list[np.ndarray], np.ndarray], intercept: float) -> np.ndarray:
    return sum(p.times(w) for p, w in zip(parts, weights[0], strict=True)) + weights[1] @ flags + intercept


def minimize(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10) -> np.ndarray:
    """L-BFGS for a smooth convex function, until the gradient is shorter than ``tol`` of the value."""
    value, grad = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iter):
        if not np.isfinite(value):
            raise ValueError("the loss is not finite")
        if np.linalg.norm(grad) <= max(tol * abs(value), 1e-8):
            break
        q, used = grad.copy(), []
        for s, y in reversed(pairs):
            used.append((s @ q) / (s @ y))
            q -= used[-1] * y
        q *= (pairs[-1][0] @ pairs[-1][1]) / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / np.linalg.norm(grad)
        for (s, y), a in zip(pairs, reversed(used), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        slope, low, high, step = -(grad @ q), 0.0, math.inf, 1.0
        for _ in range(40):  # weak Wolfe conditions: halve between the bounds, or double
            then, new = f(x - step * q)
            if not then <= value + 1e-4 * step * slope:
                high = step
            elif -(new @ q) < 0.9 * slope:
                low = step
            else:
                break
            step = (low + high) / 2 if high < math.inf else 2 * step
        if not then < value:  # as low as double precision tells
            break
        pairs = [*pairs, (-step * q, new - grad)][-memory:]
        x, value, grad = x - step * q, then, new
    return x


def fit(df: DataFrame, label: str = "label", text: str = "text", context: str = "context", flags: tuple[str, ...] = ("v1", "v2"), vocabulary: int = 50_000, max_iter: int = 1000) -> HybridModel:
    """Both texts' grams and the flags, then logistic regression with balanced classes and a penalty of 1 / rows.

    A column's terms are the ``vocabulary`` most frequent of those in two rows or more (ties: the first in order), as unit vectors of
    tf * (ln((1 + n) / (1 + df)) + 1).
    """
    columns = [text, context]
    counts = term_counts(df, label, columns).persist(StorageLevel.MEMORY_AND_DISK)
    rows = {None if t is None else float(t): n for t, n in counts.filter("column = -1").select("term", "tf").collect()}
    top = [counts.filter(f"column = {k} AND df >= 2").orderBy(F.desc("tf"), "term").limit(vocabulary).select("term", "df").collect() for k in range(len(columns))]
    counts.unpersist()
    sizes = {y: n for y, n in rows.items() if y is not None}
    total, penalty = sum(sizes.values()), 1.0 / max(sum(rows.values()), 1)
    if not sizes or not sizes.keys() <= {0.0, 1.0}:
        raise ValueError(f"labels must be 0 and 1, not {sorted(sizes)}")
    model = HybridModel(columns, [[r.term for r in t] for t in top], [np.log((total + 1) / (np.array([r.df for r in t], float) + 1)) + 1 for t in top], list(flags), np.zeros(sum(map(len, top)) + len(flags)))
    if len(sizes) == 1:
        model.intercept = math.inf if 1.0 in sizes else -math.inf
        return model
    class_weight = np.array([total / (2 * sizes[y]) for y in (0.0, 1.0)])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, own, batch in model.blocks(batches, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((parts, own, batch.column(0).to_numpy(zero_copy_only=False).astype(int)), protocol=5)], pa.binary())], ["block"])

    spark = df.sparkSession
    sc = spark.sparkContext
    labelled = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("_label"), *columns, *flags)
    blocks = labelled.mapInArrow(packed, "block binary").rdd.map(lambda r: bytes(r[0]))
    blocks = blocks.coalesce(min(blocks.getNumPartitions(), 4 * sc.defaultParallelism)).persist(StorageLevel.MEMORY_AND_DISK)

    n_weights = len(model.coefficients) + 1

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        sent = sc.broadcast((model.weights(x), x[-1]))

        def of_blocks(found: Iterator[bytes]) -> Iterator[tuple[float, np.ndarray]]:
            (weights, intercept), value, grad = sent.value, 0.0, np.zeros(n_weights)
            own_terms = [len(w) for w in weights[0]]
            for parts, own, y in map(pickle.loads, found):
                z = margins(parts, own, weights, intercept)
                w = class_weight[y]
                value += (w * (np.logaddexp(0, z) - y * z)).sum()
                r = w * (1 / (1 + np.exp(-np.clip(z, -700, 700))) - y)
                grad += np.concatenate([*[p.back(r, n) for p, n in zip(parts, own_terms, strict=True)], own @ r, [r.sum()]])
            yield value, grad

        got = blocks.mapPartitions(of_blocks).collect()
        sent.destroy()
        value, grad = sum(v for v, _ in got) / total, sum(g for _, g in got) / total
        grad[:-1] *= np.concatenate([*model.idf, np.ones(len(flags))])
        grad[:-1] += penalty * x[:-1]
        return value + penalty * (x[:-1] @ x[:-1]) / 2, grad

    x = minimize(loss, np.zeros(n_weights), max_iter)
    blocks.unpersist()
    model.coefficients, model.intercept = x[:-1], float(x[-1])
    return model


def score(model: HybridModel, df: DataFrame) -> DataFrame:
    """Add ``prob``, the probability of label 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights(model.coefficients)
        for parts, flags, batch in model.blocks(batches, BLOCK):
            prob = 1 / (1 + np.exp(-np.clip(margins(parts, flags, weights, model.intercept), -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prob)], [*batch.schema.names, "prob"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("prob", DoubleType())]))


def passing(scored: DataFrame, threshold: float = 0.25) -> DataFrame:
    return scored.filter(F.col("prob") >= threshold)


def threshold_sweep(scored: DataFrame, thresholds: list[float], label: str = "label", prob: str = "prob", fold: str | None = None) -> DataFrame:
    """(threshold, kept, total, recall, economy): kept rows by threshold from one pass, summed over folds."""
    keys = [fold] if fold else []
    sums = [F.struct(F.lit(t).alias("threshold"), F.count_if(F.col(prob) >= t).alias("kept"), F.count_if((F.col(prob) >= t) & (F.col(label) == 1)).alias("hit")) for t in thresholds]
    row = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(label) == 1).alias("good"), F.array(*sums).alias("cells"))
    cells = row.select("total", "good", F.explode("cells").alias("c")).groupBy("c.threshold").agg(F.sum("total").alias("total"), F.sum("good").alias("good"), F.sum("c.kept").alias("kept"), F.sum("c.hit").alias("hit"))
    nz = lambda c: F.when(F.col(c) != 0, F.col(c))
    return cells.select("threshold", "kept", "total", (F.col("hit") / nz("good")).alias("recall"), (1 - F.col("kept") / nz("total")).alias("economy"))


def cross_validate(df: DataFrame, folds: DataFrame, key: str, thresholds: list[float], **options) -> DataFrame:
    """Out-of-fold threshold sweep; books of one fold never train the model that scores them."""
    both = df.join(F.broadcast(folds), key)  # a row a book
    scored = None
    for (f,) in folds.select("fold").distinct().orderBy("fold").collect():
        model = fit(both.filter(F.col("fold") != f).drop("fold"), **options)
        part = score(model, both.filter(F.col("fold") == f))
        scored = part if scored is None else scored.unionByName(part)
    return threshold_sweep(scored, thresholds, fold="fold")


def cross_validate_and_refit(df: DataFrame, folds: DataFrame, key: str, thresholds: list[float], **options) -> tuple[DataFrame, HybridModel]:
    """The pooled out-of-fold sweep, and the model of all books."""
    return cross_validate(df, folds, key, thresholds, **options), fit(df, **options)


def hold_out(train: DataFrame, test: DataFrame, key: str, thresholds: list[float], **options) -> tuple[DataFrame, HybridModel]:
    """The sweep over ``test`` by a model of ``train``, and the model; a book in both is a leak and an error."""
    both = [str(r[0]) for r in overlap(train, test, key).limit(5).collect()]
    if both:
        raise ValueError(f"in train and test: {', '.join(both)}")
    model = fit(train, **options)
    return threshold_sweep(score(model, test), thresholds), model


def save(model: HybridModel, path: str) -> None:
    fields = {k: [v.tolist() for v in x] if k == "idf" else x.tolist() if k == "coefficients" else x for k, x in asdict(model).items()}
    schema = "columns array<string>, terms array<array<string>>, idf array<array<double>>, flags array<string>, coefficients array<double>, intercept double"
    SparkSession.active().createDataFrame([tuple(fields.values())], schema).write.mode("overwrite").parquet(path)


def load(path: str) -> HybridModel:
    r = SparkSession.active().read.parquet(path).first()
    return HybridModel(r.columns, r.terms, [np.array(i) for i in r.idf], r.flags, np.array(r.coefficients), r.intercept)
