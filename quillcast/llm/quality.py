"""Quality rules whose thresholds adapt to each language and source (DataFrame expressions only).

``base_metrics`` measures whole texts. ``group_sketches`` summarises the measures in mergeable quantile sketches
(KLL) per (lang, source); those of a language and of the whole table are merged from them. ``adaptive_thresholds`` turns
quantiles into fences, and ``verdicts`` joins the fences back and judges each row.

No cutoff is fixed. A fence is q90 + SPREAD * (q90 - q50) of its group, drawn towards the language's and that towards the whole
table's by PRIOR_ROWS rows. A rate of x in n is only known between x / (n + DOUBT) and (x + DOUBT) / (n + DOUBT) (the imprecise Dirichlet
model): fences are drawn from the upper bounds, and a row goes only if its lower bound is beyond the fence. So a group in which nearly every rate is 0
still has a fence above 0, which depends on how long its texts are.

Defined results: a null or blank text has no words and fails the base rules; very long texts are measured whole; null lang or source form
groups of their own; repeated rows are judged alike, one verdict for each; where no row passes the base rules none is kept; an empty table gives an
empty result; further columns, whatever their names, pass through ``filter_documents`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import WORD_REGEX, discard, fresh, let, materialize

#: Rates and what they count: (part, whole). The mean length of words is a measure too, known exactly.
RATES = {"symbol_rate": ("n_symbols", "word_chars"), "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words")}
MEASURES = (*RATES, "mean_word_chars")
QUANTILES = (0.5, 0.9)
SPREAD, DOUBT, PRIOR_ROWS = 4.0, 4.0, 100.0
MIN_WORDS = 50
#: Sketches are exact up to about so many rows; beyond, ranks are off by some ten thousandths.
SKETCH_K = 16384
_POS_BITS = 24
_POS_MASK = (1 << _POS_BITS) - 1


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``words``, first occurrences included.

    Each window becomes one long: 40 bits of its hash above its position, so that one primitive sort puts
    equal windows side by side. Neighbours of equal hash are compared word by word. Texts of 2**24 words or
    more take (hash, position) structs instead.
    """

    def at(w: Column, p: Column) -> Column:
        return F.slice(w, p.cast("int") + 1, 3)

    def covered(positions: Column) -> Column:
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last"))

        def step(a: Column, p: Column) -> Column:
            return F.struct((a["n"] + F.least(F.lit(3).cast("long"), p - a["last"])).alias("n"), p.alias("last"))

        return F.aggregate(positions, zero, step)["n"]

    def packed(w: Column) -> Column:
        keys = F.transform(
            w,
            lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
            .bitwiseAND(F.lit(~_POS_MASK))
            .bitwiseOR(i.cast("long")),
        )
        ordered = F.sort_array(F.slice(keys, F.lit(1), F.size(w) - 2))

        def twin(s: Column, x: Column, j: Column) -> Column:
            y = F.get(s, j)
            same = F.shiftright(x, _POS_BITS) == F.shiftright(y, _POS_BITS)
            pos, other = x.bitwiseAND(F.lit(_POS_MASK)), y.bitwiseAND(F.lit(_POS_MASK))
            return F.coalesce(same & (at(w, pos) == at(w, other)), F.lit(False))

        hits = let(ordered, lambda s: F.filter(s, lambda x, j: twin(s, x, j - 1) | twin(s, x, j + 1)))
        return covered(F.sort_array(F.transform(hits, lambda x: x.bitwiseAND(F.lit(_POS_MASK)))))

    def wide(w: Column) -> Column:
        keys = F.transform(
            w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.cast("long").alias("p"))
        )
        ordered = F.sort_array(F.slice(keys, F.lit(1), F.size(w) - 2))

        def twin(s: Column, x: Column, j: Column) -> Column:
            y = F.get(s, j)
            return F.coalesce((x["h"] == y["h"]) & (at(w, x["p"]) == at(w, y["p"])), F.lit(False))

        hits = let(ordered, lambda s: F.filter(s, lambda x, j: twin(s, x, j - 1) | twin(s, x, j + 1)))
        return covered(F.sort_array(F.transform(hits, lambda x: x["p"])))

    none = F.lit(0).cast("long")
    return F.when(F.size(words) < 4, none).when(F.size(words) < (1 << _POS_BITS), packed(words)).otherwise(wide(words))


def measures(text: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the whole text."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD_REGEX), F.lit(0))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD_REGEX))

    def body(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            let(lines, lambda x: F.size(x)).cast("long").alias("n_lines"),
            _repeat_words(w).alias("n_repeat_words"),
        )

    return let(words, body)


def base_metrics(docs: DataFrame, into: str, text_col: str = "text") -> DataFrame:
    """Add the struct ``into`` of measures and the base verdict to every row; ``low_`` and ``high_`` bound each measure."""
    (m,) = fresh(docs, "m")
    out = docs.withColumn(m, measures(F.col(text_col)))
    c = F.col(m)
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    mean = F.coalesce(c["word_chars"] / F.nullif(c["n_words"], F.lit(0).cast("long")), F.lit(0.0))
    bounds = []
    for r, (part, whole) in RATES.items():
        bounds += [(c[part] / (c[whole] + DOUBT)).alias(f"low_{r}"), ((c[part] + DOUBT) / (c[whole] + DOUBT)).alias(f"high_{r}")]
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    struct = F.struct(*[c[x].alias(x) for x in counts], failed.alias("base_failed"), *bounds, mean.alias("low_mean_word_chars"), mean.alias("high_mean_word_chars"))
    return out.withColumn(into, struct).drop(m)


def group_sketches(rows: DataFrame, metrics: str = "q", lang: str = "lang", source: str = "source") -> DataFrame:
    """(g_lang, g_source, s_<measure>) over rows that pass the base rules; empty sketches where none of a group does.

    The sketches combine on the map side, so a source with a third of all rows costs its tasks no more than others.
    """
    q = F.col(metrics)
    value = lambda r: F.when(~q["base_failed"], q[f"high_{r}"])  # noqa: E731  (sketches skip nulls)
    made = [F.kll_sketch_agg_double(value(r), F.lit(SKETCH_K)).alias(f"s_{r}") for r in MEASURES]
    return rows.groupBy(F.col(lang).alias("g_lang"), F.col(source).alias("g_source")).agg(*made)


def _fences(sketches: list[str]) -> list[Column]:
    """The number of rows behind the sketches, and each measure's own fence (null from an empty sketch)."""
    n = F.kll_sketch_get_n_double(sketches[0])
    at = F.array(*[F.lit(x) for x in QUANTILES])

    def fence(s: str) -> Column:
        q = F.when(n > 0, F.kll_sketch_get_quantile_double(s, at))
        return F.get(q, F.lit(1)) + SPREAD * (F.get(q, F.lit(1)) - F.get(q, F.lit(0)))

    return [n.cast("double").alias("n"), *[fence(s).alias(r) for s, r in zip(sketches, MEASURES, strict=True)]]


def adaptive_thresholds(sketches: DataFrame) -> DataFrame:
    """(g_lang, g_source, fences): one row for each group seen. The sketches of wider levels are merged from the groups'."""
    names = [f"s_{r}" for r in MEASURES]
    merged = [F.kll_merge_agg_double(s, F.lit(SKETCH_K)).alias(s) for s in names]
    langs = sketches.groupBy("g_lang").agg(*merged)
    own = sketches.select("g_lang", "g_source", F.struct(*_fences(names)).alias("own"))
    by_lang = langs.select(F.col("g_lang").alias("l_lang"), F.struct(*_fences(names)).alias("by_lang"))
    whole = langs.agg(*merged).select(F.struct(*_fences(names)).alias("whole"))  # one row
    joined = own.join(by_lang, F.col("g_lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(whole), F.lit(True), "left")

    def drawn(level: str, r: str, wider: Column) -> Column:
        n = F.col(f"{level}.n")
        return (n * F.coalesce(F.col(f"{level}.{r}"), F.lit(0.0)) + PRIOR_ROWS * wider) / (n + PRIOR_ROWS)

    fences = [drawn("own", r, drawn("by_lang", r, F.col(f"whole.{r}"))).alias(r) for r in MEASURES]
    return joined.select("g_lang", "g_source", F.struct(*fences).alias("fences"))


def verdicts(rows: DataFrame, fences: DataFrame, into: str, metrics: str = "q", lang: str = "lang", source: str = "source") -> DataFrame:
    """Join the fences to the rows and add ``into``: does the row keep its place?"""
    g_lang, g_source, limits = fresh(rows, "g_lang", "g_source", "fences")
    named = fences.toDF(g_lang, g_source, limits)
    joined = rows.join(named, F.col(lang).eqNullSafe(F.col(g_lang)) & F.col(source).eqNullSafe(F.col(g_source)), "left")
    keep = ~F.col(metrics)["base_failed"]
    for r in MEASURES:
        keep = keep & F.coalesce(F.col(metrics)[f"low_{r}"] <= F.col(limits)[r], F.lit(False))
    return joined.withColumn(into, keep).drop(g_lang, g_source, limits)


def _judged(measured: DataFrame, into: str, metrics: str, lang: str, source: str) -> DataFrame:
    sketches = materialize(group_sketches(measured, metrics, lang, source), "sketches")
    fences = materialize(adaptive_thresholds(sketches), "fences")
    discard(sketches)
    return verdicts(measured, fences, into, metrics, lang, source)


def filter_documents(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``."""
    q, keep = fresh(docs, "q", "keep")
    measured = materialize(base_metrics(docs, q, text), "quality")
    return _judged(measured, keep, q, lang, source).filter(F.col(keep)).select(*docs.columns)


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, the base counts, base_failed, the bounds and kept for every row; the texts are read once."""
    slim = base_metrics(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source")), "q")
    measured = materialize(slim.drop("text"), "quality")
    low = [f"low_{r}" for r in MEASURES]
    return _judged(measured, "kept", "q", "lang", "source").select(
        "doc_id", *[F.col("q")[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *low)], "kept"
    )
