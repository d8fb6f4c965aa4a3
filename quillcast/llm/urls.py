"""URL filters: listed rules first, then gradient-boosted trees on lexical features (DataFrame expressions only).

Labels are a Column (1 block, 0 allow, null unknown); by default the rules give them. Besides the shape of the URL, features are
statistics of its suffix (the host's last two labels) and of its first path segment: the smoothed share of blocked ones and how many there are, counted over
all labelled rows. A training row's own fold is left out of its statistics, and each training row is seen twice,
once as if its suffix had never been labelled, so the trees also learn to judge suffixes they know nothing of.

The trees are fitted on a bounded sample of labelled URLs (``sample_rows``) by histograms of binned features, in the driver. They become
one arithmetic expression that Spark compiles, so scoring is a plain projection.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is judged by the model on the
features of its text (of the empty text when null); without both labels the model allows everything, or blocks everything where all labels say so; very
long URLs are read whole; repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import materialize

#: (verdict, host, path): a rule fits its host and all subdomains where the URL's path starts with the rule's.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
LEXICAL = ("length", "host_length", "depth", "digit_ratio", "entropy", "params", "labels", "hyphens")
GROUPS = ("suffix", "segment")
FEATURES = (*LEXICAL, *[f"{g}_{x}" for g in GROUPS for x in ("rate", "log_n")])
BINS, FOLDS, PRIOR_ROWS = 32, 5, 4.0


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict; null where none fits."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    text = verdict = None
    for kind, h, p in ordered:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, h + p) if text is None else text.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return text, verdict


def _entropy(s: Column) -> Column:
    n = F.length(s)

    def bits(c: Column) -> Column:
        p = (n - F.length(F.replace(s, c, F.lit("")))) / n
        return -p * F.log2(p)

    chars = F.array_distinct(F.split(s, ""))
    chars = F.filter(chars, lambda c: c != "")
    return F.when(n > 0, F.aggregate(chars, F.lit(0.0), lambda a, c: a + bits(c))).otherwise(F.lit(0.0))


def suffix(host: Column) -> Column:
    """The last two labels of a host (all of it, if it has fewer)."""
    return F.substring_index(host, ".", -2)


def segment(path: Column) -> Column:
    """The first segment of a path, without slashes."""
    return F.regexp_extract(path, r"^/*([^/]*)", 1)


def lexical(url: Column, host: Column, path: Column) -> list[Column]:
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(u), F.lit(1))
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    return [
        F.length(u).cast("double").alias("length"),
        F.length(host).cast("double").alias("host_length"),
        F.regexp_count(path, F.lit("/[^/]")).cast("double").alias("depth"),
        (F.regexp_count(u, F.lit("[0-9]")) / n).alias("digit_ratio"),
        _entropy(u).alias("entropy"),
        F.regexp_count(query, F.lit("[^&]+")).cast("double").alias("params"),
        F.regexp_count(host, F.lit(r"[^.]+")).cast("double").alias("labels"),
        F.regexp_count(host, F.lit("-")).cast("double").alias("hyphens"),
    ]


def group_statistics(labelled: DataFrame, group: str) -> DataFrame:
    """(key, n, bad, and both by fold) of each value of ``group``, from all labelled rows (columns y and fold)."""
    in_fold = [F.count_if(F.col("fold") == k) for k in range(FOLDS)]
    bad_in_fold = [F.count_if((F.col("fold") == k) & (F.col("y") == 1)) for k in range(FOLDS)]
    return labelled.groupBy(F.col(group).alias(f"k_{group}")).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("y").alias("bad"), F.array(*in_fold).alias("ns"), F.array(*bad_in_fold).alias("bads")).alias(f"s_{group}")
    )


def with_statistics(rows: DataFrame, tables: dict[str, DataFrame], prior: float, leave_out: bool) -> DataFrame:
    """Add each group's rate and log count; with ``leave_out`` without the rows of the own fold."""
    for g, table in tables.items():
        rows = rows.join(table, F.col(g) == F.col(f"k_{g}"), "left")
        s = F.col(f"s_{g}")
        n, bad = F.coalesce(s["n"], F.lit(0)), F.coalesce(s["bad"], F.lit(0))
        if leave_out:
            n, bad = n - F.coalesce(F.get(s["ns"], F.col("fold")), F.lit(0)), bad - F.coalesce(F.get(s["bads"], F.col("fold")), F.lit(0))
        rows = rows.withColumns({f"{g}_rate": (bad + PRIOR_ROWS * prior) / (n + PRIOR_ROWS), f"{g}_log_n": F.log1p(n.cast("double"))}).drop(f"k_{g}", f"s_{g}")
    return rows


class BoostedTrees:
    """Additive trees: (feature, threshold, low, high) or a leaf's value; ``margin`` is their sum as one column."""

    def __init__(self, base: float, features: tuple[str, ...] = FEATURES):
        self.base, self.features, self.trees = base, features, []

    def margin(self) -> Column:
        def node(t) -> Column:
            if not isinstance(t, tuple):
                return F.lit(float(t))
            f, cut, low, high = t
            return F.when(F.col(self.features[f]) <= cut, node(low)).otherwise(node(high))

        return reduce(lambda a, t: a + node(t), self.trees, F.lit(self.base))


def train(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, l2: float = 1.0, bins: int = BINS, features: tuple[str, ...] = FEATURES) -> BoostedTrees:
    """Logistic boosting of rows of weight ``w`` by second-order gains over histograms; ties go to the first feature and the lowest threshold."""
    n, bad = float(w.sum()), float((w * y).sum())
    if not 0 < bad < n:
        return BoostedTrees(10.0 if n and bad else -10.0, features)
    model = BoostedTrees(math.log(bad / (n - bad)), features)
    edges = [np.unique(np.quantile(c, [(i + 1) / bins for i in range(bins - 1)], method="inverted_cdf")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    score = np.full(len(y), model.base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int):
        gs, hs = g[rows].sum(), h[rows].sum()
        best, gain = None, 1e-6
        for f in range(len(edges)) if left else ():
            gl, hl = (np.cumsum(np.bincount(binned[f, rows], v[rows], len(edges[f]) + 1))[:-1] for v in (g, h))
            inner = np.bincount(binned[f, rows], minlength=len(edges[f]) + 1).cumsum()[:-1]
            now = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
            now = np.where((inner > 0) & (inner < len(rows)), now, -1.0)
            if len(now) and now.max() > gain + 1e-9:
                best, gain = (f, int(now.argmax())), now.max()
        if best is None:
            value = -gs / (hs + l2) * rate
            score[rows] += value
            return float(value)
        f, cut = best
        low = binned[f, rows] <= cut
        return f, float(edges[f][cut]), grow(rows[low], g, h, left - 1), grow(rows[~low], g, h, left - 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        model.trees.append(grow(np.arange(len(y)), w * (p - y), w * p * (1 - p), depth))
    return model


def training_set(sample: list, prior: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of the sampled rows, then of the same rows with an unknown suffix."""
    x = np.array([[r[f] for f in FEATURES] for r in sample], float).reshape(-1, len(FEATURES))
    unknown = x.copy()
    unknown[:, [FEATURES.index("suffix_rate"), FEATURES.index("suffix_log_n")]] = prior, 0.0
    y, w = (np.array([r[c] for r in sample], float) for c in ("y", "w"))
    return np.concatenate([x, unknown]), np.concatenate([y, y]), np.concatenate([w, w])


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES, label: Column | None = None, sample_rows: int = 20_000) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's block probability for every row.

    ``label`` is a Column over ``pages``; where it is left out, the rules' verdicts are the labels.
    """
    u = F.col(url)
    host, path = host_and_path(u)
    rule, fixed = apply_rules(F.col("host"), F.col("path"), rules)
    given = F.lit(None).cast("int") if label is None else label.cast("int")
    rows = (
        pages.select(F.col(page_id).alias("page_id"), u.alias("u"), host.alias("host"), path.alias("path"), given.alias("given"))
        .select("*", rule.alias("rule"), fixed.alias("fixed"), suffix(F.col("host")).alias("suffix"), segment(F.col("path")).alias("segment"))
        .withColumn("y", F.when(F.col("fixed").isNotNull(), (F.col("fixed") == "block").cast("int")) if label is None else F.col("given"))
        .withColumn("fold", F.pmod(F.xxhash64("u"), F.lit(FOLDS)).cast("int"))
    )
    labelled = rows.filter(F.col("y").isNotNull())
    tables = {g: materialize(group_statistics(labelled, g), f"url-{g}") for g in GROUPS}
    counted = tables["suffix"].agg(F.sum("s_suffix.n").alias("n"), F.sum("s_suffix.bad").alias("bad")).first()
    n, bad = counted["n"] or 0, counted["bad"] or 0
    prior = bad / n if n else 0.0
    some = F.pmod(F.xxhash64("page_id", "u", F.lit("sample")), F.lit(1_000_000)) < math.ceil(min(1.0, sample_rows / max(n, 1)) * 1_000_000)

    def featured(df: DataFrame, leave_out: bool) -> DataFrame:
        return with_statistics(df.select("*", *lexical(F.col("u"), F.col("host"), F.col("path"))), tables, prior, leave_out)

    # about sample_rows rows, whatever the table's size; repeated ones come as one with their number
    sample = featured(labelled.filter(some), True).groupBy("y", *FEATURES).agg(F.count(F.lit(1)).alias("w")).collect() if 0 < bad < n else []
    sample.sort()
    model = train(*training_set(sample, prior)) if sample else BoostedTrees(10.0 if n and bad == n else -10.0)
    scored = featured(rows, False).withColumn("p_block", 1 / (1 + F.exp(-model.margin())))
    verdict = F.coalesce("fixed", F.when(F.col("p_block") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
