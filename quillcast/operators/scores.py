"""Robust baselines, delivery scores and quality flags.

Baselines and medians are small per group; the fragment table is scanned once, joined to them and
projected. NaN is null, and flags are never null.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.functions.numeric import flag, missing, positive, round3, sign_of_level
from quillcast.functions.text import word_count

MAD_TO_SIGMA = 1.4826
#: Each described axis and the measured feature that should follow it.
AXIS_FEATURES = {"loudness": "egm_loudness", "pitch": "egm_f0_std", "tempo": "egm_voiced_rate", "tension": "egm_jitter"}
LEVELS = ("low", "neutral", "high")
HARD_FLAGS = ("junk_any_hard", "junk_badmatch", "junk_few_words", "junk_few_asr_words")


def median_mad(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """<f>_med and <f>_scale (median absolute deviation times 1.4826) by group.

    Two aggregations over one partitioning: the second reads each value with its group's median.
    """
    clean = df.select(*keys, *[missing(F.col(f)).alias(f) for f in features])
    med = clean.groupBy(*keys).agg(*[F.median(f).alias(f"{f}_med") for f in features])
    same = reduce(lambda a, b: a & b, [F.col(f"x.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys])
    both = clean.alias("x").join(med.alias("m"), same)
    away = both.select(*[F.col(f"x.{k}").alias(k) for k in keys], *[F.abs(F.col(f"x.{f}") - F.col(f"m.{f}_med")).alias(f) for f in features])
    mad = away.groupBy(*keys).agg(*[(F.median(f) * MAD_TO_SIGMA).alias(f"{f}_scale") for f in features])
    same = reduce(lambda a, b: a & b, [F.col(f"m.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    out = [F.col(f"{t}.{f}_{n}") for f in features for t, n in (("m", "med"), ("s", "scale"))]
    return med.alias("m").join(mad.alias("s"), same).select(*[F.col(f"m.{k}") for k in keys], *out)


def hierarchical_fallback(df: DataFrame, baseline: DataFrame, columns: Sequence[str], reader: str = "reader", book: str = "book_name") -> DataFrame:
    """Each of ``columns`` from (reader, book), else the reader's median, else the median over all, by column.

    Groups with null keys take no part, as in a pandas groupby.
    """
    exact = baseline.filter(F.col(reader).isNotNull() & F.col(book).isNotNull()).groupBy(reader, book).agg(*[F.median(missing(F.col(c))).alias(f"e_{c}") for c in columns])
    by_reader = baseline.filter(F.col(reader).isNotNull()).groupBy(reader).agg(*[F.median(missing(F.col(c))).alias(f"r_{c}") for c in columns])
    whole = baseline.agg(*[F.median(missing(F.col(c))).alias(f"g_{c}") for c in columns])  # one row
    joined = df.join(exact, [reader, book], "left").join(by_reader, reader, "left").join(F.broadcast(whole), F.lit(True), "left")
    extra = [F.coalesce(f"e_{c}", f"r_{c}", f"g_{c}").alias(c) for c in columns]
    return joined.select(*[F.col(c) for c in df.columns], *extra)


def deviation(x: Column, med: Column, scale: Column) -> Column:
    """Robust z; null where the scale is not positive."""
    return (missing(x) - med) / positive(scale)


def delivery(df: DataFrame, axes: dict[str, str] = AXIS_FEATURES, confirm: float = 0.5, under: float = 1.0) -> DataFrame:
    """<axis>_anom, <axis>_agree, alignment_score, anomaly_score, manner_bucket and underdelivery.

    Agreement takes the deviation before rounding; thresholds compare the rounded scores.
    """
    out = df
    for axis, feature in axes.items():
        z = deviation(F.col(feature), F.col(f"{feature}_med"), F.col(f"{feature}_scale"))
        out = out.withColumns({f"{axis}_anom": round3(z), f"{axis}_agree": round3(sign_of_level(F.col(axis)) * z)})
    first = next(iter(axes))
    described = flag(F.col(first).isin("high", "low"))
    return out.withColumns(
        {
            "alignment_score": F.col(f"{first}_agree"),
            "anomaly_score": F.col(f"{first}_anom"),
            "manner_bucket": F.when(~described, "neutral").when(F.col(f"{first}_agree") >= confirm, "confirmed").otherwise("unconfirmed"),
            "underdelivery": flag((F.col(first) == "high") & (F.col(f"{first}_anom") < -under)),
        }
    )


def junk_flags(df: DataFrame, max_duration: float = 60.0, max_distance: float = 0.4, speech: str = "speech") -> DataFrame:
    """The ten atomic flags and their summary, false where a measure (or its whole column) is missing."""
    have = set(df.columns)

    def v(c: str) -> Column:
        return missing(F.col(c).cast("double")) if c in have else F.lit(None).cast("double")

    atomic = {
        "junk_zerodur": v("duration_s") <= 0,
        "junk_toolong": v("duration_s") >= max_duration,
        "junk_nonspeech": v("voiced_ratio") < 0.30,
        "junk_silence": v("silence_ratio") > 0.55,
        "junk_tooshort": v("duration_s") < 0.40,
        "junk_few_words": word_count(F.col(speech) if speech in have else F.lit("")) <= 3,
        "junk_few_asr_words": v("n_words_matched") <= 3,
        "junk_truncation": F.coalesce(v("edge_start_ratio") > 3, F.lit(False)) | F.coalesce(v("edge_end_ratio") > 3, F.lit(False)),
        "junk_flatness_soft": v("spec_flatness_mean") > 0.15,
        "junk_badmatch": v("match_distance_norm") >= max_distance,
    }
    out = df.withColumns({k: flag(c) for k, c in atomic.items()})
    hard = ("junk_zerodur", "junk_toolong", "junk_tooshort")
    return out.withColumn("junk_any_hard", reduce(lambda a, b: a | b, [F.col(h) for h in hard]))


def hard_filter(df: DataFrame) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [~F.col(f) for f in HARD_FLAGS]))


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag, n, pct) from one pass."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("on")) for f in flags])).alias("x")
    return df.select(cells).groupBy("x.flag").agg(F.count_if("x.on").alias("n"), (F.avg(F.col("x.on").cast("int")) * 100).alias("pct"))


def with_axes(df: DataFrame, axes: DataFrame | None, key: str = "description", order: str | None = None) -> DataFrame:
    """Left join of axis labels, first row for each key; missing labels are neutral."""
    names = list(AXIS_FEATURES)
    if axes is None:
        return df.withColumns({a: F.lit("neutral") for a in names})
    from quillcast.operators.sampling import keep_first

    one = keep_first(axes, [key], [order] if order else names).select(key, *names)
    return df.join(one, key, "left").withColumns({a: F.coalesce(a, F.lit("neutral")) for a in names})


def words_per_second(words: Column, seconds: Column) -> Column:
    return words / F.when(seconds != 0, seconds)
