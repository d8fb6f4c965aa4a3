"""Registered queries of the engine's own operators and the SQL they are held against.

The engine's tables are mapped on the driver's: line items are fragments, suppliers readers, part brands books, conversations the
paragraphs of books, documents descriptions, events recognised words, pages document bodies.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.functions import numeric, text
from quillcast.operators import align, classifier, labels, manifest, names, paragraphs, prompts, sampling, scores, split, transcripts
from quillcast.sources import documents as html
from quillcast.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _fragments(spark: SparkSession, d: str) -> DataFrame:
    level = lambda c: F.when(c == "R", "high").when(c == "A", "low").otherwise("neutral")
    li = _t(spark, d, "lineitem")
    part = _t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("book_name"))
    return li.join(part, "l_partkey").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fragment_id"),
        F.col("l_suppkey").alias("reader"),
        "book_name",
        level(F.col("l_returnflag")).alias("loudness"),
        level(F.col("l_returnflag")).alias("pitch"),
        F.when(F.col("l_linestatus") == "F", "high").otherwise("low").alias("tempo"),
        F.lit("neutral").alias("tension"),
        F.col("l_extendedprice").alias("egm_loudness"),
        F.col("l_quantity").alias("egm_f0_std"),
        F.col("l_discount").alias("egm_voiced_rate"),
        F.col("l_tax").alias("egm_jitter"),
        (F.col("l_quantity") * 1.5 - 1.5).alias("duration_s"),
        F.col("l_tax").alias("match_distance_norm"),
        (F.col("l_quantity") / 2).cast("long").alias("n_words_matched"),
        (F.col("l_discount") * 10).alias("voiced_ratio"),
        (F.col("l_tax") * 10).alias("silence_ratio"),
        (F.col("l_quantity") / 12).alias("edge_start_ratio"),
        F.lit(1.0).alias("edge_end_ratio"),
        (F.col("l_discount") * 2).alias("spec_flatness_mean"),
        F.concat_ws(" ", F.col("l_returnflag"), F.col("l_linestatus"), F.when(F.col("l_quantity") > 10, "a b").otherwise("")).alias("speech"),
    )


FEATS = list(scores.AXIS_FEATURES.values())
STATS = [f"{f}_{s}" for f in FEATS for s in ("med", "scale")]

_FRAG_SQL = """frag AS (SELECT l_orderkey * 10 + l_linenumber AS fragment_id, l_suppkey AS reader, p_brand AS book_name,
 CASE l_returnflag WHEN 'R' THEN 'high' WHEN 'A' THEN 'low' ELSE 'neutral' END AS loudness, l_extendedprice AS x, l_quantity AS q, l_discount AS di, l_tax AS tx
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _baseline(frag: DataFrame, feats=FEATS) -> DataFrame:
    """Baselines of the groups with five fragments or more; the others fall back."""
    enough = frag.groupBy("reader", "book_name").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5").select("reader", "book_name")
    return scores.median_mad(frag, ["reader", "book_name"], feats).join(enough, ["reader", "book_name"], "left_semi")


_BASE_SQL = _FRAG_SQL + """, med AS (SELECT reader, book_name, median(x) AS m, count(*) AS n FROM frag GROUP BY ALL),
 base AS (SELECT reader, book_name, any_value(m) AS m, median(abs(x - m)) * 1.4826 AS s FROM frag JOIN med USING (reader, book_name) WHERE n >= 5 GROUP BY ALL),
 r AS (SELECT reader, median(m) AS rm, median(s) AS rs FROM base GROUP BY ALL), g AS (SELECT median(m) AS gm, median(s) AS gs FROM base),
 f AS (SELECT frag.*, coalesce(m, rm, gm) AS med, coalesce(s, rs, gs) AS scale FROM frag LEFT JOIN base USING (reader, book_name) LEFT JOIN r USING (reader) CROSS JOIN g)"""


@query(
    f"""WITH {_BASE_SQL}, z AS (SELECT loudness, CASE WHEN scale > 0 THEN (x - med) / scale END AS z FROM f),
 a AS (SELECT loudness, round_even(z * 1000, 0) / 1000 AS anom, round_even((CASE loudness WHEN 'high' THEN 1.0 WHEN 'low' THEN -1.0 END * z) * 1000, 0) / 1000 AS agree FROM z),
 b AS (SELECT CASE WHEN loudness NOT IN ('high', 'low') THEN 'neutral' WHEN agree >= 0.5 THEN 'confirmed' ELSE 'unconfirmed' END AS manner_bucket,
 coalesce(loudness = 'high' AND anom < -1.0, false) AS underdelivery, anom FROM a)
 SELECT manner_bucket, underdelivery, count(*) AS n, round(avg(anom), 6) AS mean_anom FROM b GROUP BY ALL"""
)
def q01_robust_score_buckets(spark, d):
    frag = _fragments(spark, d)
    one = {"loudness": "egm_loudness"}
    rows = frag.select("reader", "book_name", "loudness", "egm_loudness")
    full = scores.hierarchical_fallback(rows, _baseline(rows, ["egm_loudness"]), ["egm_loudness_med", "egm_loudness_scale"])
    out = scores.delivery(full, one)
    return out.groupBy("manner_bucket", "underdelivery").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("loudness_anom"), 6).alias("mean_anom"))


@query(
    f"""WITH {_FRAG_SQL}, med AS (SELECT reader, book_name, median(x) AS mx, median(q) AS mq FROM frag GROUP BY ALL)
 SELECT reader, book_name, round(any_value(mx), 6) AS egm_loudness_med, round(median(abs(x - mx)) * 1.4826, 6) AS egm_loudness_scale,
 round(any_value(mq), 6) AS egm_f0_std_med, round(median(abs(q - mq)) * 1.4826, 6) AS egm_f0_std_scale FROM frag JOIN med USING (reader, book_name) GROUP BY ALL"""
)
def q02_baseline_med_mad(spark, d):
    out = scores.median_mad(_fragments(spark, d), ["reader", "book_name"], FEATS[:2])
    return out.select("reader", "book_name", *[F.round(c, 6).alias(c) for c in STATS[:4]])


@query(f"WITH {_BASE_SQL} SELECT fragment_id, round(med, 6) AS egm_loudness_med, round(scale, 6) AS egm_loudness_scale FROM f")
def q03_hierarchical_fallback(spark, d):
    frag = _fragments(spark, d).select("fragment_id", "reader", "book_name", "egm_loudness")
    out = scores.hierarchical_fallback(frag, _baseline(frag, ["egm_loudness"]), STATS[:2])
    return out.select("fragment_id", *[F.round(c, 6).alias(c) for c in STATS[:2]])


_FLAGS_SQL = """fl AS (SELECT l_orderkey * 10 + l_linenumber AS fragment_id, l_quantity * 1.5 - 1.5 <= 0 AS junk_zerodur, l_quantity * 1.5 - 1.5 >= 60 AS junk_toolong,
 l_discount * 10 < 0.30 AS junk_nonspeech, l_tax * 10 > 0.55 AS junk_silence, l_quantity * 1.5 - 1.5 < 0.40 AS junk_tooshort,
 l_quantity <= 10 AS junk_few_words, trunc(l_quantity / 2) <= 3 AS junk_few_asr_words, l_quantity / 12 > 3 AS junk_truncation,
 l_discount * 2 > 0.15 AS junk_flatness_soft, l_tax >= 0.05 AS junk_badmatch, l_quantity * 1.5 - 1.5 <= 0 OR l_quantity * 1.5 - 1.5 >= 60 OR l_quantity * 1.5 - 1.5 < 0.40 AS junk_any_hard
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""
FLAGS = ["junk_zerodur", "junk_toolong", "junk_nonspeech", "junk_silence", "junk_tooshort", "junk_few_words", "junk_few_asr_words", "junk_truncation", "junk_flatness_soft", "junk_badmatch", "junk_any_hard"]


def _flagged(spark, d):
    return scores.junk_flags(_fragments(spark, d), max_distance=0.05)


@query(f"WITH {_FLAGS_SQL} SELECT * FROM fl")
def q04_junk_flags(spark, d):
    return _flagged(spark, d).select("fragment_id", *FLAGS)


@query(
    f"WITH {_FLAGS_SQL} SELECT flag, sum(v::INT)::BIGINT AS n, round(avg(v::INT) * 100, 6) AS pct FROM (UNPIVOT fl ON {', '.join(FLAGS)} INTO NAME flag VALUE v) GROUP BY ALL"
)
def q05_flag_summary(spark, d):
    return scores.flag_summary(_flagged(spark, d), FLAGS).select("flag", "n", F.round("pct", 6).alias("pct"))


def _hours(spark, d):
    li = _t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg((F.sum("l_quantity") / 3600).alias("hours"))
    sup = _t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("g"), (F.col("s_nationkey") % 2).cast("string")).alias("reader_gender"))
    return li.join(sup, "s_suppkey").select(F.col("s_suppkey").cast("string").alias("reader"), "reader_gender", "hours")


_LPT_SQL = """WITH RECURSIVE h AS (SELECT s_suppkey::VARCHAR AS reader, 'g' || (s_nationkey % 2) AS reader_gender, sum(l_quantity) / 3600 AS hours
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
 o AS (SELECT *, row_number() OVER (PARTITION BY reader_gender ORDER BY hours DESC, md5('0:' || reader)) AS k, sum(hours) OVER (PARTITION BY reader_gender) AS total FROM h),
 s AS (SELECT reader_gender, 0::BIGINT AS k, ''::VARCHAR AS reader, 0.0::DOUBLE AS hours, ''::VARCHAR AS split, any_value(total) * 0.8 AS a, any_value(total) * 0.1 AS b, any_value(total) * 0.1 AS c FROM o GROUP BY reader_gender
 UNION ALL SELECT o.reader_gender, o.k, o.reader, o.hours, CASE WHEN a >= b AND a >= c THEN 'train' WHEN b >= c THEN 'val' ELSE 'test' END,
 a - CASE WHEN a >= b AND a >= c THEN o.hours ELSE 0 END, b - CASE WHEN NOT (a >= b AND a >= c) AND b >= c THEN o.hours ELSE 0 END, c - CASE WHEN NOT (a >= b AND a >= c) AND b < c THEN o.hours ELSE 0 END
 FROM s JOIN o ON o.reader_gender = s.reader_gender AND o.k = s.k + 1)"""


@query(_LPT_SQL + " SELECT reader, reader_gender, round(hours, 6) AS hours, split FROM s WHERE k > 0")
def q06_lpt_split(spark, d):
    return split.lpt_split(_hours(spark, d)).select("reader", "reader_gender", F.round("hours", 6).alias("hours"), "split")


@query(_LPT_SQL + " SELECT reader_gender, split, count(*) AS readers, round(sum(hours), 4) AS hours FROM s WHERE k > 0 GROUP BY ALL")
def q07_split_summary(spark, d):
    return split.summary(split.lpt_split(_hours(spark, d))).withColumn("hours", F.round("hours", 4))


@query(
    f"""WITH {_FLAGS_SQL} SELECT fl.fragment_id, o_custkey AS reader, n_name AS book_genres, c_mktsegment AS reader_gender
 FROM fl JOIN lineitem ON fl.fragment_id = l_orderkey * 10 + l_linenumber JOIN orders ON l_orderkey = o_orderkey
 LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON l_suppkey % 25 = n_nationkey
 WHERE NOT junk_any_hard AND NOT junk_badmatch AND NOT junk_few_words AND NOT junk_few_asr_words AND o_orderstatus = 'F'"""
)
def q08_manifest_joins(spark, d):
    scored = _flagged(spark, d).select("fragment_id", *scores.HARD_FLAGS)
    li = _t(spark, d, "lineitem").select("l_orderkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fragment_id"), (F.col("l_suppkey") % 25).cast("int").alias("path_book"))
    dataset = li.join(_t(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("fragment_id", "path_book", F.col("o_custkey").alias("reader"), F.col("o_orderstatus").alias("cut_status"))
    registry = _t(spark, d, "nation").select(F.col("n_nationkey").alias("path_book"), F.col("n_name").alias("book_genres"))
    gender = _t(spark, d, "customer").select(F.col("c_custkey").alias("reader"), F.col("c_mktsegment").alias("gender"))
    out = manifest.build(scored, dataset, registry, gender, accept_statuses=("F",))
    return out.select("fragment_id", "reader", "book_genres", "reader_gender")


@query(
    """SELECT user_id, max(CASE WHEN event_type = 'click' THEN event_id END) AS embedding_row_click, max(CASE WHEN event_type = 'view' THEN event_id END) AS embedding_row_view,
 max(CASE WHEN event_type = 'purchase' THEN event_id END) AS embedding_row_purchase FROM events GROUP BY user_id"""
)
def q09_index_pivot(spark, d):
    index = _t(spark, d, "events").select("user_id", F.col("event_type").alias("model"), F.col("event_id").alias("row"))
    return manifest.index_pivot(index, "user_id", ["click", "view", "purchase"])


@query(
    """SELECT o_orderkey AS fragment_id, o_custkey AS path_book, c_name AS link, md5(o_orderpriority) AS sha256 FROM orders LEFT JOIN customer ON o_custkey = c_custkey"""
)
def q10_publish_projection(spark, d):
    m = _t(spark, d, "orders").select(F.col("o_orderkey").alias("fragment_id"), F.col("o_custkey").alias("path_book"), F.col("o_orderpriority").alias("reader"), F.lit("b").alias("book_name"))
    registry = _t(spark, d, "customer").select(F.col("c_custkey").alias("path_book"), F.col("c_name").alias("link"))
    sums = m.select("reader", "book_name").distinct().withColumn("sha256", F.md5("reader"))
    return manifest.publish(m, registry, sums, ["fragment_id", "path_book"])


@query("SELECT text, arg_min(doc_id, doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY text")
def q11_dropdup_first(spark, d):
    return sampling.keep_first(_t(spark, d, "documents").select("text", "doc_id", "source"), ["text"], ["doc_id"])


@query("SELECT md5(text) AS content_md5, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY ALL")
def q12_content_hash_dedup(spark, d):
    return sampling.content_dedup(_t(spark, d, "documents"), "text", "doc_id")


_NORM = r"""trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '[«»"“”„]', '"', 'g'), '[—–]', '-', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT doc_id, {_NORM.format('text')} AS normalized FROM documents")
def q13_normalize_text(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.normalize_for_match(F.col("text")).alias("normalized"))


#: The first sentence of a text stands in for a speech.
_FIRST_SENTENCE = r"[^.!?\s][^.!?]*"
_SENTENCE = f"regexp_extract(text, '{_FIRST_SENTENCE}')"


def _sentence(column: str):
    return F.regexp_extract(column, _FIRST_SENTENCE, 0)


@query(
    f"""SELECT conv_id, c.turn, contains(n, {_NORM.format('s')}) AND s <> '' AS near, contains(t, s) AND s <> '' AS exact
 FROM (SELECT conv_id, turn, text AS t, {_NORM.format('text')} AS n, lead({_SENTENCE}, 1, {_SENTENCE}) OVER (PARTITION BY conv_id ORDER BY turn) AS s FROM conversations) c"""
)
def q14_guard_contains(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    c = _t(spark, d, "conversations").withColumn("said", _sentence("text"))
    c = c.withColumn("s", F.coalesce(F.lead("said").over(w), "said"))
    s, t = F.col("s"), F.col("text")
    return c.select("conv_id", "turn", text.speech_in_chunk(s, t).alias("near"), text.speech_in_chunk(s, t, exact=True).alias("exact"))


_DIALOGUE = r"""regexp_matches({0}, '(^|\n)\s*[—–-]\s+\S|«[^»]+»|"[^"\n]{{2,}}"')"""


@query(f"SELECT doc_id, {_DIALOGUE.format('text')} AS has_dialogue FROM documents")
def q15_dialogue_flag(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.has_dialogue(F.col("text")).alias("has_dialogue"))


@query(
    f"""SELECT conv_id, turn, has_dialogue, max(has_dialogue) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near_dialogue
 FROM (SELECT *, {_DIALOGUE.format("CASE WHEN turn % 3 = 0 THEN '— ' || text ELSE text END")} AS has_dialogue FROM conversations)"""
)
def q16_dialogue_context(spark, d):
    c = _t(spark, d, "conversations").withColumn("text", F.when(F.col("turn") % 3 == 0, F.concat(F.lit("— "), "text")).otherwise(F.col("text")))
    return paragraphs.dialogue_context(c, "conv_id", "turn", "text").select("conv_id", "turn", "has_dialogue", "near_dialogue")


@query(
    """SELECT conv_id, turn, lag(text, 1, '') OVER w || ' ' || lead(text, 1, '') OVER w AS context, lag(u, 1, 0.0::DOUBLE) OVER w AS prev_u, lead(u, 1, 0.0::DOUBLE) OVER w AS next_u
 FROM (SELECT *, (role = 'user')::INT::DOUBLE AS u FROM conversations) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)"""
)
def q17_context_features(spark, d):
    c = _t(spark, d, "conversations").withColumn("u", (F.col("role") == "user").cast("int").cast("double"))
    out = paragraphs.neighbour_flags(paragraphs.context_text(c, "conv_id", "turn", "text"), "conv_id", "turn", ["u"])
    return out.select("conv_id", "turn", "context", "prev_u", "next_u")


@query(
    """WITH RECURSIVE p AS (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE text IS NOT NULL),
 s AS (SELECT conv_id, k, 0::BIGINT AS chunk_id, length(text)::BIGINT AS n, text FROM p WHERE k = 1
 UNION ALL SELECT p.conv_id, p.k, CASE WHEN s.n + length(p.text) > 600 THEN s.chunk_id + 1 ELSE s.chunk_id END, CASE WHEN s.n + length(p.text) > 600 THEN length(p.text) ELSE s.n + length(p.text) END, p.text
 FROM s JOIN p ON p.conv_id = s.conv_id AND p.k = s.k + 1)
 SELECT conv_id, chunk_id::INT AS chunk_id, string_agg(text, chr(10) || chr(10) ORDER BY k) AS chunk_text FROM s GROUP BY ALL"""
)
def q18_chunk_pack(spark, d):
    return paragraphs.chunk_books(_t(spark, d, "conversations"), "conv_id", "turn", "text", 600)


@query(r"SELECT doc_id, len(regexp_extract_all(text, '\S+'))::INT AS n_words FROM documents WHERE len(regexp_extract_all(text, '\S+')) > 3")
def q19_word_count_filter(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", text.word_count(F.col("text")).cast("int").alias("n_words"))
    return docs.filter("n_words > 3")


@query(
    r"""SELECT conv_id, turn, (trim(t) = '' OR regexp_matches(trim(t), '^[-—–\s]*$') OR regexp_matches(trim(t), '(?i)^null$|без\s+описани|нет\s+описани|не\s+указан|^нет\.?$')
 OR lower(t) IN ('сказал', 'сказала она')) AS junk FROM (SELECT conv_id, turn, CASE turn % 7 WHEN 0 THEN ' — ' WHEN 1 THEN 'Сказала она.' WHEN 2 THEN 'без  описания манеры' WHEN 3 THEN 'NULL' ELSE text END AS t0,
 regexp_replace(t0, '\.+$', '') AS t FROM conversations)"""
)
def q20_junk_description(spark, d):
    fake = F.when(F.col("turn") % 7 == 0, " — ").when(F.col("turn") % 7 == 1, "Сказала она.").when(F.col("turn") % 7 == 2, "без  описания манеры").when(F.col("turn") % 7 == 3, "NULL").otherwise(F.col("text"))
    return _t(spark, d, "conversations").select("conv_id", "turn", text.is_junk_description(fake).alias("junk"))


@query(
    f"""WITH s AS (SELECT conv_id, {_SENTENCE} AS s FROM conversations WHERE turn = 1 AND {_SENTENCE} <> '')
 SELECT conv_id, turn, coalesce(bool_or(contains(text, s)), false)::INT AS label FROM conversations LEFT JOIN s USING (conv_id) GROUP BY ALL"""
)
def q21_label_containment(spark, d):
    c = _t(spark, d, "conversations")
    speeches = c.filter("turn = 1").select("conv_id", _sentence("text").alias("s"))
    return paragraphs.containment_labels(c, speeches, "conv_id", "text", "s").select("conv_id", "turn", "label")


_WORDS_SQL = """SELECT user_id, event_id, event_type, epoch_us(ts)::DOUBLE / 1e6 AS s, epoch_us(ts)::DOUBLE / 1e6 + abs(value) * 500 AS e FROM events"""


def _words(spark, d):
    seconds = F.unix_micros(F.to_timestamp(F.col("ts").cast("timestamp"))).cast("double") / 1e6
    return _t(spark, d, "events").select("user_id", "event_id", "event_type", seconds.alias("start"), (seconds + F.abs("value") * 500).alias("end"))


@query(
    f"""SELECT user_id, event_id, round(CASE WHEN e > lead(s) OVER w THEN (e + lead(s) OVER w) / 2 ELSE e END, 3) AS fixed_end,
 round(CASE WHEN lag(e) OVER w > s THEN (lag(e) OVER w + s) / 2 ELSE s END, 3) AS fixed_start FROM ({_WORDS_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY s, event_id)"""
)
def q22_overlap_repair(spark, d):
    out = transcripts.repair_overlaps(_words(spark, d), "user_id", ["start", "event_id"])
    return out.select("user_id", "event_id", F.round("fixed_end", 3).alias("fixed_end"), F.round("fixed_start", 3).alias("fixed_start"))


@query(
    """SELECT user_id, event_id, coalesce(sum(length(event_type) + 1) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM events"""
)
def q23_char_offsets(spark, d):
    return transcripts.char_offsets(_t(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "event_id", "char_start")


@query(
    """WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM (SELECT DISTINCT conv_id, turn FROM conversations))
 SELECT conv_id, turn FROM c WHERE n <= 3 OR k IN (0, n // 2, n - 1)"""
)
def q24_sample_positions(spark, d):
    return paragraphs.sample_positions(_t(spark, d, "conversations"), "conv_id", "turn")


@query(
    """SELECT user_id, event_id, CASE WHEN count(value) OVER w >= 5 THEN round(least(greatest(median(value) OVER w / 100 + 0.2, 0.5), 0.85), 9) ELSE 0.55 END AS threshold
 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def q25_expanding_baseline(spark, d):
    e = _t(spark, d, "events").withColumn("v", F.col("value") / 100)
    out = transcripts.expanding_threshold(e, "user_id", ["ts", "event_id"], "v")
    return out.select("user_id", "event_id", F.round("threshold", 9).alias("threshold"))


@query(
    """SELECT event_id, event_type AS description, CASE (length(event_type)) % 3 WHEN 0 THEN 'low' WHEN 1 THEN 'neutral' ELSE 'high' END AS loudness, 'ok' AS axes_status FROM events"""
)
def q26_distinct_label_joinback(spark, d):
    e = _t(spark, d, "events").select("event_id", F.col("event_type").alias("description"))
    got = labels.axes_of(e, labels.Fake())
    return labels.join_back(e, got, "description", {"loudness": "neutral", "axes_status": "missing"}).select("event_id", "description", "loudness", "axes_status")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)")
def q27_resume_anti(spark, d):
    done = _t(spark, d, "customer").filter("c_nationkey < 10").select(F.col("c_custkey").alias("o_custkey"))
    return sampling.not_done(_t(spark, d, "orders").select("o_orderkey", "o_custkey"), done, ["o_custkey"])


@query(
    """SELECT count(*) AS orders, count(c_custkey) AS matched, count(*) - count(c_custkey) AS missing FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < 20) ON o_custkey = c_custkey"""
)
def q28_registry_join_missing(spark, d):
    reg = _t(spark, d, "customer").filter("c_nationkey < 20").select("c_custkey")
    both = _t(spark, d, "orders").join(reg, F.col("o_custkey") == F.col("c_custkey"), "left")
    return both.agg(F.count(F.lit(1)).alias("orders"), F.count("c_custkey").alias("matched"), F.count_if(F.col("c_custkey").isNull()).alias("missing"))


@query(
    """SELECT doc_id, CASE WHEN k <= 50 THEN 'train_cv' ELSE 'holdout' END AS sample FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k FROM documents) WHERE k <= 100"""
)
def q29_disjoint_sample(spark, d):
    return sampling.disjoint_samples(_t(spark, d, "documents").select("doc_id"), "doc_id", {"train_cv": 50, "holdout": 50})


@query("SELECT source, ((row_number() OVER (ORDER BY md5('42:' || source), source) - 1) % 5)::INT AS fold FROM (SELECT DISTINCT source FROM documents)")
def q30_kfold_assign(spark, d):
    return sampling.kfold(_t(spark, d, "documents"), "source")


def _planted(spark, d):
    """Whole conversation texts as queries inside the joined text of their conversation."""
    c = _t(spark, d, "conversations").filter(F.length("text") > 0)
    whole = transcripts.joined_text(c, "conv_id", "turn", "text")
    return c.join(whole, "conv_id").select("conv_id", "turn", F.col("text").alias("q"), F.col("joined_text").alias("joined"))


_PLANTED_SQL = "SELECT conv_id, turn, text FROM conversations WHERE length(text) > 0 AND conv_id IS NOT NULL"


# every planted sign occurs nowhere else, so each costs one edit and no more
@query(
    f"""WITH p AS ({_PLANTED_SQL}), k AS (SELECT *, CASE WHEN turn % 2 = 1 THEN length(text) - length(regexp_replace(text, '[vV]', '', 'g')) ELSE 0 END AS n FROM p)
 SELECT conv_id, turn, n::BIGINT AS distance, round(n / length(text), 9) AS ratio FROM k"""
)
def q31_infix_distance(spark, d):
    p = _planted(spark, d).withColumn("q", F.when(F.col("turn") % 2 == 1, F.translate("q", "vV", "¤¤")).otherwise(F.col("q")))
    return align.distances(p, "q", "joined").select("conv_id", "turn", "distance", F.round("ratio", 9).alias("ratio"))


@query(
    f"""WITH p AS ({_PLANTED_SQL}), k AS (SELECT *, length(text) AS m, CASE WHEN turn % 3 = 2 THEN length(text) - length(regexp_replace(text, '[aeiouAEIOU]', '', 'g')) ELSE 0 END AS n FROM p)
 SELECT conv_id, turn, CASE WHEN turn % 3 <> 1 AND n <= greatest(m // 2, 10) THEN round_even(n / m * 1000, 0) / 1000 END AS ratio,
 CASE WHEN turn % 3 = 1 THEN 'no_audio_json' WHEN n <= greatest(m // 2, 10) AND n / m < 0.35 THEN 'ok' ELSE 'mismatch' END AS status FROM k"""
)
def q32_pair_gate(spark, d):
    kind = F.col("turn") % 3
    p = _planted(spark, d).select(
        "conv_id", "turn", F.when(kind == 2, F.translate("q", "aeiouAEIOU", "¤" * 10)).otherwise(F.col("q")).alias("sample_text"), F.when(kind != 1, F.col("joined")).alias("audio_text")
    )
    return align.check_pairs(p).select("conv_id", "turn", "ratio", "status")


@query()
def q33_two_level_match(spark, d):
    c = _t(spark, d, "conversations").filter("text is not null")
    key = F.col("conv_id").cast("string")
    frags = c.select(key.alias("path_book"), F.lit("r").alias("reader"), key.alias("path_audio"), F.col("turn").alias("chunk_id"), F.lit(0).cast("long").alias("pos"), F.col("text").alias("chunk_text"), _sentence("text").alias("speech"))
    words = c.select(key.alias("path_audio"), "turn", F.posexplode(F.split("text", r"\s+")).alias("k", "word"))
    at = (F.col("turn") * 100_000 + F.col("k")).cast("long")
    words = words.select("path_audio", at.alias("word_idx"), "word", at.cast("double").alias("start"), (at + 0.5).cast("double").alias("end"), F.lit(0.9).alias("score"))
    out = align.match_all(frags, words)
    return out.select("kind", "path_book", "chunk_id", "match_status", "match_distance", F.round("match_distance_norm", 6).alias("match_distance_norm"), "n_words_matched", "search_window_expanded")


@query()
def q34_anonymize(spark, d):
    docs = _t(spark, d, "documents").select(F.col("text").alias("description"), F.element_at(F.split("text", r"\s+"), 1).alias("character"))
    return names.anonymize(docs).select("description", "description_anon", "changed", F.array_join("names", "|").alias("names"))


@query("SELECT regexp_extract(event_type || CASE WHEN value > 50 THEN '(v=' || user_id || ')' ELSE ':x' END, '^[^(:]*') AS status, count(*) AS n FROM events GROUP BY ALL")
def q35_status_prefix_counts(spark, d):
    status = F.concat("event_type", F.when(F.col("value") > 50, F.concat(F.lit("(v="), F.col("user_id").cast("string"), F.lit(")"))).otherwise(":x"))
    return _t(spark, d, "events").groupBy(text.status_prefix(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def q36_json_props(spark, d):
    return _t(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


_CENTROID_SQL = "m AS (SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings) GROUP BY ALL)"


@query(f"WITH {_CENTROID_SQL} SELECT label, i::INT AS dim, round(m, 9) AS mean FROM m")
def q37_prompt_ensemble_centroid(spark, d):
    c = prompts.centroids(_t(spark, d, "embeddings"), "label", "embedding")
    return c.select("label", F.posexplode("centroid").alias("dim", "mean")).select("label", "dim", F.round("mean", 9).alias("mean"))


@query(
    f"""WITH {_CENTROID_SQL}, c AS (SELECT label, list(m ORDER BY i) AS c FROM m GROUP BY label),
 s AS (SELECT vec_id, label, round_even(list_cosine_similarity(e.embedding::DOUBLE[], c.c) * 1e9, 0) / 1e9 AS s FROM (SELECT vec_id, embedding FROM embeddings) e CROSS JOIN c)
 SELECT vec_id, arg_max(label, s) AS best FROM (SELECT * FROM s ORDER BY label) GROUP BY vec_id"""
)
def q38_zero_shot_assign(spark, d):
    e = _t(spark, d, "embeddings")
    return prompts.zero_shot(e, prompts.centroids(e, "label", "embedding"), "vec_id", "embedding", "label").select("vec_id", "best")


@query(
    """WITH s AS (SELECT quality AS label, (doc_id % 100) / 100.0 AS prob FROM labels), t AS (SELECT (x * 5) / 100.0 AS threshold FROM range(1, 19) r(x))
 SELECT threshold, sum((prob >= threshold)::INT)::BIGINT AS kept, count(*) AS total, round(sum((prob >= threshold AND label = 1)::INT) / sum((label = 1)::INT), 9) AS recall, round(1 - sum((prob >= threshold)::INT) / count(*), 9) AS economy FROM s CROSS JOIN t GROUP BY ALL"""
)
def q39_threshold_sweep(spark, d):
    scored = _t(spark, d, "labels").select(F.col("quality").alias("label"), ((F.col("doc_id") % 100) / 100).alias("prob"))
    out = classifier.threshold_sweep(scored, [5 * k / 100 for k in range(1, 19)])
    return out.select("threshold", "kept", "total", F.round("recall", 9).alias("recall"), F.round("economy", 9).alias("economy"))


@query()
def q40_hybrid_classifier(spark, d):
    lab = sampling.keep_first(_t(spark, d, "labels"), ["doc_id"], ["quality", "toxic"]).select("doc_id", F.col("quality").cast("double").alias("label"))
    docs = _t(spark, d, "documents").select("doc_id", "text", F.col("source").alias("context"))
    # one file would be one task
    rows = classifier.with_flags(docs.join(lab, "doc_id").repartition(4 * spark.sparkContext.defaultParallelism, "doc_id"), "text")
    model = classifier.fit(rows)
    return classifier.score(model, rows).select("doc_id", "label", F.round("prob", 6).alias("prob"))


@query()
def q41_html_paragraphs(spark, d):
    return html.paragraphs_of_html(_t(spark, d, "pages"), "page_id", "html")


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def q42_offset_limit(spark, d):
    return sampling.page(_t(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 1000, 500)


@query(
    """SELECT event_id, (row_number() OVER (ORDER BY user_id, ts, event_id) - 1)::BIGINT AS fragment_id, round_even(value * 1000, 0) / 1000 AS fragment_duration,
 round(user_id / nullif(value, 0), 6) AS words_per_sec FROM events"""
)
def q43_fragment_id(spark, d):
    e = transcripts.fragment_ids(_t(spark, d, "events").select("event_id", "user_id", "ts", "value"), ["user_id", "ts", "event_id"])
    v = F.col("value")
    return e.select("event_id", "fragment_id", numeric.round3(v).alias("fragment_duration"), F.round(scores.words_per_second(F.col("user_id"), v), 6).alias("words_per_sec"))


@query(
    """WITH u AS (SELECT source AS description, lang AS loudness, doc_id FROM documents WHERE lang <> 'en' UNION ALL SELECT source, lang, doc_id FROM documents WHERE lang = 'en'),
 a AS (SELECT description, arg_min(loudness, doc_id) AS loudness FROM u GROUP BY ALL) SELECT doc_id, coalesce(loudness, 'neutral') AS loudness FROM documents LEFT JOIN a ON source = description"""
)
def q44_union_axes(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.col("source").alias("description"), "lang")
    axes = docs.filter("lang <> 'en'").unionByName(docs.filter("lang = 'en'")).withColumns({a: F.col("lang") for a in scores.AXIS_FEATURES})
    return scores.with_axes(docs.select("doc_id", "description"), axes, order="doc_id").select("doc_id", "loudness")


@query("SELECT doc_id, sha256(text) AS checksum, md5(text) AS content_md5 FROM documents")
def q45_file_checksum(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("checksum"), F.md5("text").alias("content_md5"))


@query(
    r"""WITH p AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS parts FROM documents),
 k AS (SELECT *, list_transform(parts, lambda x, i: {'n': -length(x), 'i': i, 'p': x}) AS keyed FROM p),
 h AS (SELECT *, list_sort(list_filter(keyed, lambda x: -x.n BETWEEN 100 AND 350))[1].p AS handy, list_sort(keyed)[1].p AS longest FROM k)
 SELECT doc_id, len(parts)::INT AS parts, coalesce(handy, substring(longest, 1, 300)) AS sample, right(regexp_replace(regexp_replace(text, '[^0-9a-zA-Zа-яА-Я]+', '_', 'g'), '^_+|_+$', '', 'g'), 150) AS safe FROM h"""
)
def q46_paragraph_samples(spark, d):
    t = F.col("text")
    return _t(spark, d, "documents").select("doc_id", F.size(text.blank_line_parts(t)).alias("parts"), text.sample_paragraph(t).alias("sample"), text.safe_name(t).alias("safe"))


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def q47_csv_round_trip(spark, d):
    path = tables.scratch_path(spark, "orders-csv")
    tables.write_csv(_t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"), path)
    schema = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, o_orderstatus string"
    return tables.read_csv_present(spark, [path, f"{path}-absent"], schema).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(
    """SELECT 'texts' AS what, count(DISTINCT text)::BIGINT AS n FROM documents UNION ALL SELECT 'sources', count(DISTINCT source) FROM documents UNION ALL SELECT 'langs', count(DISTINCT lang) FROM documents
 UNION ALL SELECT 'null ' || c, n FROM (SELECT 'text' AS c, count(*) FILTER (text IS NULL) AS n FROM documents UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL) FROM labels)"""
)
def q48_counts(spark, d):
    docs = _t(spark, d, "documents")
    distinct = docs.agg(F.count_distinct("text").alias("texts"), F.count_distinct("source").alias("sources"), F.count_distinct("lang").alias("langs"))
    distinct = distinct.select(F.inline(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).alias("n")) for c in ("texts", "sources", "langs")])))
    nulls = manifest.null_counts(docs, ["text"]).union(manifest.null_counts(_t(spark, d, "labels"), ["quality"]))
    return distinct.union(nulls.select(F.concat(F.lit("null "), "column"), F.col("nulls").cast("long")))


@query("SELECT event_id, round(CASE WHEN value > 0 THEN 12 * log2(value) END, 6) AS semitones, round(100.0 * user_id / greatest(event_id, 1), 6) AS percent FROM events")
def q49_semitones(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", F.round(numeric.semitones(F.col("value")), 6).alias("semitones"), F.round(numeric.percent(F.col("user_id"), F.col("event_id")), 6).alias("percent"))


@query(
    """WITH l AS (SELECT DISTINCT doc_id FROM labels), t AS (SELECT doc_id FROM labels WHERE toxic = 1), d AS (SELECT doc_id, source FROM documents)
 SELECT 'listed' AS what, doc_id FROM d WHERE doc_id IN (SELECT doc_id FROM l) UNION ALL SELECT 'unlisted', doc_id FROM d WHERE doc_id NOT IN (SELECT doc_id FROM l)
 UNION ALL (SELECT 'both', doc_id FROM d INTERSECT SELECT 'both', doc_id FROM t)
 UNION ALL SELECT 'pair open', doc_id FROM d WHERE (doc_id, source) NOT IN (SELECT doc_id, source FROM documents WHERE source = 'src1' AND doc_id IN (SELECT doc_id FROM l))"""
)
def q50_set_operators(spark, d):
    docs, lab = _t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels")
    done = sampling.only(docs.filter("source = 'src1'"), lab, "doc_id")
    parts = {
        "listed": sampling.only(docs, lab, "doc_id"),
        "unlisted": sampling.without(docs, "doc_id", lab.filter("toxic = 1"), lab.filter("toxic = 0"), lab.filter("toxic is null")),
        "both": sampling.overlap(docs, lab.filter("toxic = 1"), "doc_id"),
        "pair open": sampling.not_done(docs, done, ["doc_id", "source"]),
    }
    return reduce(DataFrame.unionByName, [p.select(F.lit(k).alias("what"), "doc_id") for k, p in parts.items()])


@query("SELECT lang, source, least(count(*), 5)::BIGINT AS n, least(count(*), 5)::BIGINT AS ids FROM documents GROUP BY lang, source")
def q51_sample_per_group(spark, d):
    some = sampling.sample_per_group(_t(spark, d, "documents").select("lang", "source", "doc_id"), ["lang", "source"], "doc_id", 5, seed=3)
    return some.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"))


@query("SELECT doc_id::VARCHAR AS doc_id, NULL::DOUBLE AS loudness, lang FROM documents")
def q52_reindex(spark, d):
    return sampling.ensure_columns(_t(spark, d, "documents"), {"doc_id": "string", "loudness": "double", "lang": "string"})


@query("SELECT c_custkey, c_name || '|' || c_nationkey AS line FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_name || '|' || (c_nationkey + 100) FROM customer WHERE c_custkey % 2 = 1")
def q53_append_and_rewrite(spark, d):
    path = tables.scratch_path(spark, "customers")
    rows = _t(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").cast("long").alias("c_nationkey"))
    for k in (0, 1):
        tables.append(rows.filter(F.col("c_custkey") % 2 == k), path)
    tables.rewrite(spark, path, lambda t: t.withColumn("c_nationkey", F.when(F.col("c_custkey") % 2 == 1, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))))
    return spark.read.parquet(path).select("c_custkey", F.concat("c_name", F.lit("|"), F.col("c_nationkey").cast("string")).alias("line"))


@query("SELECT conv_id AS book_id, turn AS chunk_id, text AS chunk_text FROM conversations WHERE conv_id IS NOT NULL")
def q54_jsonl_by_book(spark, d):
    path = tables.scratch_path(spark, "books")
    rows = _t(spark, d, "conversations").filter("conv_id is not null").select(F.col("conv_id").alias("book_id"), F.col("turn").alias("chunk_id"), F.col("text").alias("chunk_text"))
    tables.write_books(rows.withColumn("shelf", F.pmod("book_id", F.lit(7))), path, "shelf")
    return spark.read.schema("book_id long, chunk_id long, chunk_text string").json(path).select("book_id", "chunk_id", "chunk_text")


@query("SELECT doc_id, list_transform(regexp_extract_all(text, '[а-яёА-ЯЁ]+'), lambda x: x)::VARCHAR AS words, round(n_chars / nullif(length(text), 0), 6)::VARCHAR AS ratio FROM documents")
def q55_cyrillic_words(spark, d):
    words = text.cyrillic_words(F.col("text"))
    ratio = F.round(F.col("n_chars") / F.nullif(F.length("text"), F.lit(0)), 6)
    return _t(spark, d, "documents").select("doc_id", F.concat(F.lit("["), F.array_join(words, ", "), F.lit("]")).alias("words"), ratio.cast("string").alias("ratio"))
