"""The registered query of each operator, with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillcast.llm import ann, chat, dedup, langid, mixing, packing, quality, sharding, suffix_tree, urls
from quillcast.llm.common import crc_text, table

TOKENIZER = "byte_bpe_50k.json"


def op1_curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.assign(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"])


def op7_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_text(F.col("doc_id")), F.lit(4)) == 2
    found = langid.predict(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("x")).select("x.*")
    return chat.digest(chat.format_events(chat.from_turns(turns.unionByName(extra)), dealt=True))


def op9_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(crc_text(F.col("doc_id")), F.lit(5)) == 1
    scored = suffix_tree.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_curve_neighbours,
        op2_quality_rules,
        op3_hyperminhash,
        op4_best_fit_packing,
        op5_raked_mixture,
        op6_hilbert_shards,
        op7_language_crf,
        op8_chat_format,
        op9_url_trees,
        op10_suffix_tree,
    )
}


def _quality_sql() -> str:
    """The measures in SQL, with exact quantiles for the sketches (which are exact up to several thousand rows a group)."""
    low, high = {"mean_word_chars": "mean_word_chars"}, {"mean_word_chars": "mean_word_chars"}
    for r, (part, whole) in quality.RATES.items():
        low[r], high[r] = f"{part} / ({whole} + {quality.DOUBT})", f"({part} + {quality.DOUBT}) / ({whole} + {quality.DOUBT})"
    middle, upper = quality.QUANTILES
    q = lambda r, x: f"quantile_disc({high[r]}, {x}) FILTER (NOT base_failed)"
    fences = "count(*) FILTER (NOT base_failed)::DOUBLE AS n, " + ", ".join(f"{q(r, upper)} + {quality.SPREAD} * ({q(r, upper)} - {q(r, middle)}) AS f_{r}" for r in quality.MEASURES)
    drawn = lambda t, r, wider: f"(({t}.n * coalesce({t}.f_{r}, 0.0::DOUBLE) + {quality.PRIOR_ROWS}::DOUBLE * {wider}) / ({t}.n + {quality.PRIOR_ROWS}::DOUBLE))"
    chosen = ", ".join(drawn("fine", r, drawn("l", r, f"a.f_{r}")) + f" AS max_{r}" for r in quality.MEASURES)
    inside = " AND ".join(f"coalesce({low[r]} <= max_{r}, false)" for r in quality.MEASURES)
    counts = "n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"
    return rf"""WITH t AS (SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
 w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
 p AS (SELECT k, unnest(words) AS w0, unnest(range(len(words))) AS i FROM w),
 g AS (SELECT k, i, w0, lead(w0) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM p WINDOW o AS (PARTITION BY k ORDER BY i)),
 c AS (SELECT k, i, count(*) OVER (PARTITION BY k, w0, w1, w2) AS times FROM g WHERE w2 IS NOT NULL),
 r AS (SELECT k, count(DISTINCT i + d) AS n_repeat_words FROM c CROSS JOIN range(3) x(d) WHERE times > 1 GROUP BY k),
 m AS (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (k)),
 q AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, coalesce(word_chars / nullif(n_words, 0), 0.0) AS mean_word_chars FROM m),
 fine AS (SELECT lang, source, {fences} FROM q GROUP BY lang, source), l AS (SELECT lang, {fences} FROM q GROUP BY lang), a AS (SELECT {fences} FROM q),
 s AS (SELECT fine.lang, fine.source, {chosen} FROM fine LEFT JOIN l ON fine.lang IS NOT DISTINCT FROM l.lang CROSS JOIN a)
 SELECT doc_id, {counts}, base_failed, {", ".join(f"{low[r]} AS low_{r}" for r in quality.MEASURES)}, NOT base_failed AND {inside} AS kept
 FROM q JOIN s ON q.lang IS NOT DISTINCT FROM s.lang AND q.source IS NOT DISTINCT FROM s.source"""


def _chat_sql() -> str:
    """Turns and assistant texts hashed straight from the table; an escaped text has a character more for each backslash and control string."""

    def escaped(c: str) -> str:
        extra = [f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in ("\\", *chat.CONTROLS)]
        return f"length({c}) + " + " + ".join(extra)

    said, marks = "</s>[INST] ok [/INST]", len(chat.TURN + chat.SAY + chat.END)
    loss = f"coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = '{chat.LOSS_ROLE}'), '')"
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{said}'), (-7, 1, 'assistant', '{said}')))
 SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256, length({loss})::BIGINT AS loss_chars, sha256({loss}) AS loss_sha256,
 sum({marks} + {escaped("role")} + {escaped("text")})::BIGINT AS formatted_chars FROM t GROUP BY conv_id"""


#: The others are learned or approximate, or hash as SQL can't; tests hold them against brute force or held-out rows.
ORACLES: dict[str, str] = {"op2_quality_rules": _quality_sql(), "op8_chat_format": _chat_sql()}
