"""One query for each operator, over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnflow.llm import bpe_count, conversation_repair, decontaminate, jaccard_join, language_crf, license_scan, packing, quality, quote_threads, source_mix, spelling, suffix_tree, url_filter
from txnflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    return bpe_count.count_tokens(docs, model).select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op4_benchmark_decontamination")
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan_benchmark(docs, table(spark, sf_dir, "benchmark"))
    hits = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


OP2_SQL = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
positions AS (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS place FROM split WHERE len(words) >= 5),
windows AS (
  SELECT doc_id, place, count(*) OVER (PARTITION BY doc_id, list_slice(words, place, place + 4)) AS times FROM positions),
covered AS (
  SELECT doc_id, least(5, coalesce(lead(place) OVER (PARTITION BY doc_id ORDER BY place) - place, 5)) AS words
  FROM windows WHERE times > 1),
repeated AS (SELECT doc_id, sum(words) AS n FROM covered GROUP BY doc_id),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(list_aggregate(list_concat([''], words), 'string_agg', '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(words, lambda w: list_contains({quality.STOP_WORDS!r}, lower(w)))) AS n_stop,
         len(list_filter(list_zip(words[2:], words[:-2]), lambda p: p[1] = p[2])) AS n_equal
  FROM split LEFT JOIN repeated r USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR n_repeat_words > n_words * CAST(0.2 AS DOUBLE) AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < n_words * CAST(2.0 AS DOUBLE) OR word_chars > n_words * CAST(12.0 AS DOUBLE)
            OR n_symbols > n_words * CAST(0.1 AS DOUBLE)
            OR (n_words >= 60 AND n_stop < n_words * CAST(0.03 AS DOUBLE))
            OR n_equal > n_words * CAST(0.25 AS DOUBLE)
            OR (n_lines >= 5 AND n_dup_lines > n_lines * CAST(0.4 AS DOUBLE))) AS kept
FROM judged"""


@query("op2_quality_rules", OP2_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    measures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judge(docs).select("doc_id", *(F.col(f"quality.{m}").alias(m) for m in measures))


@query("op8_license_scans")
def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan_licenses(docs).select("doc_id", "licenses.*")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").cast("long").alias("first_word"),
        F.array_max("base.start").cast("long").alias("last_word"),
        license_scan.label_list("base").alias("base_labels"),
        license_scan.label_list("base", "finds").alias("labels"),
        license_scan.score("base", "finds").alias("score"),
    )


@query("op6_url_filters")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "url_check.host", "url_check.path", "url_check.rule", "url_check.verdict")


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_crf.remainder("doc_id", 3) == 1
    model = language_crf.train(docs.where(~held_out), seed_column="doc_id")
    found = language_crf.label_documents(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_ngram_jaccard_join")
def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_similar(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op1_lm_scoring")
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_tree.score_texts(docs, language_crf.remainder("doc_id", 7) != 2)
    measures = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return found.select("doc_id", (~F.col("training")).alias("held_out"), *measures)


@query("op11_source_mix")
def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = source_mix.mix_sources(docs, keep=["doc_id"])
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


@query("op12_spelling_variants")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_spellings(spelling.count_words(docs, spoil=31))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = conversation_repair.audit(conversation_repair.damaged(messages))
    ids = messages.select(F.col("conv_id").alias("id")).distinct()
    rows = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select(
        F.col("id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")
    )


_MARKS = "'^[ \\t]*(?:>[ \\t]*)+'"
OP9_SQL = f"""
WITH RECURSIVE rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
lines AS (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM rows),
read AS (
  SELECT conv_id, turn, line_no, length(regexp_replace(regexp_extract(line, {_MARKS}), '[^>]', '', 'g')) AS level,
         lower(trim(regexp_replace(regexp_replace(line, {_MARKS}, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS passage
  FROM lines),
passages AS (SELECT * FROM read WHERE passage <> '' AND conv_id IS NOT NULL AND turn IS NOT NULL),
origins AS (SELECT conv_id, passage, min(turn) AS origin FROM passages WHERE level = 0 GROUP BY ALL),
linked AS (
  SELECT DISTINCT q.conv_id, q.turn, q.line_no, q.level, q.passage, origin
  FROM passages q JOIN origins o ON q.conv_id = o.conv_id AND q.passage = o.passage WHERE q.level > 0 AND origin < q.turn),
votes AS (
  SELECT conv_id, turn, origin, count(*) AS n, count(*) FILTER (level = 1) AS direct FROM linked GROUP BY ALL),
parents AS (
  SELECT conv_id, turn, sum(n) AS n_linked,
         (max({{'a': direct, 'b': origin}}) FILTER (direct > 0)).b AS parent
  FROM votes GROUP BY ALL),
messages AS (
  SELECT DISTINCT r.conv_id, r.turn, p.parent FROM rows r LEFT JOIN parents p ON r.conv_id = p.conv_id AND r.turn = p.turn),
walk AS (
  SELECT conv_id, turn, turn AS root, CAST(0 AS BIGINT) AS depth FROM messages WHERE parent IS NULL
  UNION ALL
  SELECT m.conv_id, m.turn, w.root, w.depth + 1 FROM messages m JOIN walk w ON m.conv_id = w.conv_id AND m.parent = w.turn)
SELECT r.conv_id, r.turn, r.role, p.parent AS parent_turn, w.root AS thread_turn, w.depth,
       CAST(row_number() OVER (PARTITION BY r.conv_id, w.root ORDER BY r.turn, r.role, r.text) - 1 AS BIGINT) AS position,
       CAST(coalesce(q.n, 0) AS BIGINT) AS n_quote_lines, CAST(coalesce(p.n_linked, 0) AS BIGINT) AS n_linked,
       regexp_replace(list_aggregate(list_concat([''], list_filter(string_split(coalesce(r.text, ''), chr(10)),
           lambda x: NOT regexp_matches(x, {_MARKS})
                     AND NOT regexp_matches(x, '{quote_threads.ATTRIBUTION}'))), 'string_agg', chr(10))[2:],
           '^(?:[\\x20\\x09-\\x0D]*\\n)+|[\\x20\\x09-\\x0D]+$', '', 'g') AS body,
       CASE WHEN r.conv_id IS NOT NULL THEN coalesce(p.parent, max(r.turn) OVER (
           PARTITION BY r.conv_id ORDER BY r.turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) END AS follows_turn,
       CAST(row_number() OVER (PARTITION BY r.conv_id ORDER BY r.turn NULLS FIRST, r.role NULLS FIRST, r.text NULLS FIRST) - 1
            AS BIGINT) AS place
FROM rows r
LEFT JOIN parents p ON r.conv_id = p.conv_id AND r.turn = p.turn
JOIN walk w ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.turn IS NOT DISTINCT FROM r.turn
LEFT JOIN (SELECT conv_id, turn, count(*) AS n FROM read WHERE level > 0 AND passage <> '' GROUP BY ALL) q
  ON q.conv_id = r.conv_id AND q.turn = r.turn"""


@query("op9_chat_formatting", OP9_SQL)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return quote_threads.link_quotes(messages).select("conv_id", "turn", "role", "thread.*")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
