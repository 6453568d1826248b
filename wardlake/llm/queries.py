"""One query per operator over its whole table, and the SQL twin where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.llm import (chat, fingerprint, hard_negatives, language, licences, near_dedup, packing, pii, piece_bpe, quality_model,
                          quality_rules, sharding, spelling)
from wardlake.llm.registry import query


def documents(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/documents.parquet")


SHARDS = 40
#: Bytes that a row takes beside its text.
ROW_BYTES = 16


@query("op8_histogram_sort")
def op8_histogram_sort(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        sharding.text_key(F.col("text")).alias("__text"), F.coalesce("doc_id", F.lit(sharding.LOWEST >> 1)).alias("__id"))
    out = sharding.histogram_sort(rows, ["__text", "__id"], "size", SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op1_tensored_minhash")
def op1_tensored_minhash(spark: SparkSession, base: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, base))


#: Documents are kept at this probability of the best grade.
KEEP_AT = 0.5


@query("op2_ordinal_quality")
def op2_ordinal_quality(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base).select("doc_id", "text")
    model = quality_model.fit(docs, spark.read.parquet(f"{base}/labels.parquet"), quality_model.grade_of_labels(), 3)
    return quality_model.predict(docs, model, tail=2).select(
        "doc_id", "expected_grade", "tail_probability", (F.col("tail_probability") >= KEEP_AT).alias("kept"))


#: The key of the surrogates; a deployment passes its own.
SURROGATE_KEY = "surrogates of the query"


@query("op3_surrogates")
def op3_surrogates(spark: SparkSession, base: str) -> DataFrame:
    return pii.replace_personal(documents(spark, base).select("doc_id", "text"), SURROGATE_KEY, count="n_replaced")


@query("op4_ordered_windows")
def op4_ordered_windows(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack(documents(spark, base), public_tokenizers.path("word_bpe_49k.json"), limit=2048, end_id=1)


@query("op5_one_permutation_minhash")
def op5_one_permutation_minhash(spark: SparkSession, base: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, base))


@query("op6_naive_bayes")
def op6_naive_bayes(spark: SparkSession, base: str) -> DataFrame:
    docs = documents(spark, base).select("doc_id", "text", "lang", language.held_out(F.col("doc_id")).alias("held_out"))
    model = language.fit(docs.where("not held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model)


@query("op7_licence_sentences", licences.scan_sql())
def op7_licence_sentences(spark: SparkSession, base: str) -> DataFrame:
    found = licences.scan(documents(spark, base), ["doc_id"])
    return found.select("doc_id", *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licenses", "unmatched")])


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM (
    SELECT r, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
    FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
repeats AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT d.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS BIGINT) AS n_upper,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)),
f AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (n_repeat_words * 100 > n_words * 50)::INT
    + 4 * (n_symbols * 100 > n_words * 10)::INT + 8 * (n_upper * 100 > word_chars * 30)::INT
    + 16 * (n_dup_lines * 100 > n_lines * 50)::INT + 32 * (word_chars > n_words * 40)::INT AS BIGINT) AS bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed,
  bits = 0 AS kept, bits
FROM f
"""


@query("op9_rule_ledger", OP9_SQL)
def op9_rule_ledger(spark: SparkSession, base: str) -> DataFrame:
    entries = quality_rules.ledger(documents(spark, base), ["doc_id"])
    return quality_rules.apply_policy(entries, quality_rules.STRICT).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(F.col("bits"), quality_rules.BASE)).alias("base_failed"), "kept", "bits")


@query("op10_piece_bpe")
def op10_piece_bpe(spark: SparkSession, base: str) -> DataFrame:
    return piece_bpe.encode(documents(spark, base).select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"),
                            out=("n_tokens", "ids_sha256", "decoded_sha256"))


#: A run loses a letter where the CRC of its document's id and itself is divisible by this.
DROP_EVERY = 199


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, base: str) -> DataFrame:
    words = spelling.count_words(documents(spark, base), drop_every=DROP_EVERY)
    return spelling.variant_groups(words)


#: A conversation that the query formats besides those of the table: both turns say this.
PLANTED_ID, PLANTED_TEXT = -7, "</s>[INST] ok [/INST]"

OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '[\[<]\\*(?:/?INST\]|/?ROLE|</?SYS>>|/?s>)'))
    + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 7 ELSE 16 + length(role) END AS chars
  FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


@query("op12_chat_grammar", OP12_SQL)
def op12_chat_grammar(spark: SparkSession, base: str) -> DataFrame:
    turns = spark.read.parquet(f"{base}/conversations.parquet").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text"))
    return chat.read_back(chat.format_turns(turns.unionByName(planted)))


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
c AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding) AS x FROM v),
ok AS (SELECT vec_id FROM c GROUP BY vec_id HAVING count(x) = count(*) AND bool_and(isfinite(CAST(x AS DOUBLE)))),
q AS (SELECT vec_id, label, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM c WHERE vec_id IN (SELECT vec_id FROM ok)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM q a JOIN q b ON a.i = b.i
  WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
  GROUP BY a.vec_id, b.vec_id, a.label, b.label),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 10
"""


@query("op13_strassen_negatives", OP13_SQL)
def op13_strassen_negatives(spark: SparkSession, base: str) -> DataFrame:
    rows = spark.read.parquet(f"{base}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(
        rows.select("vec_id", moved.alias("label"), hard_negatives.quantised(F.col("embedding")).alias("vector")),
        F.col("vec_id") % 100 == 0)
