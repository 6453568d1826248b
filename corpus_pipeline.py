"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept. Its result is written as Parquet and read again as the next one's
``docs``, so a lost executor costs one stage at most. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardlake.llm import near_dedup, packing, pii, quality_model, quality_rules
from wardlake.llm.columns import free_name
from wardlake.session import write_through

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents need this probability of the best grade.
KEEP_AT = 0.5
SURROGATE_KEY = "surrogates of the pipeline"
SEQUENCE_TOKENS, END_ID = 2048, 1
#: The workers serve all stages, so packing has a small table of words and drops it with its task.
MOST_UNITS = 150_000


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the strict policy; null and empty texts go."""
    return quality_rules.keep(docs, quality_rules.STRICT)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely of the best grade. The model learns from the rated rows of the raw table."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ratings = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.fit(raw, ratings, quality_model.grade_of_labels(), 3)
    prefix = free_name(docs, "__tail_probability").removesuffix("tail_probability")
    scored = quality_model.predict(docs, model, tail=2, prefix=prefix)
    return scored.where(F.col(f"{prefix}tail_probability") >= KEEP_AT).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id.

    Texts without words and rows without an id are in no group and stay. Rows that
    share an id are documents of their own: where ids repeat, documents are linked
    by a row number, which is written once.
    """
    named, nameless = docs.where("doc_id is not null"), docs.where("doc_id is null")
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        ids = write_through(near_dedup.near_duplicates(named).where("kept").select("doc_id"), "kept")
        return near_dedup.only_ids(named, ids, "doc_id").select(*docs.columns).unionByName(nameless)
    row = free_name(docs, "__row")
    keyed = write_through(named.withColumn(row, F.monotonically_increasing_id()), "keyed")
    found = near_dedup.near_duplicates(keyed, row).select(F.col(row), F.col("component_id").alias("__component"))
    least = found.join(keyed.select(row, F.col("doc_id").alias("__id")), row).groupBy("__component").agg(
        F.min_by(row, F.struct("__id", row)).alias(row))
    ids = write_through(least.select(row), "kept")
    return near_dedup.only_ids(keyed, ids, row).select(*docs.columns).unionByName(nameless)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and the number of characters brought up to date."""
    out = pii.replace_personal(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return out.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids and their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS, END_ID, with_ids=True,
                        most_units=MOST_UNITS, keep_words=False)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rule_stage),
    ("quality classifier", classifier_stage),
    ("near-duplicates", near_dedup_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]

#: No stage but the first can be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
