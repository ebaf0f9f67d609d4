"""A training corpus from the documents table: five stages, each written and read again.

Every function takes (spark, docs, sf_dir) and returns the documents it keeps with all their
columns; the last one returns the packed pieces. ``run`` gives every row a key of its own first,
by which the stages decide what goes, so rows without doc_id or with a repeated one are judged one
by one. A stage called on documents without that key decides by doc_id; an id then goes only if
all of its rows are to go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starboard.llm import exact_dedup, language_id, minhash, mixing, packing
from starboard.llm.common import small, table, without_ids
from starboard.llm.queries import vocabulary
from starboard.session import stage


ROW = "_row"


def with_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with the key ``ROW``: the doc_id where it is given and not repeated, and a number
    above all of them elsewhere. Only then is the table written, to fix these numbers."""
    docs = docs.withColumn(ROW, F.col("doc_id").cast("long"))
    repeated = stage(docs.groupBy(ROW).count().where(f"count > 1 or {ROW} is null").select(
        F.col(ROW).alias("_repeated"), F.lit(True).alias("_new")), "repeated")
    if not repeated.take(1):
        return docs
    above = (docs.agg(F.max(ROW)).first()[0] or 0) + 1
    marked = docs.join(small(repeated), F.col(ROW).eqNullSafe(F.col("_repeated")), "left")
    return stage(marked.withColumn(ROW, F.when(
        F.col("_new"), F.lit(above) + F.monotonically_increasing_id()).otherwise(F.col(ROW)))
        .drop("_repeated", "_new"), "rows")


def _judged(docs: DataFrame) -> DataFrame:
    """``docs`` with the key in place of doc_id, as the operators are to see it."""
    return docs.withColumn("doc_id", F.col(ROW)).drop(ROW) if ROW in docs.columns else docs


def _without(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """``docs`` without the keys that ``decided`` (doc_id, kept) keeps no row of."""
    ids = decided.groupBy("doc_id").agg(F.bool_or("kept").alias("any")).where("not any")
    return without_ids(docs, ids.select("doc_id"), ROW if ROW in docs.columns else "doc_id")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told; texts without a letter go.

    Where ``lang`` is null the language told takes its place, for the stages that go by it.
    """
    judged = _judged(docs)
    key = ROW if ROW in docs.columns else "doc_id"
    found = stage(language_id.identify(judged, language_id.fit(judged)).select(
        "doc_id", "lang_pred"), "languages")
    known = _without(docs, found.select(
        "doc_id", (F.col("lang_pred") != language_id.UNKNOWN).alias("kept")))
    # An id of several rows without a language has one only if all of them are told the same.
    unnamed = judged.where("lang is null").select("doc_id").distinct()
    told = stage(found.join(small(unnamed), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min("lang_pred").alias("_told"), F.max("lang_pred").alias("_other")).where(
        F.col("_told") == F.col("_other")).select(F.col("doc_id").alias("_id"), "_told"), "told")
    named = known.join(small(told), (known[key] == F.col("_id")) & F.col("lang").isNull(), "left")
    return named.withColumn("lang", F.coalesce("lang", "_told")).drop("_id", "_told")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return _without(docs, exact_dedup.exact_duplicates(_judged(docs)))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return _without(docs, minhash.near_duplicates(_judged(docs)))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target shares."""
    return _without(docs, mixing.mix(_judged(docs), mixing.EVERY_LANGUAGE))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", distinct_texts),
    ("near_dedup", no_near_duplicates),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# Language models, rolling hashes and packing plans are beyond SQL; tests/llm holds what the four
# stages keep and what is packed against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_rows(table(spark, sf_dir, "documents"))
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
