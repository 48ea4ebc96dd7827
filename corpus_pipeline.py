"""From raw documents to a training order: the stages, each reading what the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``. A row is
a document; only doc_id, text, source and lang are read, and n_chars is set anew where a text changes.

Nulls: a null or empty text, or one without a letter, goes in the first stage; a null lang is not learned from, a null source is a source of
its own, a null doc_id stays (and stands behind others where one of a class is kept). Very long texts are worked in slices and windows; no stage
has a limit of length. Ties: of equal or near-equal documents the least doc_id stays, of equal rows one. Repeated rows so go in the second stage; the
mix then repeats rows on purpose, one per copy. Empty tables pass all stages and give an empty result; without benchmark items nothing is leaked.
Columns of other names are carried along; ``position`` is set by the last stage, replacing one of that name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination, langid, mixing, neardup, suffixes
from ledgerloom.llm.common import table
from ledgerloom.session import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with text in a language that the classifier recognises."""
    found = langid.identify(docs)
    kept = found.filter((F.col("lang_pred") != "und") & (F.col("score") >= langid.LEAST_SHARE))
    return kept.select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without long byte strings that occur elsewhere; n_chars follows the text."""
    cleaned = suffixes.remove_repeats(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_tests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_tests(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per copy of a document, in training order."""
    return mixing.training_order(docs)


STAGES = [
    ("language_id", known_language),
    ("minhash_neardup", one_of_each),
    ("suffix_dedup", without_repeats),
    ("decontamination", without_tests),
    ("mixing", training_order),
]
#: Near-duplicate classes and learned languages have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
