"""Column helpers and Arrow settings shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters that separate words: space and U+0009 to U+000D.
WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"
#: Largest Arrow batch handed to a Python worker, in bytes; a longer text comes alone.
BATCH_BYTES = 2 << 20

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(spark, sf_dir)`` under ``name`` with the SQL that must give the same rows."""

    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_sized(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes, so that a worker's memory does not follow the text lengths."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def crc_mod(key: str, m: int) -> Column:
    """crc32 of the decimal text of ``key``, modulo ``m``; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % m


def drawn(rows: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of each value of ``label``, those of least hash of the doc_id.

    A count per label first gives a hash bound that leaves about twice as many rows, so only those are ranked.
    """
    kept = rows.columns
    # one number per label: the labels of a classifier fit on the driver, as its weights do
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect() if r[0] is not None}
    if not sizes:
        return rows.filter(F.lit(False))
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    share = F.shiftrightunsigned(F.xxhash64("doc_id"), 1).cast("double") / float(1 << 63)
    rows = rows.withColumn("_share", share).filter(F.col("_share") * F.element_at(size, F.col(label)) <= 2 * limit + 50)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_share", *kept))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= limit).select(*kept)


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for a null text."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x")
    return F.length(F.translate(marks, " \t\n\x0b\f\r", "")).cast("long")


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``docs``."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def keyed(docs: DataFrame, name: str = "_key") -> DataFrame:
    """``docs`` with a hash of doc_id and text; equal rows share it."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))
    return docs.withColumn(name, F.xxhash64(named, F.coalesce("text", F.lit(""))))


def discard(stored: DataFrame) -> None:
    """Delete the files of a frame that ``materialize`` wrote, once everything read from it is written itself."""
    spark = stored.sparkSession
    jvm = spark.sparkContext._jvm
    for file in stored.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
