"""Quality rules with the frequency of lines across documents, in DataFrame functions only.

Lines are normalised (A-Z folded, digits as 0, runs of spaces as one), hashed and counted per host: the number of
distinct documents that hold them. Lines of more than ``MAX_SHARE`` of a host's documents (those with a line that has a word), and of more than
``MAX_DOCS``, are removed, and a document that keeps less than ``MIN_LEFT`` of its words is rejected, like one that fails the base rules.

Nulls: a null text has no words and fails the base rules; a null host is a host of its own; a null doc_id stays.
Empty texts read like null ones. Equal rows count as one document. An empty table gives an empty result. Only
``doc_id``, ``text`` and the host column are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import query, table, words
from ledgerloom.session import materialize

#: A line of more than this share of a host's documents is boilerplate, if they are more than ``MAX_DOCS``.
MAX_SHARE, MAX_DOCS = 0.05, 10
#: Least share of words that must be left.
MIN_LEFT = 0.3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """The form of each line under which it is counted, as an array; empty for a line without a word."""
    folded = F.translate(text, _UPPER + "123456789", _LOWER + "000000000")
    even = F.regexp_replace(folded, "[\\x20\\x09\\x0B-\\x0D]+", " ")
    return F.split(F.regexp_replace(even, " ?\\n ?|^ | $", "\n"), "\n", -1)


def _repeated_words(rows: DataFrame) -> DataFrame:
    """Add n_repeat_words: words inside 3-word windows that occur twice or more among ``_words``.

    Windows become hashes. Where two are equal, (hash, place) pairs are sorted; places whose hash also
    stands beside them are repeats, and each covers the words up to the next repeat, three at most.
    """
    size = F.size("_words")
    part = lambda k: F.slice("_words", F.lit(k), size - 2)
    grams = F.transform(F.arrays_zip(part(1), part(2), part(3)), lambda w: F.xxhash64(w))
    rows = rows.withColumn("_grams", F.when(size >= 3, grams))
    repeats = F.size("_grams") > F.size(F.array_distinct("_grams"))
    placed = F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    rows = rows.withColumn("_placed", F.when(repeats, placed)).drop("_grams")
    beside = lambda x, i: F.coalesce(F.get(F.col("_placed"), i)["g"] == x["g"], F.lit(False))
    twice = F.filter("_placed", lambda x, i: beside(x, i + 1) | ((i > 0) & beside(x, i - 1)))
    rows = rows.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("_placed")
    after = lambda i: F.coalesce(F.get(F.col("_at"), i + 1), F.lit(2**31 - 1))
    reach = F.transform("_at", lambda p, i: F.least(F.lit(3), after(i) - p))
    total = F.aggregate(reach, F.lit(0), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("_at")


def with_rules(
    docs: DataFrame,
    host: str = "source",
    max_docs: int = MAX_DOCS,
    min_left: float = MIN_LEFT,
    max_share: float = MAX_SHARE,
) -> DataFrame:
    """Per row of ``docs``: doc_id, text, base counts, base_failed, kept, n_words_left, ``bad_lines``.

    ``bad_lines`` holds the hashes of the lines to remove (see ``without_lines``).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("?")), F.md5(text), F.col(host))
    rows = docs.select("doc_id", "text", F.col(host).alias("_host"), key.alias("_key"))
    # lines that differ only in case, digits or spaces are one line here, but not in n_dup_lines
    lines = F.array_remove(normalised(text), "")
    forms = rows.select("_host", "_key", lines.alias("_lines"))
    spaces = F.length("_line") - F.length(F.replace("_line", F.lit(" "), F.lit("")))
    placed = forms.select("_host", "_key", F.posexplode("_lines").alias("_at", "_line"))
    # written once, as hashes: the counts and the lines to remove both read it
    placed = materialize(
        placed.select("_host", "_key", "_at", F.xxhash64("_line").alias("_h"), (spaces + 1).alias("_w")), "lines"
    )
    held = placed.select("_host", "_h", "_key")
    counted = held.distinct().groupBy("_host", "_h").agg(F.count(F.lit(1)).alias("_docs"))
    # each document has one first line
    hosts = placed.filter("_at = 0").select("_host", "_key").distinct().groupBy(F.col("_host").alias("_n_host"))
    hosts = hosts.agg(F.greatest(F.lit(float(max_docs)), max_share * F.count(F.lit(1))).alias("_limit"))
    counted = counted.join(hosts, F.col("_host").eqNullSafe(F.col("_n_host")))
    common = counted.filter(F.col("_docs") > F.col("_limit"))
    # written first: the rows of a very common line can then be split in the join
    common = materialize(common.select(F.col("_host").alias("_c_host"), F.col("_h").alias("_c_h")), "common")
    met = placed["_host"].eqNullSafe(common["_c_host"]) & (placed["_h"] == common["_c_h"])
    gone = (
        placed.join(common, met)
        .groupBy("_key", "_at", "_h", "_w")
        .agg(F.lit(1).alias("_one"))
        .groupBy(F.col("_key").alias("_g_key"))
        .agg(F.sum("_w").alias("_gone"), F.collect_set("_h").alias("bad_lines"))
    )
    raw = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    marks = F.regexp_replace(text, f"[^{SYMBOLS}]+", "")
    base = rows.select(
        "doc_id",
        "text",
        "_key",
        words(F.col("text")).alias("_words"),
        (F.size(raw) - F.size(F.array_distinct(raw))).cast("long").alias("n_dup_lines"),
        F.length(marks).cast("long").alias("n_symbols"),
    )
    base = _repeated_words(base).select(
        "doc_id",
        "text",
        "_key",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce(F.col("_gone"), F.lit(0))
    return (
        base.join(gone, base["_key"] == gone["_g_key"], "left")
        .withColumns({"base_failed": failed, "n_words_left": left})
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words_left") >= min_left * F.col("n_words")))
        .drop("_key", "_g_key", "_gone")
    )


def without_lines(text: Column, bad_lines: Column) -> Column:
    """``text`` without the lines whose normalised hash is in ``bad_lines``."""
    form = lambda x: F.get(F.array_remove(normalised(x), ""), F.lit(0))
    keep = lambda x: ~F.array_contains(bad_lines, F.xxhash64(form(x)))
    return F.when(bad_lines.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n", -1), keep), "\n"))


@query(
    "op6_quality_rules",
    """
    WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents),
    w AS (SELECT k, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
    g AS (SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
      FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
    p AS (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS n FROM g),
    v AS (SELECT k, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT k, unnest([i, i + 1, i + 2]) AS place FROM p WHERE n > 1) GROUP BY k),
    l AS (SELECT k, source, unnest(string_split(text, chr(10))) AS line FROM d),
    s AS (SELECT k, source, line, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n,
        regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
          'abcdefghijklmnopqrstuvwxyz000000000'), '[\\x20\\x09-\\x0D]+', ' ', 'g'), '^ | $', '', 'g') AS form FROM l),
    u AS (SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines FROM s WHERE n > 0 GROUP BY k),
    h AS (SELECT source, greatest(10, 0.05 * count(DISTINCT k)) AS most FROM s WHERE n > 0 GROUP BY source),
    c AS (SELECT t.source, form FROM (SELECT source, form, count(DISTINCT k) AS n_docs FROM s WHERE n > 0 GROUP BY source, form) t
      JOIN h ON t.source IS NOT DISTINCT FROM h.source WHERE n_docs > most),
    x AS (SELECT s.k, sum(s.n) AS gone FROM s JOIN c ON s.source IS NOT DISTINCT FROM c.source AND s.form = c.form
      GROUP BY s.k),
    b AS (SELECT d.doc_id, CAST(len(w.words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w.words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(u.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(v.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(x.gone, 0) AS gone
      FROM d JOIN w USING (k) LEFT JOIN v USING (k) LEFT JOIN u USING (k) LEFT JOIN x USING (k)),
    f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND n_words - gone >= 0.3 * n_words AS kept
    FROM f
    """,
)
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_rules(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.drop("text", "bad_lines", "n_words_left")
