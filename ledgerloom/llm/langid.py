"""Language identification by a byte convolutional network over whole texts.

The network (``convnet``) learns from ``DRAWN`` windows, drawn over the whole text, of each of at most ``PER_LANG`` texts of each language, chosen by a
hash of the doc_id. A text is cut into windows of ``LENGTH`` bytes that cover all of it; its shares are the mean of its windows'
class shares, weighted by their bytes.

Nulls: a null text, or one without a letter, is ``und`` with score 0; rows with a null lang or doc_id are predicted but
not learned from. Without any labelled text all rows are ``und``. Equal texts get equal results; ties go to the first
language in code-point order. An empty table gives an empty result. Columns named lang_pred or score are replaced.
More than ``MOST_LANGS`` values of lang are refused: such a column does not hold languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerloom.llm import convnet
from ledgerloom.llm.bytesops import packed
from ledgerloom.llm.common import arrow_sized, crc_mod, drawn, query, table

LENGTH = 256
#: Texts of each language that training reads at most, windows of each, and languages at most.
PER_LANG, DRAWN, MOST_LANGS = 1000, 2, 500
#: Rows whose hash leaves this remainder are held out.
FOLDS, HELD_OUT = 5, 0
WIDTHS, FILTERS = (2, 4, 6), 12
#: The pipeline keeps a document if its language has at least this share. Of 51,282 documents of a table of 0.1 GB, 50 lie below it (1012 below
#: 0.7, prose among them). It rejects a quarter of hexadecimal junk and a tenth of other junk at most: the network is sure of most texts.
LEAST_SHARE = 0.5


def drawn_windows(text: Column, key: str, length: int, windows: int) -> Column:
    """Windows of ``length`` bytes of a text, one in each of ``windows`` equal stretches of it, at a place by a hash of ``key``.

    A text of fewer bytes than so many windows gives as many as cover it.
    """
    raw = text.cast("binary")
    last = F.greatest(F.length(raw) - length, F.lit(0))
    n = F.least(F.lit(windows), F.floor(last / length) + 1).cast("int")

    def window(k: Column) -> Column:
        share = F.shiftrightunsigned(F.xxhash64(key, k), 1).cast("double") / float(1 << 63)
        return F.substring(raw, F.floor(last * (k + share) / n).cast("int") + 1, F.lit(length))

    return F.transform(F.sequence(F.lit(0), n - 1), window)


def sampled(rows: DataFrame, label: str, limit: int, length: int, windows: int) -> DataFrame:
    """Windows of at most ``limit`` rows of each ``label``: (label, piece)."""
    few = drawn(rows.select("doc_id", label, "text"), label, limit)
    return few.select(F.col(label).alias("label"), F.explode(drawn_windows(F.col("text"), "doc_id", length, windows)).alias("piece"))


def learn(docs: DataFrame, per_lang: int = PER_LANG) -> tuple[convnet.Net | None, list[str]]:
    """The network and its languages; at most ``per_lang * DRAWN * LENGTH`` bytes of each language reach the driver."""
    known = docs.filter(
        F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}") & (crc_mod("doc_id", FOLDS) != HELD_OUT)
    )
    if known.select("lang").distinct().limit(MOST_LANGS + 1).count() > MOST_LANGS:
        raise ValueError(f"lang has more than {MOST_LANGS} values")
    rows = sampled(known, "lang", per_lang, LENGTH, DRAWN).orderBy("label", "piece").collect()
    langs = sorted({r.label for r in rows})
    if not langs:
        return None, []
    place = {lang: k for k, lang in enumerate(langs)}
    x, y = convnet.pieces([bytes(r.piece) for r in rows], [place[r.label] for r in rows], len(langs), LENGTH)
    return convnet.train(x, y, WIDTHS, FILTERS, epochs=8, steps=1000), langs


def with_language(docs: DataFrame, net: convnet.Net | None, langs: list[str]) -> DataFrame:
    """``docs`` with lang_pred and score."""
    arrow_sized(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "_letter")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("_letter"))
    schema = StructType(
        [*rows.drop("_letter").schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = convnet.Scorer(net) if net is not None else None
        for batch in batches:
            buf, offsets = packed(batch.column("text"))
            n = len(batch)
            letter = batch.column("_letter").to_numpy(zero_copy_only=False) & (scorer is not None)
            names, score = np.full(n, "und", object), np.zeros(n)
            if letter.any():
                text, start, used = convnet.cut(buf, offsets, LENGTH, LENGTH)
                wide = letter[text]
                text, start, used = text[wide], start[wide], used[wide]
                parts = [
                    scorer.shares(convnet.gather(buf, start[a : a + 4096], used[a : a + 4096], LENGTH))
                    for a in range(0, len(start), 4096)
                ]
                shares = convnet.averaged(np.concatenate(parts).astype(np.float64), text, used, n)
                best = shares.argmax(axis=1)
                names[letter] = np.array(langs, object)[best[letter]]
                score[letter] = np.minimum(shares[np.arange(n), best][letter], 1.0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(names, pa.string()), pa.array(score)],
                names=[*kept, "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, training: DataFrame | None = None) -> DataFrame:
    """``docs`` with lang_pred and score, learned from ``training`` (by default ``docs`` itself)."""
    return with_language(docs, *learn(docs if training is None else training))


@query("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = identify(docs.select("doc_id", "text"), docs)
    held = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "lang_pred", "score")
