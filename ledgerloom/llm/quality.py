"""Quality scores by a byte convolutional network over overlapping chunks of the whole text.

The network (``convnet``) learns from ``DRAWN`` chunks, drawn over the whole text, of each of at most ``PER_LABEL`` labelled documents of each label,
chosen by a hash of the doc_id, both labels in equal number of documents where there are enough. A text is cut into chunks of ``LENGTH`` bytes, a new one every
``STEP`` bytes, which cover all of it; each chunk's pooled filters give its log-odds, and their mean, weighted by the
chunks' bytes, gives the document's probability of label 1.

Nulls: a null or empty text scores 0; rows with a null doc_id are scored but not learned from, null labels are ignored.
Without labels of both kinds every text scores 0.5, but null and empty ones 0. Equal texts get equal scores. Repeated label rows count once
each, and so do equal pieces of one doc_id in training. An empty table gives an empty result. Columns of the documents other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import convnet
from ledgerloom.llm.bytesops import packed
from ledgerloom.llm.common import arrow_sized, crc_mod, drawn, query, table
from ledgerloom.llm.langid import drawn_windows
from ledgerloom.session import materialize

LENGTH, STEP = 256, 224
#: Labelled documents of each label that training reads at most, and chunks of each.
PER_LABEL, DRAWN = 2000, 4
FOLDS, HELD_OUT = 3, 1
WIDTHS, FILTERS = (2, 4, 6), 12


def sample_ids(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` rows (doc_id, label) of each value 0 and 1 of ``label``, by a hash of the doc_id."""
    rows = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    return drawn(rows.select("doc_id", F.col(label).cast("int").alias("label")).distinct(), "label", limit)


def learn(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> convnet.Net | None:
    """The network; at most ``2 * per_label * DRAWN * LENGTH`` bytes reach the driver, or twice as many if doc_ids recur."""
    usable = labels.filter(crc_mod("doc_id", FOLDS) != HELD_OUT)
    # at most 2 * per_label rows: safe to broadcast
    ids = F.broadcast(sample_ids(usable, "quality", per_label))
    met = docs.select("doc_id", "text").filter(F.length("text") > 0).join(ids, "doc_id")
    pieces = drawn_windows(F.col("text"), "doc_id", LENGTH, DRAWN)
    met = met.select("doc_id", "label", pieces.alias("piece")).distinct()
    # texts of one doc_id are drawn one by one, so neither a recurring doc_id nor a label crowds out others
    met = materialize(met.select(F.xxhash64("doc_id", "piece").alias("doc_id"), "label", "piece"), "pieces")
    rows = drawn(met, "label", 2 * per_label).select("label", F.explode("piece").alias("piece"))
    rows = rows.orderBy("label", "piece").collect()
    if len({r.label for r in rows}) < 2:
        return None
    x, y = convnet.pieces([bytes(r.piece) for r in rows], [r.label for r in rows], 2, LENGTH)
    return convnet.train(x, y, WIDTHS, FILTERS, epochs=5, steps=1000)


def with_score(docs: DataFrame, net: convnet.Net | None) -> DataFrame:
    """(doc_id, score) of every row."""
    arrow_sized(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = convnet.Scorer(net) if net is not None else None
        for batch in batches:
            buf, offsets = packed(batch.column("text"))
            n = len(batch)
            score = np.where(np.diff(offsets) > 0, 0.5, 0.0)
            if scorer is not None and len(buf):
                text, start, used = convnet.cut(buf, offsets, LENGTH, STEP)
                parts = [
                    scorer.shares(convnet.gather(buf, start[a : a + 4096], used[a : a + 4096], LENGTH))
                    for a in range(0, len(start), 4096)
                ]
                good = np.clip(np.concatenate(parts)[:, 1:].astype(np.float64), 1e-4, 1 - 1e-4)
                odds = convnet.averaged(np.log(good / (1 - good)), text, used, n)[:, 0]
                score = np.where(np.diff(offsets) > 0, 1 / (1 + np.exp(-odds)), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, score double")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row of ``docs``, learned from ``labels`` of the rows that are not held out."""
    return with_score(docs, learn(docs, labels))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = score_quality(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
