"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits with A-Z folded. Shared seeds of ``SEED`` tokens are joined between documents and
test items; the running hashes of neighbouring seeds on one diagonal give all longest common matches of a document and an
item. The longest match is marked, what it overlaps is cut to the unmarked rest, and so on while a match of ``SEED`` tokens
is left. Tiles may lie in any order, so a reordered passage is covered like a plain one. A document is contaminated if tiles cover
``COVER`` of the tokens of an item. An item of fewer than ``SEED`` tokens is one seed: it matches as a whole or not at all.

Before the join, documents drop the seeds that are in no item by a bitmap of fixed size; a pair of document and item is tiled
only if it shares as many seeds as the coverage needs at least. A pair is one row with the seeds' places on either side, so its size is that of
its texts; the equal places are paired inside the task, some at a time, and kept as runs on diagonals.

Nulls: null and empty texts match nothing, nor do items without a token; a null doc_id or item_id stays. Equal rows
get equal results. Empty tables give no matches. Of several items with equal coverage the least id is named. Only doc_id, item_id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import PUNCTUATION, packed, windows, word_hashes, word_spans
from ledgerloom.llm.common import arrow_sized, keyed, query, table, unused
from ledgerloom.session import materialize

#: Shortest match, in tokens.
SEED = 5
#: Share of an item's tokens that makes a document contaminated.
COVER = 0.5
#: Bits of the bitmap of all items' seeds; its size does not depend on the number of items.
BITS = 1 << 24
#: Pairs of equal places that are formed at a time.
AT_ONCE = 1 << 21


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes, and each row's first token (one more at the end)."""
    buf, offsets = packed(batch.column("text"))
    starts, ends, first = word_spans(buf, offsets, PUNCTUATION)
    return word_hashes(buf, starts, ends, lower=True), first


def _item_rows(seed: int):
    """The seeds of each item: all runs of ``seed`` tokens, or a shorter item as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = _words(batch)
            tokens = np.diff(first)
            found = [windows(hashes, first, seed)]
            for size in range(1, seed):
                grams, row, at = windows(hashes, first, size)
                whole = tokens[row] == size
                found.append((grams[whole], row[whole], at[whole]))
            grams, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
            row = row.astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id").take(pa.array(row)),
                    batch.column("item_key").take(pa.array(row)),
                    pa.array(tokens[row].astype(np.int64)),
                    pa.array((at - first[row]).astype(np.int32)),
                    pa.array(grams.view(np.int64)),
                ],
                names=["item_id", "item_key", "tokens", "i", "gram"],
            )

    return run


def _hit_rows(sizes: list[int], bitmap: Broadcast):
    """The runs of tokens that an item may have; ``sizes`` are the seed and the lengths of shorter items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            hashes, first = _words(batch)
            for size in sizes:
                grams, row, at = windows(hashes, first, size)
                grams = grams.view(np.int64)
                slot = grams & (len(bits) * 8 - 1)
                hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                take = pa.array(row[hit])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        batch.column("_key").take(take),
                        pa.array((at - first[row])[hit].astype(np.int32)),
                        pa.array(grams[hit]),
                    ],
                    names=["doc_id", "key", "j", "gram"],
                )

    return run


def _bitmap(grams: DataFrame, bits: int) -> bytes:
    """The seeds present, as one bit each by their low bits: at most ``bits / 64`` numbers reach the driver."""
    slot = F.col("gram").bitwiseAND(F.lit(bits - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = grams.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(bits // 64, np.int64)
    found = words.toArrow()
    out[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return out.tobytes()


def diagonal_runs(
    item_at: np.ndarray, item_gram: np.ndarray, doc_at: np.ndarray, doc_gram: np.ndarray, seed: int, at_once: int = AT_ONCE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The longest common matches of an item and a document: (item place, document place, length) from equal seeds.

    The document's seeds are taken in the order of their places, a bounded number of pairs at a time; a run that goes on in the next
    part is put together at the end.
    """
    order = np.argsort(item_gram, kind="stable")
    item_at, item_gram = item_at[order].astype(np.int64), item_gram[order]
    order = np.argsort(doc_at, kind="stable")
    doc_at, doc_gram = doc_at[order].astype(np.int64), doc_gram[order]
    low, high = np.searchsorted(item_gram, doc_gram), np.searchsorted(item_gram, doc_gram, "right")
    upto = np.concatenate([[0], np.cumsum(high - low)])
    runs, a = [], 0
    while a < len(doc_at):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + at_once, "right")) - 1)
        n = high[a:b] - low[a:b]
        i = item_at[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - low[a:b], n)]
        j = np.repeat(doc_at[a:b], n)
        runs.append(_joined_runs(i, j, np.ones(len(i), np.int64)))
        a = b
    if not runs:
        return (np.empty(0, np.int64),) * 3
    i, j, size = _joined_runs(*(np.concatenate(x) for x in zip(*runs, strict=True)))
    return i, j, size + seed - 1


def _joined_runs(i: np.ndarray, j: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of seeds that follow each other on one diagonal, put together."""
    order = np.lexsort((i, j - i))
    i, j, size = i[order], j[order], size[order]
    new = np.ones(len(i), bool)
    new[1:] = (np.diff(j - i) != 0) | (i[1:] != i[:-1] + size[:-1])
    at = np.flatnonzero(new)
    return i[at], j[at], np.add.reduceat(size, at) if len(at) else size


def tiles(i: np.ndarray, j: np.ndarray, length: np.ndarray, seed: int, tokens: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from the longest common matches of item and document: (item place, document place, length).

    The longest match is marked and what overlaps it cut to the unmarked rest, until the item has no ``seed`` unmarked tokens in a row.
    Ties go to the earlier place in the item, then in the document.
    """
    queue = list(zip((-length).tolist(), i.tolist(), j.tolist(), strict=True))
    heapq.heapify(queue)
    item, doc, out = np.zeros(tokens, bool), set(), []
    while queue:
        size, a, b = heapq.heappop(queue)
        taken = item[a : a - size]
        if taken.all():
            continue
        free = [k for k in np.flatnonzero(~taken).tolist() if b + k not in doc]
        if len(free) == -size:
            item[a : a - size] = True
            doc.update(range(b, b - size))
            out.append((a, b, -size))
            if _longest_gap(item) < seed:
                break
            continue
        start = 0
        for x in range(1, len(free) + 1):
            if x == len(free) or free[x] != free[x - 1] + 1:
                if x - start >= seed:
                    heapq.heappush(queue, (start - x, a + free[start], b + free[start]))
                start = x
    return out


def _longest_gap(marked: np.ndarray) -> int:
    edges = np.flatnonzero(np.concatenate([[True], marked, [True]]))
    return int(np.diff(edges).max()) - 1


def _tiled_rows(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered = []
            for row in range(len(batch)):
                doc, item = (batch.column(n)[row].values for n in ("places", "seeds"))
                (doc_at, doc_gram), (item_at, item_gram) = ([x.to_numpy() for x in y.flatten()] for y in (doc, item))
                tokens = batch.column("tokens")[row].as_py()
                least = min(seed, tokens)
                found = diagonal_runs(item_at, item_gram, doc_at, doc_gram, least)
                covered.append(sum(n for _, _, n in tiles(*found, least, tokens)))
            names = ["doc_id", "key", "item_id", "tokens"]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(covered, pa.int64())], names=[*names, "covered"])

    return run


def item_coverage(docs: DataFrame, items: DataFrame, seed: int = SEED, cover: float = COVER) -> DataFrame:
    """One row per document and item whose shared seeds could reach ``cover``: doc_id, key, item_id, coverage."""
    spark = docs.sparkSession
    arrow_sized(spark)
    texts = keyed(docs.select("doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), "_key", "text")
    tests = items.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("?")), "text").alias("item_key"),
        "text",
    )
    schema = "item_id long, item_key long, tokens long, i int, gram long"
    grams = materialize(tests.mapInArrow(_item_rows(seed), schema).distinct(), "item-seeds")
    bitmap = spark.sparkContext.broadcast(_bitmap(grams, BITS))
    # at most ``seed`` numbers
    short = [r.tokens for r in grams.filter(F.col("tokens") < seed).select("tokens").distinct().collect()]
    hits = texts.mapInArrow(_hit_rows([*sorted(short), seed], bitmap), "doc_id long, key long, j int, gram long")
    hits = materialize(hits, "seed-hits")
    # a document that reaches the coverage shares at least this many of the item's seeds
    pair = ["doc_id", "key", "item_id", "item_key", "tokens"]
    held = grams.groupBy("item_id", "item_key", "tokens", "gram").agg(F.count(F.lit(1)).alias("times"))
    held = materialize(held, "item-grams")
    shared = hits.select("doc_id", "key", "gram").distinct().join(held, "gram")
    shared = shared.groupBy(*pair).agg(F.sum("times").alias("n")).filter(F.col("n") * seed >= cover * F.col("tokens"))
    shared = shared.select(F.col("key").alias("_k"), F.col("item_key").alias("_i"), F.col("doc_id").alias("_d"))
    met = hits.join(held.drop("times"), "gram")
    met = met.join(
        materialize(shared, "shared"),
        (met["key"] == F.col("_k")) & (met["item_key"] == F.col("_i")) & met["doc_id"].eqNullSafe(F.col("_d")),
        "left_semi",
    )
    pairs = met.groupBy(*pair).agg(F.collect_set(F.struct("j", "gram")).alias("places"))
    seeds = grams.groupBy(F.col("item_key").alias("_i_key"), F.col("item_id").alias("_i_id"))
    seeds = materialize(seeds.agg(F.collect_set(F.struct("i", "gram")).alias("seeds")), "item-places")
    same = (pairs["item_key"] == seeds["_i_key"]) & pairs["item_id"].eqNullSafe(seeds["_i_id"])
    pairs = pairs.join(seeds, same).drop("_i_key", "_i_id")
    done = pairs.mapInArrow(_tiled_rows(seed), "doc_id long, key long, item_id long, tokens long, covered long")
    return done.select("doc_id", "key", "item_id", (F.col("covered") / F.col("tokens")).alias("coverage"))


def with_matches(docs: DataFrame, items: DataFrame, seed: int = SEED, cover: float = COVER) -> DataFrame:
    """Every row of ``docs`` with coverage, item_id, n_items and contaminated (replacing columns of these names)."""
    found = item_coverage(docs, items, seed, cover)
    best = found.groupBy(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).agg(
        F.max("coverage").alias("_coverage"),
        F.min(F.struct((-F.col("coverage")).alias("c"), "item_id"))["item_id"].alias("_item"),
        F.count_if(F.col("coverage") >= cover).alias("_n"),
    )
    name = unused(docs, "_key")
    rows = keyed(docs, name)
    met = rows["doc_id"].eqNullSafe(best["_d"]) & (rows[name] == best["_k"])
    added = {
        "coverage": F.coalesce("_coverage", F.lit(0.0)),
        "item_id": F.when(F.col("_n") > 0, F.col("_item")),
        "n_items": F.coalesce("_n", F.lit(0)).cast("long"),
        "contaminated": F.coalesce(F.col("_n") > 0, F.lit(False)),
    }
    kept = [rows[f"`{c}`"] for c in docs.columns if c not in added]
    return rows.join(best, met, "left").select(*kept, *[c.alias(n) for n, c in added.items()])


def without_tests(docs: DataFrame, items: DataFrame, seed: int = SEED, cover: float = COVER) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    found = item_coverage(docs, items, seed, cover).filter(F.col("coverage") >= cover)
    gone = found.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k")).distinct()
    name = unused(docs, "_key")
    rows = keyed(docs, name)
    met = rows["doc_id"].eqNullSafe(gone["_d"]) & (rows[name] == gone["_k"])
    return rows.join(gone, met, "left_anti").select(*[rows[f"`{c}`"] for c in docs.columns])


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = with_matches(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return rows.drop("text")
