"""Collocations per language, by best-first branch-and-bound growth of phrases.

Cutting a phrase after its first word, or before its last, shows that its score is at most ``SCALE * n / f`` for the frequency f of
either outer word, as the other part occurs at least as often as the phrase. So words in order of rising frequency are the branches in order of their
bounds. A round takes as frontier the words of up to some frequency and grows phrases from them: those that begin and those that end with a
frontier word (the parts of a cut are of these kinds), one word longer at a time, only where the shorter phrase occurs ``LEAST`` times.
Phrases with both outer words in the frontier are scored. A language is settled when its ``TOP``-th surviving score exceeds
the bound of all words beyond the frontier, or no word is left. Else the next frontier reaches to the frequency whose bound is the
``TOP``-th score found so far, as that can only rise, or ``STEP`` times further if fewer were found.

A phrase is dropped if some longer phrase with the same frequency holds it: then all its occurrences have the same left or right neighbour, which
is what the occurrences are asked for.

Texts are read twice: to count the words of each language, then to store them as word hashes, with rare words (below ``LEAST``) as breaks.
Growth reads only the stored hashes. Which words are frequent, or in the frontier, and which phrases may grow is sent to the tasks
as a bitmap of ``BITS`` bits, whatever the input; strangers that share a bit are counted in vain and dropped by their exact counts.
Phrases are known by 64-bit hashes of their words. All counts are sums that are partly made before the shuffle.

Nulls: a null text is empty, a null lang ``und``; doc_id is not read. Repeated rows count each. Scores are exact decimals. Ties of score and frequency go
by the phrase's bytes. Very long texts are worked in batches of their own. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import _BASE, _LOWER, mix, owners, packed, word_hashes, word_spans
from ledgerloom.llm.common import arrow_sized, query, table
from ledgerloom.session import materialize

#: Least frequency and greatest length of a phrase, scale of the scores, and phrases of a language.
LEAST, LONGEST, SCALE, TOP = 100, 5, 1000, 2000
#: Bits of a bitmap (a power of two), and its size on the way to the tasks: 4 MB.
BITS = 1 << 25
#: Frequency that the first frontier reaches to, in multiples of ``LEAST``, and the step to the next.
FIRST, STEP = 12, 4

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_NO_WORD = _BREAK.copy()
_NO_WORD[[9, 32]] = True


# ---- texts to word hashes


def _lang_hash(column: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    coded = column.dictionary_encode()
    buf, offsets = packed(coded.dictionary)
    codes = np.array([_text_hash(buf[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
    return codes[coded.indices.to_numpy()] if len(column) else np.empty(0, np.uint64)


def _text_hash(raw: np.ndarray) -> np.uint64:
    if not len(raw):
        return np.uint64(0x5851F42D4C957F2D)
    return word_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0]


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Buffer, starts, ends, hashes (with the language, never 0) and text of all words, and whether a piece begins there."""
    buf, offsets = packed(batch.column("text"))
    starts, ends, first = word_spans(buf, offsets, _NO_WORD)
    text = owners(first)
    hashes = mix(word_hashes(buf, starts, ends, lower=True) + _lang_hash(batch.column("lang"))[text] * _BASE)
    hashes = hashes | (hashes == 0)
    breaks = np.concatenate([[0], np.cumsum(_BREAK[buf])])
    opens = np.ones(len(starts), bool)
    opens[1:] = (breaks[starts[1:]] > breaks[starts[:-1]]) | (text[1:] != text[:-1])
    return buf, starts, ends, hashes, text, opens


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each batch with their language and count."""
    for batch in batches:
        buf, starts, ends, hashes, text, _ = _hashed(batch)
        unique, at, count = np.unique(hashes, return_index=True, return_counts=True)
        sizes = ends[at] - starts[at]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        where = np.arange(edges[-1]) + np.repeat(starts[at] - edges[:-1], sizes)
        data = pa.py_buffer(np.ascontiguousarray(_LOWER[buf[where]]))
        words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(edges.astype(np.int64)), data)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang").take(pa.array(text[at])),
                pa.array(unique.view(np.int64)),
                words.cast(pa.string()),
                pa.array(count, pa.int64()),
            ],
            names=["lang", "h", "word", "f"],
        )


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes & np.uint64(bits - 1)).astype(np.int64)


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _slots(hashes, len(bitmap) * 8)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _stored_rows(frequent):
    """The words of each text as hashes; 0 stands for a break, a rare word, and the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, hashes, text, opens = _hashed(batch)
            kept = np.where(_has(frequent.value, hashes), hashes, np.uint64(0))
            # one break before each piece, and none beside another
            sizes = 1 + opens.astype(np.int64)
            ends = np.cumsum(sizes)
            spread = np.zeros(ends[-1] if len(ends) else 0, np.uint64)
            spread[ends - 1] = kept
            owner = np.repeat(text, sizes)
            double = np.zeros(len(spread), bool)
            double[1:] = (spread[1:] == 0) & (spread[:-1] == 0) & (owner[1:] == owner[:-1])
            spread, owner = spread[~double], owner[~double]
            # a word between two breaks is in no phrase
            alone = np.zeros(len(spread), bool)
            alone[1:-1] = (spread[:-2] == 0) & (spread[2:] == 0) & (spread[1:-1] != 0)
            keep = ~alone
            spread, owner = spread[keep], owner[keep]
            edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            lists = pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), pa.array(spread.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), lists.cast(pa.list_(pa.int64()))], names=["lang", "words"]
            ).filter(pa.array(np.diff(edges) > 1))

    return run


# ---- growth


def _joined(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of the phrases ``left`` with one more word; 0 where either is 0."""
    out = mix(left * _BASE + word)
    return np.where((left == 0) | (word == 0), np.uint64(0), out | (out == 0))


def _phrases(words: np.ndarray, length: int) -> list[np.ndarray]:
    """Hashes of the phrases of 1 to ``length`` words that begin at each place."""
    out = [words]
    for k in range(1, length):
        following = np.concatenate([words[k:], np.zeros(k, np.uint64)])
        out.append(_joined(out[-1], following))
    return out


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """``x`` from the place ``by`` further on, nothing beyond the end."""
    if by < 0:
        return np.concatenate([np.zeros(-by, x.dtype), x[:by]])
    return np.concatenate([x[by:], np.zeros(by, x.dtype)])


_GROWN = "kind string, h long, f long, left_low long, left_high long, right_low long, right_high long, words array<long>"


def _grown_rows(length: int, frontier, shorter):
    """Counts of the phrases of ``length`` words, and neighbours of the frequent scored phrases of one word less."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("words").flatten().to_numpy().view(np.uint64)
            if not len(words):
                continue
            inside = _has(frontier.value, words) & (words != 0)
            levels = _phrases(words, length)
            whole, less = levels[-1], levels[-2]
            grows = (_has(shorter.value, less) & (less != 0)) if length > 2 else words != 0
            before = inside & grows  # begins in the frontier, and its first part is frequent
            last = _shifted(inside, length - 1)
            after = last & _shifted(grows, 1)
            both = before & after
            # a phrase with both outer words in the frontier needs both parts
            asked = np.where(inside & last, both, before | after) & (whole != 0)
            if length == LONGEST:
                asked &= both
            at = np.flatnonzero(asked)
            unique, place, count = np.unique(whole[at], return_index=True, return_counts=True)
            yield _batch("count", unique, count, _lists(words, at[place], length) if length == LONGEST else None)
            if length > 2:
                at = np.flatnonzero(inside & _shifted(inside, length - 2) & grows)
                order = at[np.argsort(less[at], kind="stable")]
                unique, place = np.unique(less[order], return_index=True)
                left, right = _shifted(words, -1)[order], _shifted(words, length - 1)[order]
                ends = [
                    f.reduceat(side.view(np.int64), place) if len(place) else np.empty(0, np.int64)
                    for side in (left, right)
                    for f in (np.minimum, np.maximum)
                ]
                yield _batch("ends", unique, None, _lists(words, order[place], length - 1), ends)

    return run


def _lists(words: np.ndarray, at: np.ndarray, length: int) -> pa.Array:
    flat = words[(at[:, None] + np.arange(length)).ravel()].view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * length, pa.int32()), pa.array(flat))


def _batch(kind: str, h: np.ndarray, count, words=None, ends=None) -> pa.RecordBatch:
    n = len(h)
    none = pa.nulls(n, pa.int64())
    columns = [
        pa.array([kind] * n, pa.string()),
        pa.array(h.view(np.int64)),
        none if count is None else pa.array(count, pa.int64()),
        *([none] * 4 if ends is None else [pa.array(e) for e in ends]),
        pa.nulls(n, pa.list_(pa.int64())) if words is None else words,
    ]
    return pa.RecordBatch.from_arrays(
        columns, names=["kind", "h", "f", "left_low", "left_high", "right_low", "right_high", "words"]
    )


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each cut of each phrase: the hashes of its two parts."""
    for batch in batches:
        for row in batch.to_pylist():
            words = np.array(row["words"], np.int64).view(np.uint64)
            heads = [p[:1].view(np.int64)[0] for p in _phrases(words, len(words))]
            tails = [_phrases(words[k:], len(words) - k)[-1][:1].view(np.int64)[0] for k in range(len(words))]
            cuts = range(1, len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["lang"]] * len(cuts), pa.string()),
                    pa.array([row["h"]] * len(cuts), pa.int64()),
                    pa.array(list(cuts), pa.int32()),
                    pa.array([heads[k - 1] for k in cuts], pa.int64()),
                    pa.array([tails[k] for k in cuts], pa.int64()),
                ],
                names=["lang", "h", "k", "left", "right"],
            )


def bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bits set at the places of the hashes ``h``; its size is fixed, whatever the number of hashes."""
    slot = F.col("h").bitwiseAND(F.lit(bits - 1))
    chunk = 1 << 15
    bits_of = hashes.select(F.floor(slot / chunk).alias("chunk"), F.pmod(slot, F.lit(chunk)).alias("bit"))
    rows = bits_of.groupBy("chunk").agg(F.bitmap_construct_agg("bit").alias("map")).collect()
    out = np.zeros(max(bits, chunk) // 8, np.uint8)
    for row in rows:
        out[row["chunk"] * chunk // 8 :][: chunk // 8] = np.frombuffer(row["map"], np.uint8)
    return out[: bits // 8]


def _grown(
    stored: DataFrame, frontier: np.ndarray, words: DataFrame, least: int, longest: int, bits: int
) -> tuple[DataFrame, DataFrame]:
    """Frequencies (h, f) of all grown parts, and the scored phrases (h, a, words) that no longer one hides."""
    context = stored.sparkSession.sparkContext
    inside, shorter = context.broadcast(frontier), context.broadcast(np.zeros(1, np.uint8))
    counts, scored, level = words.select("h", "f"), None, None
    for length in range(2, longest + 1):
        found = stored.mapInArrow(_grown_rows(length, inside, shorter), _GROWN)
        rows = found.groupBy("kind", "h").agg(
            F.sum("f").alias("f"),
            *[F.min(f"{side}_low").alias(f"{side}_low") for side in ("left", "right")],
            *[F.max(f"{side}_high").alias(f"{side}_high") for side in ("left", "right")],
            F.first("words", ignorenulls=True).alias("words"),
        )
        rows = materialize(rows.filter((F.col("kind") == "ends") | (F.col("f") >= least)), "grown")
        if length > 2:
            ends = rows.filter("kind = 'ends'").select("h", "left_low", "left_high", "right_low", "right_high", "words")
            # neighbours that are all the same word hide the phrase in a longer one
            same = lambda s: (F.col(f"{s}_low") == F.col(f"{s}_high")) & (F.col(f"{s}_low") != 0)
            open_ = ends.filter(~same("left") & ~same("right")).join(level, "h").select("h", "f", "words")
            scored = open_ if scored is None else scored.unionByName(open_)
        level = rows.filter("kind = 'count'").select("h", "f")
        if length < longest:
            counts = counts.unionByName(level)
            shorter = context.broadcast(bitmap(level, bits))
        else:
            scored = scored.unionByName(rows.filter("kind = 'count'").select("h", "f", "words"))
    return counts, scored


def _scores(counts: DataFrame, scored: DataFrame, words: DataFrame, totals: DataFrame, scale: int) -> DataFrame:
    """lang, h, words, a, l, r, n, score of each scored phrase at its worst cut."""
    first = words.select(F.col("h").alias("w_h"), "lang")
    named = scored.join(first, F.col("words")[0] == F.col("w_h")).select("lang", "h", "f", "words")
    named = materialize(named, "phrases")
    cuts = named.select("lang", "h", "words").mapInArrow(_cut_rows, "lang string, h long, k int, left long, right long")
    left = counts.select(F.col("h").alias("left"), F.col("f").alias("l"))
    right = counts.select(F.col("h").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(left, "left").join(right, "right").join(named.select("h", F.col("f").alias("a")), "h")
    cuts = cuts.join(totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    over = F.lit(scale).cast("decimal(5,0)") * F.col("a").cast("decimal(15,0)") * F.col("n").cast("decimal(16,0)")
    cuts = cuts.withColumns({"over": over, "under": wide("l") * wide("r")})
    cuts = cuts.withColumn("score", F.expr("over div under"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("x")
    done = cuts.groupBy("lang", "h", "a", "n").agg(worst)
    done = done.select("lang", "h", "a", "n", "x.score", "x.l", "x.r")
    return done.join(named.select("h", "words"), "h")


def _spelled(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the text of its phrases."""
    parts = found.select("h", F.posexplode("words").alias("pos", "w_h"))
    texts = words.select(F.col("h").alias("w_h"), "word")
    parts = parts.join(texts, "w_h").groupBy("h")
    spelled = parts.agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("parts"))
    spelled = spelled.select("h", F.array_join(F.col("parts.word"), " ").alias("phrase"))
    return found.join(spelled, "h")


def mine(
    docs: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    longest: int = LONGEST,
    scale: int = SCALE,
    bits: int = BITS,
    first: int = FIRST,
    step: int = STEP,
    said: Callable[[str], None] | None = None,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each language."""
    if longest != LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    arrow_sized(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    counted = texts.mapInArrow(_word_rows, "lang string, h long, word string, f long")
    counted = counted.groupBy("lang", "h").agg(F.sum("f").alias("f"), F.min("word").alias("word"))
    counted = materialize(counted, "words")
    # one row per language: their list is part of what is asked for
    totals = materialize(counted.groupBy("lang").agg(F.sum("f").alias("n"), F.max("f").alias("most")), "totals")
    words = materialize(counted.filter(F.col("f") >= least), "frequent")
    frequent = spark.sparkContext.broadcast(bitmap(words, bits))
    stored = materialize(texts.mapInArrow(_stored_rows(frequent), "lang string, words array<long>"), "stored")
    reach = totals.select("lang", "n", "most", F.lit(first * least).cast("long").alias("reach"))
    results = None
    while True:
        reach = materialize(reach, "reach")
        if reach.isEmpty():
            break
        held = reach.select("lang", "reach")
        frontier = words.join(held, "lang").filter(F.col("f") <= F.col("reach"))
        here = stored.join(held.select("lang"), "lang", "left_semi").select("words")
        counts, scored = _grown(here, bitmap(frontier, bits), words, least, longest, bits)
        # bits are shared: the outer words decide
        outer = frontier.select(F.col("h").alias("o_h"))
        scored = scored.join(outer, F.col("words")[0] == F.col("o_h"), "left_semi")
        scored = scored.join(outer, F.element_at("words", -1) == F.col("o_h"), "left_semi")
        found = materialize(_scores(counts, scored, words, totals.select("lang", "n"), scale), "scored")
        best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("h"))
        last = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") == top)
        state = reach.join(last.select("lang", F.col("score").alias("last")), "lang", "left")
        # the best score that a phrase with a word beyond the frontier can have
        bound = F.floor(F.lit(scale) * F.col("n").cast("decimal(19,0)") / (F.col("reach") + 1))
        settled = (F.col("reach") >= F.col("most")) | F.coalesce(F.col("last") > bound, F.lit(False))
        state = materialize(state.withColumn("settled", settled), "state")
        if said:
            said(str(state.collect()))
        ready = found.join(state.filter("settled").select("lang", "last"), "lang")
        ready = ready.filter(F.col("last").isNull() | (F.col("score") >= F.col("last"))).drop("last")
        results = ready if results is None else results.unionByName(ready)
        further = F.coalesce(
            F.greatest(F.floor(F.lit(scale) * F.col("n").cast("decimal(19,0)") / F.greatest("last", F.lit(1))), F.col("reach") + 1),
            F.col("reach") * step,
        )
        reach = state.filter(~F.col("settled")).select("lang", "n", "most", further.cast("long").alias("reach"))
    if results is None:
        results = spark.createDataFrame([], "lang string, h long, a long, n long, score long, l long, r long, words array<long>")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = _spelled(results, words).withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@query("op13_collocations")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents").select("lang", "text"))
