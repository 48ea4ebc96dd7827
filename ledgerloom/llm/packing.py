"""Packing of tokenised documents into sequences, by a grouping genetic algorithm on islands.

A document is its token ids and one closing id; one longer than ``SEQUENCE`` is cut into pieces of that length, the last
of which may be shorter. A piece of full length is a sequence of its own. The others are dealt by hash to groups of about ``GROUP`` pieces.
Each group is solved on ``ISLANDS`` islands: a population of packings, where a genome numbers the bin of each piece. Crossover
injects the best-filled bins of one parent whole into the other, drops the bins that hold a piece twice, and best-fits the displaced pieces, longest
first; a mutation dissolves some bins. After each epoch an island's best packing moves to the next island. A group whose
packing needs no more bins than its tokens do stops early. The least filled bins of ``FAN`` groups then form a group of the next level, and so on up
to a single group, so the waste does not grow with the number of groups.

Tokens: the tokenizer's words never cross white space, nor go from an ASCII letter to a digit or a mark; so each distinct part between such places
is tokenised once per task, and the ids are those of the whole text. A tokenizer with other words encodes whole texts.

Nulls: a null text is empty, which is the closing id alone; a null doc_id is kept. Repeated rows are documents of their own;
ties (equal lengths) are told apart by the row's number. Very long texts become many pieces. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import _GAP, _LOWER, packed
from ledgerloom.llm.common import arrow_sized, query, table
from ledgerloom.session import materialize

#: Tokens of a sequence, and the id that closes a document.
SEQUENCE, CLOSE = 4096, 1
#: Pieces that one group holds on average, and groups that send their loosest bins to one group of the next level.
GROUP, FAN = 8192, 16
#: Islands of a group, packings of an island, epochs, and crossovers in an epoch.
ISLANDS, POPULATION, EPOCHS, CROSSOVERS = 3, 4, 2, 24
#: Share of a parent's bins that a crossover injects, and of bins that a mutation dissolves.
INJECTED, DISSOLVED = 0.3, 0.03
#: Distinct parts whose ids a task remembers.
REMEMBERED = 400_000

# fixed value: the words of tokenizers whose ids can be put together from parts
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Parts that are tokenised in one call, told apart by a special token.
TOGETHER = 200



def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte, and for each pair of kinds (seven to a row) whether a part begins between them.

    0 white space, 1 digit, 2 ASCII letter, 3 mark, 4 apostrophe, 5 the bar and whatever is not ASCII, 6 the start of a text.
    """
    code = np.arange(256)
    kind = np.full(256, 5, np.uint8)
    kind[(code > 32) & (code < 127) & (code != ord("|"))] = 3
    kind[(code >= 48) & (code < 58)] = 1
    kind[((code | 32) >= 97) & ((code | 32) < 123)] = 2
    kind[ord("'")] = 4
    kind[_GAP] = 0
    begins = np.zeros((7, 7), bool)
    begins[0, 1:] = begins[6, 1:] = True
    # a digit is a word of its own; letters and marks part, but for what follows an apostrophe
    begins[1, 1:5] = begins[2:5, 1] = True
    begins[2, 3:5] = begins[3, 2] = True
    return kind, begins.ravel()


_KIND, _BEGINS = _kinds()


# ---- tokens


def _parts(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the parts that are tokenised by themselves, and each text's first part.

    Within a word they begin at an ASCII digit and after one, between a letter and another character, and between such a
    character and a letter (but not after an apostrophe); none of these is a place inside a special token.
    """
    kind = _KIND[buf]
    before = np.empty_like(kind)
    before[1:] = kind[:-1]
    before[offsets[:-1][offsets[:-1] < len(buf)]] = 6
    fresh = _BEGINS[before * np.uint8(7) + kind]
    starts = np.flatnonzero(fresh)
    # a part ends where the next one begins, or at white space, or with the buffer
    last = np.ones(len(buf), bool)
    last[:-1] = fresh[1:] | (kind[1:] == 0)
    last &= kind != 0
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The parts as strings, with small letters, unless there is a bar: special tokens are not changed."""
    sizes = ends - starts
    edges = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(edges[-1]) - np.repeat(edges[:-1] - starts, sizes)
    text = _LOWER[buf[at]]
    if (bars := np.flatnonzero(text == ord("|"))).size:
        for part in np.unique(np.searchsorted(edges, bars, "right") - 1):
            text[edges[part] : edges[part + 1]] = buf[starts[part] : ends[part]]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(text))


def _ragged(values: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` that begin at ``first`` and have ``sizes``, one after the other."""
    edges = np.cumsum(sizes)
    return values[np.arange(edges[-1] if len(edges) else 0) + np.repeat(first - edges + sizes, sizes)]


class _Encoder:
    """Ids of texts. The ids of distinct parts are kept for the next batches, up to ``REMEMBERED``."""

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model.decode())
        steps = json.loads(model).get("pre_tokenizer") or {}
        patterns = [s.get("pattern", {}).get("Regex") for s in steps.get("pretokenizers", [])]
        special = [(t, x.content) for t, x in self.model.get_added_tokens_decoder().items() if x.special and not x.normalized]
        self.by_parts = WORDS in patterns and bool(special)
        self.mark, self.between = special[0] if special else (None, None)
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.ids, self.edges = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(c.ids, np.uint32) for c in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Remember the ids of new parts; returns the order in which they are kept."""
        bars = pc.match_substring(new, "|").to_numpy(zero_copy_only=False)
        order = np.argsort(bars, kind="stable")
        new = new.take(pa.array(order))
        texts = new.to_pylist()
        plain = len(texts) - int(bars.sum())
        ids, sizes = [], []
        for found in self._whole([self.between.join(texts[i : min(i + TOGETHER, plain)]) for i in range(0, plain, TOGETHER)]):
            marks = found == self.mark
            ids.append(found[~marks])
            sizes.append(np.diff(np.concatenate([[-1], np.flatnonzero(marks), [len(found)]])) - 1)
        more = self._whole(texts[plain:])
        sizes.append(np.array([len(c) for c in more], np.int64))
        self.known = pa.concat_arrays([self.known, new])
        self.ids = np.concatenate([self.ids, *ids, *more])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(np.concatenate(sizes))])
        return order

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a batch of texts, each closed, and the place of each text's first id (one more at the end)."""
        if not self.by_parts:
            coded = self._whole([t or "" for t in column.to_pylist()])
            close = np.array([CLOSE], np.uint32)
            ids = np.concatenate([x for c in coded for x in (c, close)] or [close[:0]])
            return ids, np.cumsum([0] + [len(c) + 1 for c in coded])
        buf, offsets = packed(column)
        starts, ends, first = _parts(buf, offsets)
        coded = _strings(buf, starts, ends).dictionary_encode()
        distinct = coded.dictionary
        place = pc.index_in(distinct, value_set=self.known)
        if place.null_count:
            if len(self.known) + place.null_count > REMEMBERED:
                self._forget()
                place = pa.nulls(len(distinct), pa.int32())
            new = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
            place = place.fill_null(0).to_numpy().copy()
            order = self._learn(distinct.take(pa.array(new)))
            place[new[order]] = np.arange(len(self.known) - len(new), len(self.known))
        else:
            place = place.to_numpy()
        at = place.astype(np.int64)[coded.indices.to_numpy()]
        here = np.diff(self.edges)[at]
        flat = _ragged(self.ids, self.edges[at], here)
        upto = np.concatenate([[0], np.cumsum(here)])[first]
        texts = len(offsets) - 1
        out = np.empty(len(flat) + texts, np.uint32)
        closes = np.zeros(len(out), bool)
        closes[upto[1:] + np.arange(texts)] = True
        out[closes] = CLOSE
        out[~closes] = flat
        return out, upto + np.arange(texts + 1)


def _piece_rows(model, keep_ids: bool, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or _Encoder(model.value)
            ids, first = encode(batch.column("text"))
            lengths = np.diff(first)
            pieces = -(-lengths // size)
            row = np.repeat(np.arange(len(lengths)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * size
            length = np.minimum(size, lengths[row] - start)
            at = first[row] + start
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if keep_ids:
                edges = pa.array(np.append(at, first[-1]).astype(np.int32))
                columns["ids"] = pa.ListArray.from_arrays(edges, pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def tokenised(docs: DataFrame, model: bytes, keep_ids: bool = True, size: int = SEQUENCE) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32 and, if wanted, ids.

    ``model`` is the content of a tokenizer's JSON file; it is sent to every executor, and its size is that of the file.
    """
    spark = docs.sparkSession
    arrow_sized(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return docs.select("doc_id", "text").mapInArrow(
        _piece_rows(spark.sparkContext.broadcast(model), keep_ids, size), schema
    )


# ---- the genetic algorithm inside one island


def best_fit(lengths: np.ndarray, bins: np.ndarray, free: np.ndarray, items: np.ndarray, size: int) -> None:
    """Put ``items`` in their order each into the fullest bin that has room, or a new one; ``bins`` is changed.

    ``free`` is the room of the bins 0, 1, ...; bins with none are passed over.
    """
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    for b, room in enumerate(free.tolist()):
        by_room[room].append(b)
    rooms = 0
    for room in np.unique(free[free > 0]).tolist():
        rooms |= 1 << room
    following = len(free)
    places = []
    for need in lengths[items].tolist():
        wide = rooms >> need
        if wide:
            room = need + (wide & -wide).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = size, following
            following += 1
        places.append(b)
        left = room - need
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(b)
    bins[items] = places


def renumbered(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fitness(lengths: np.ndarray, bins: np.ndarray, size: int) -> float:
    """Mean of the squared fill of the bins."""
    fill = np.bincount(bins, lengths)
    return float(np.mean((fill / size) ** 2))


def cross(
    lengths: np.ndarray, giver: np.ndarray, taker: np.ndarray, size: int, rng: np.random.Generator
) -> np.ndarray:
    """``taker`` with well-filled bins of ``giver``; then some bins are dissolved. Displaced pieces are best-fitted."""
    fill = np.bincount(giver, lengths)
    wanted = max(1, int(INJECTED * len(fill)))
    # a weighted draw in which fuller bins come first
    order = np.argsort(-(fill / size) * rng.random(len(fill)) ** 0.25)
    chosen = np.zeros(len(fill), bool)
    chosen[order[:wanted]] = True
    injected = chosen[giver]
    old = int(taker.max()) + 1
    gone = np.bincount(taker[injected], minlength=old) > 0
    room = size - np.bincount(taker, lengths, old)
    gone |= (rng.random(old) < DISSOLVED) | ((room > 0) & (rng.random(old) < room / size))
    displaced = np.flatnonzero(gone[taker] & ~injected)
    child = np.where(injected, old + giver, taker)
    child[displaced] = -1
    held = child >= 0
    compact = renumbered(child[held])
    child[held] = compact
    count = int(compact.max()) + 1 if len(compact) else 0
    free = size - np.bincount(compact, lengths[held], count).astype(np.int64) if count else np.empty(0, np.int64)
    # lengths are sorted, so the displaced pieces come longest first
    best_fit(lengths, child, free, displaced, size)
    return renumbered(child)


def seeded(lengths: np.ndarray, size: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    order = np.argsort(-lengths * (1 + noise * rng.random(len(lengths))), kind="stable")
    bins = np.empty(len(lengths), np.int64)
    best_fit(lengths, bins, np.empty(0, np.int64), order, size)
    return renumbered(bins)


def evolve(
    lengths: np.ndarray, population: list[np.ndarray], size: int, rng: np.random.Generator, least: int, crossovers: int
) -> list[np.ndarray]:
    """The population after some crossovers, best first; stops at a packing of ``least`` bins."""
    ranked = sorted(((fitness(lengths, g, size), i, g) for i, g in enumerate(population)), key=lambda x: (-x[0], x[1]))
    for turn in range(crossovers):
        if int(ranked[0][2].max()) + 1 <= least:
            break
        a, b = rng.choice(len(ranked), 2, replace=len(ranked) < 2)
        child = cross(lengths, ranked[a][2], ranked[b][2], size, rng)
        ranked.append((fitness(lengths, child, size), len(population) + turn, child))
        ranked.sort(key=lambda x: (-x[0], x[1]))
        ranked.pop()
    return [g for _, _, g in ranked]


_STATE = "grp long, island int, lengths array<int>, population array<array<int>>, score double"


def _island_rows(size: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                rng = np.random.default_rng([row["grp"], row["island"], epoch])
                least = -(-int(lengths.sum()) // size)
                if row["population"] is None:
                    genomes = [seeded(lengths, size, rng, 0.0)]
                    if int(genomes[0].max()) + 1 > least:
                        genomes += [seeded(lengths, size, rng, 0.1 * (i + row["island"])) for i in range(1, POPULATION)]
                else:
                    genomes = [np.array(g, np.int64) for g in row["population"]]
                genomes = evolve(lengths, genomes, size, rng, least, CROSSOVERS)
                row["population"] = [g.tolist() for g in genomes]
                row["score"] = fitness(lengths, genomes[0], size) - float(genomes[0].max())
                row.pop("immigrant", None)
                yield pa.RecordBatch.from_pylist([row], _ARROW)

    return run


_ARROW = pa.schema(
    [("grp", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32()))]
    + [("population", pa.list_(pa.list_(pa.int32()))), ("score", pa.float64())]
)


def _solved(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, grp, length) with the number ``bin`` of the best packing that the islands of the group found."""
    spark = rows.sparkSession
    # a group has a bounded number of pieces: GROUP on average, or the loosest bins of FAN groups
    items = F.array_sort(F.collect_list(F.struct((-F.col("length")).cast("int").alias("l"), "id")))
    groups = materialize(rows.groupBy("grp").agg(items.alias("items")), "groups")
    state = groups.select(
        "grp",
        F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
        F.transform("items", lambda x: -x["l"]).alias("lengths"),
        F.lit(None).cast("array<array<int>>").alias("population"),
        F.lit(None).cast("double").alias("score"),
    )
    parallel = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for epoch in range(EPOCHS):
        if epoch:
            moved = state.select(
                F.col("grp").alias("m_grp"),
                ((F.col("island") + 1) % ISLANDS).alias("m_island"),
                F.slice("population", 1, 1).alias("immigrant"),
            )
            met = (state["grp"] == moved["m_grp"]) & (state["island"] == moved["m_island"])
            # the immigrant takes the place of the worst packing
            mixed = F.concat("immigrant", F.slice("population", 1, POPULATION - 1))
            state = state.join(moved, met).select("grp", "island", "lengths", mixed.alias("population"), "score")
        state = state.repartition(parallel, "grp", "island").mapInArrow(_island_rows(size, epoch), _STATE)
        state = materialize(state, "islands")
    best = state.groupBy("grp").agg(
        F.max_by(F.col("population")[0], F.struct("score", -F.col("island"))).alias("bins")
    )
    joined = groups.join(best, "grp").select("grp", F.explode(F.arrays_zip("items", "bins")).alias("x"))
    return joined.select(
        "grp",
        F.col("x.items.id").alias("id"),
        (-F.col("x.items.l")).cast("long").alias("length"),
        F.col("x.bins").cast("long").alias("bin"),
    )


def packed_bins(rows: DataFrame, size: int = SEQUENCE, group: int = GROUP, fan: int = FAN) -> DataFrame:
    """Rows (id, length) with the ``sequence_id`` of their sequence; ids differ, lengths lie from 1 to ``size``."""
    whole = rows.filter(F.col("length") == size).select("id", "length", (-1 - F.col("id")).alias("sequence_id"))
    rest = rows.filter(F.col("length") < size).select("id", "length")
    count = rest.count()
    groups = -(-count // group)
    if not count:
        return whole
    level, done = 0, whole
    work = rest.withColumn("grp", F.pmod(F.xxhash64("id"), F.lit(groups)))
    while True:
        solved = materialize(_solved(work, size), "packed")
        numbered = F.lit(level << 56) + F.shiftleft("grp", 20) + F.col("bin")
        solved = solved.withColumn("sequence_id", numbered)
        if groups == 1:
            return done.unionByName(solved.select("id", "length", "sequence_id"))
        fill = solved.groupBy("grp", "bin").agg(F.sum("length").alias("fill"), F.count(F.lit(1)).alias("pieces"))
        loosest = Window.partitionBy("grp").orderBy("fill", "bin").rowsBetween(Window.unboundedPreceding, -1)
        earlier = F.coalesce(F.sum("pieces").over(loosest), F.lit(0))
        # the loosest bins of a group go up, the first in any case, while they hold a share of a group's pieces
        loose = fill.withColumn("earlier", earlier).filter(F.col("earlier") <= group // fan - F.col("pieces")).select("grp", "bin")
        first = fill.groupBy("grp").agg(F.min_by("bin", F.struct("fill", "bin")).alias("bin"))
        loose = materialize(loose.union(first.select("grp", "bin")).distinct(), "loose")
        done = done.unionByName(solved.join(loose, ["grp", "bin"], "left_anti").select("id", "length", "sequence_id"))
        level, groups = level + 1, -(-groups // fan)
        work = solved.join(loose, ["grp", "bin"], "left_semi").select(
            "id", "length", F.floor(F.col("grp") / fan).cast("long").alias("grp")
        )


def placed(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` with the sequence_id and the offset of each."""
    numbered = materialize(pieces.withColumn("_id", F.monotonically_increasing_id()), "pieces")
    bins = packed_bins(numbered.select(F.col("_id").alias("id"), "length"), size)
    before = Window.partitionBy("sequence_id").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    bins = bins.select(F.col("id").alias("_b_id"), "sequence_id", offset.alias("offset"))
    return numbered.join(bins, numbered["_id"] == bins["_b_id"]).drop("_id", "_b_id")


def sequences(docs: DataFrame, model: bytes, size: int = SEQUENCE) -> DataFrame:
    """The training sequences: sequence_id, its token ids, and the (doc_id, piece, offset, length) of its pieces."""
    rows = placed(tokenised(docs, model, True, size), size)
    part = F.struct("offset", "ids", "doc_id", "piece", "length")
    whole = rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    return whole.select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform(
            "parts",
            lambda p: F.struct(*[p[c].alias(c) for c in ("doc_id", "piece", "offset", "length")]),
        ).alias("pieces"),
    )


def tokenizer_file(name: str = "word_bpe_49k.json") -> bytes:
    """A public tokenizer's file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@query("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return placed(tokenised(docs, tokenizer_file(), keep_ids=False))
