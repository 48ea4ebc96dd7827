"""Language-model scores: a hashed maximum-entropy model with class-factored softmax.

A text is its words (A-Z folded) and one end. The probability of a token is that of its class after the tokens before
it, times its share within the class. Classes: the end; rare tokens (seen once in training, or never); and distributional ones: the words next to a
token, as sums of random signs in ``DIMS`` dimensions over all training documents, give it a direction, and the nearest of ``CLUSTERS`` centroids is its class
(fitted on all types; if there are more than ``FEW``, those whose directions share a cell of a grid with ``LEVELS`` steps a dimension move together, with the sum of their weighted directions). Tokens that never occur twice in one block have no direction and share a class. Class scores are
sums of hashed features of the history: the last token, the one before it (a skip), and the classes of the last two and of the last three. Within
a class the unigram feature gives counts their share; in the rare class unseen tokens take what seen-once tokens take in general (Good-Turing).

Training: each task makes mini-batch AdaGrad steps over its documents, starting from the common weights; the tasks'
changes are averaged over the cluster and the next round goes on from there. The ``ROUNDS`` rounds read disjoint
parts of the training documents, all of them together. Token counts come from all training documents. Documents are kept in
blocks of about ``BLOCK`` bytes: a block looks up its distinct tokens only, so neither all pairs of document and token
nor the vocabulary meet anywhere.

Nulls: a null text is empty: its only token is the end. A row with a null doc_id is scored and not learned from. Equal rows get
equal scores and count as often as they occur. Without training documents all tokens are unseen. Without ``rounds`` of training the classes have their shares. An empty table gives an empty
result. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import mix, packed, word_hashes, word_spans
from ledgerloom.llm.common import arrow_sized, crc_mod, query, table
from ledgerloom.session import materialize

FOLDS, HELD_OUT = 10, 0
BLOCK = 24 << 20
#: Weight rows of hashed words and as many of hashed classes; the table has the size FEATURES.
ROWS = 8192
FEATURES = 2 * ROWS
#: Dimensions of a token's direction, distributional classes, types that are fitted one by one, and steps of each dimension in the grid of directions.
DIMS, CLUSTERS, FEW, LEVELS = 8, 40, 20_000, 4
#: Where the steps of the grid part, and units of a sum of weighted directions, which are whole numbers.
_STEPS = np.array([-1, 0, 1], np.float32) / np.float32(math.sqrt(DIMS))
_UNITS = 1 << 16
ROUNDS = 3
#: Tokens of a training step and its AdaGrad rate, and tokens that are scored at a time.
STEP, RATE = 1024, 0.5
BATCH = 8192
#: Tokens looked up at a time, and bytes of text (or one text) cut into tokens at a time.
SLICE = 1 << 20
RARE, END_CLASS, LOOSE, FIRST_CLUSTER = 0, 1, 2, 3
_END = np.uint64(0x5DEECE66D1234567)
_SEEDS = [np.uint32(x) for x in (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1)]


@dataclass
class Classes:
    """Centroids (clusters, DIMS), training tokens per class, and the totals of training."""

    centroids: np.ndarray
    tokens: np.ndarray
    total: int
    types: int
    once: int
    unseen: float

    @property
    def count(self) -> int:
        return len(self.tokens)


def directions(signs: np.ndarray) -> np.ndarray:
    """Unit vectors from packed directions: ``DIMS`` signed bytes each."""
    x = signs.astype("<i8").view(np.int8).reshape(-1, DIMS).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)


def class_of(centroids: np.ndarray, tokens: np.ndarray, counts: np.ndarray, signs: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The class of tokens from their training counts and directions (``known``: whether there is one)."""
    out = np.full(len(tokens), LOOSE, np.uint8)
    if len(centroids):
        at = np.flatnonzero(known)
        for a in range(0, len(at), SLICE):
            part = at[a : a + SLICE]
            out[part] = FIRST_CLUSTER + (directions(signs[part]) @ centroids.T).argmax(axis=1)
    out[counts < 2] = RARE
    out[tokens == _END] = END_CLASS
    return out


def fit_centroids(signs: np.ndarray, counts: np.ndarray, clusters: int = CLUSTERS, turns: int = 20) -> np.ndarray:
    """Spherical k-means of directions, weighted by the root of the counts; fewer types than clusters are their own centroids."""
    x = directions(signs)
    weight = np.sqrt(counts.astype(np.float64))
    return _fitted(x, weight, weight[:, None] * x, clusters, turns)


def fit_centroids_of_cells(sums: np.ndarray, weight: np.ndarray, clusters: int = CLUSTERS, turns: int = 20) -> np.ndarray:
    """The same of cells of directions: ``sums`` of their weighted directions and of their weights."""
    x = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return _fitted(x, weight, sums, clusters, turns)


def _fitted(x: np.ndarray, weight: np.ndarray, weighted: np.ndarray, clusters: int, turns: int) -> np.ndarray:
    if len(x) <= clusters:
        return x
    rng = np.random.default_rng(3)
    chosen = [int(weight.argmax())]
    far = 1 - x @ x[chosen[0]]
    for _ in range(clusters - 1):
        share = np.maximum(far, 0) * weight
        if share.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(x), p=share / share.sum())))
        far = np.minimum(far, 1 - x @ x[chosen[-1]])
    centroids = x[chosen]
    for _ in range(turns):
        nearest = (x @ centroids.T).argmax(axis=1)
        sums = np.stack([np.bincount(nearest, weighted[:, d], len(centroids)) for d in range(DIMS)], axis=1)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 0, sums / np.maximum(size, 1e-9), centroids).astype(np.float32)
    return centroids


def _tokens(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a batch, each text's words followed by the end, and each text's first token."""
    buf, offsets = packed(batch.column("text"))
    starts, ends, first = word_spans(buf, offsets)
    words = word_hashes(buf, starts, ends, lower=True)
    n = len(first) - 1
    first = first + np.arange(n + 1)
    word = np.ones(len(words) + n, bool)
    word[first[1:] - 1] = False
    out = np.full(len(words) + n, _END, np.uint64)
    out[word] = words
    return out, first


def _blocked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the blocks of a partition: a new one after each ``BLOCK`` bytes."""
    base, used = TaskContext.get().partitionId() << 24, 0
    for batch in batches:
        _, offsets = packed(batch.column("text"))
        block = base + (used + offsets[:-1]) // BLOCK
        used += int(offsets[-1])
        yield batch.append_column("block", pa.array(block))


def _neighbours(tokens: np.ndarray, first: np.ndarray, train: np.ndarray) -> list[np.ndarray]:
    """For each dimension the sum of the signs of the words beside each token, within its text; 0 outside training."""
    inner = np.ones(len(tokens) + 1, bool)
    inner[first] = False  # no neighbour across the start of a text
    word = (tokens != _END) & train
    marks = mix(tokens)
    out = []
    for d in range(DIMS):
        sign = np.where(word, ((marks >> np.uint64(40 + d)) & np.uint64(1)).astype(np.int8) * 2 - 1, 0).astype(np.int8)
        beside = np.zeros(len(tokens), np.int8)
        beside[1:] += np.where(inner[1:-1], sign[:-1], 0).astype(np.int8)
        beside[:-1] += np.where(inner[1:-1], sign[1:], 0).astype(np.int8)
        beside[~word] = 0
        out.append(beside)
    return out


_SIGNS = [f"s{d}" for d in range(DIMS)]


def _distinct(block: int, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    tokens = np.concatenate([t for t, _, _ in held])
    counts = np.concatenate([c for _, c, _ in held])
    signs = np.concatenate([s for _, _, s in held], axis=1)
    found, at = np.unique(tokens, return_inverse=True)
    total = np.bincount(at, counts, len(found)).astype(np.int64)
    # one occurrence says little of a token; most tokens of a block occur once
    few = (total < 2) | (found == _END)
    sums = [pa.array(np.bincount(at, s, len(found)).astype(np.int64), mask=few) for s in signs]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(found), block)), pa.array(found.view(np.int64)), pa.array(total), *sums],
        names=["block", "token", "n", *_SIGNS],
    )


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, token, occurrences in training documents, sums of neighbours' signs), distinct within a block and task."""
    now, held = None, []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if blocks[a] != now and held:
                yield _distinct(now, held)
                held = []
            now = int(blocks[a])
            tokens, first = _tokens(part)
            train = np.repeat(part.column("train").to_numpy(zero_copy_only=False), np.diff(first))
            found, at = np.unique(tokens, return_inverse=True)
            signs = np.stack([np.bincount(at, s, len(found)).astype(np.int32) for s in _neighbours(tokens, first, train)])
            held.append((found, np.bincount(at, train, len(found)), signs))
    if held:
        yield _distinct(now, held)


def packed_direction() -> Column:
    """The sums of signs as ``DIMS`` signed bytes in one number; NULL without a direction."""
    most = F.greatest(*[F.abs(s) for s in _SIGNS])
    out = F.lit(0).cast("long")
    for d, s in enumerate(_SIGNS):
        byte = F.round(F.col(s) * 127 / most).cast("long").bitwiseAND(F.lit(255))
        out = out.bitwiseOR(F.shiftleft(byte, 8 * d))
    return F.when(most > 0, out)


def _cell_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, sum of weights, sums of weighted directions) of a batch of types, in whole units, so that any order gives the same sums."""
    for batch in batches:
        x = directions(batch.column("signs").to_numpy())
        weight = np.sqrt(batch.column("n").to_numpy().astype(np.float64))
        cell = sum(np.digitize(x[:, d], _STEPS).astype(np.int64) * LEVELS**d for d in range(DIMS))
        found, at = np.unique(cell, return_inverse=True)
        values = np.rint(np.column_stack([weight, weight[:, None] * x]) * _UNITS)
        sums = [pa.array(np.bincount(at, v, len(found)).astype(np.int64)) for v in values.T]
        yield pa.RecordBatch.from_arrays([pa.array(found), *sums], names=["cell", "weight", *_SIGNS])


def _class_rows(centroids: np.ndarray):
    """(class, tokens, types, types seen once, twice) of a batch of types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            token, n = batch.column("token").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            signs = batch.column("signs")
            kind = class_of(centroids, token, n, signs.fill_null(0).to_numpy(), signs.is_valid().to_numpy(zero_copy_only=False))
            size = FIRST_CLUSTER + CLUSTERS
            word = token != _END
            sums = [np.bincount(kind, n, size), np.bincount(kind, minlength=size)]
            sums += [np.bincount(kind[word & (n == k)], minlength=size) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size)), *[pa.array(x.astype(np.int64)) for x in sums]],
                names=["kind", "n", "types", "once", "twice"],
            )

    return run


def class_table(found: list, centroids: np.ndarray) -> Classes:
    """Classes from rows (kind, n, types, once, twice) of all types seen in training."""
    tokens = np.zeros(FIRST_CLUSTER + len(centroids))
    for r in found:
        if r.n:
            tokens[r.kind] = r.n
    once, twice = sum(r.once for r in found), float(sum(r.twice for r in found))
    unseen = once / (once + 2 * twice) if once + twice else 1.0
    unseen = min(max(unseen, 1e-3), 0.999) if once else 1.0
    return Classes(centroids, tokens, int(tokens.sum()), sum(r.types for r in found), once, unseen)


def _finder(known: np.ndarray):
    """Gives the places of tokens in sorted ``known`` hashes, which have them all; of equal ones the first.

    The first bits of a hash tell where to begin, with two beginnings a hash at least; the tokens that lie further on are looked up again.
    """
    bits = max((2 * len(known)).bit_length(), 1)
    shift = np.uint64(64 - bits)
    counts = np.bincount((known >> shift).astype(np.intp), minlength=1 << bits)
    begin = np.cumsum(counts, dtype=np.int32) - counts.astype(np.int32)

    def places(tokens: np.ndarray, steps: int = 8) -> np.ndarray:
        at = begin.take((tokens >> shift).astype(np.intp))
        left = np.flatnonzero(known.take(at, mode="clip") != tokens)
        for _ in range(steps):
            if not len(left):
                return at
            at[left] += 1
            left = left[known.take(at[left], mode="clip") != tokens[left]]
        at[left] = np.searchsorted(known, tokens[left])
        return at

    return places


def _encoder(classes: Classes):
    """Per document: counts, base score, share within classes, and its tokens as class and mark bytes."""
    scale = math.log10(classes.total + 0.1 * (classes.types + 1))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = right.column("token").to_numpy().view(np.uint64)
        signs = right.column("signs").combine_chunks()
        signs = signs.chunk(0) if isinstance(signs, pa.ChunkedArray) else signs
        counts, valid = right.column("n").to_numpy(), signs.is_valid().to_numpy(zero_copy_only=False)
        kinds = class_of(classes.centroids, known, counts, signs.fill_null(0).to_numpy(), valid)
        order = np.argsort(known)
        known, counts, kinds = known[order], counts[order], kinds[order]
        places, base, inside = _finder(known), np.log10(counts + 0.1) - scale, inside_class(counts, kinds)
        sizes = pc.fill_null(pc.binary_length(left.column("text")), 0).to_numpy().astype(np.int64)
        # a few texts at a time, so that the tokens of a whole block are never held as 64-bit words
        turn = np.cumsum(sizes) // SLICE
        edges = [0, *(np.flatnonzero(np.diff(turn)) + 1).tolist(), len(turn)]
        parts = [left.slice(a, b - a) for a, b in zip(edges, edges[1:], strict=False) if b > a]
        return pa.concat_tables([encoded(part, places, counts > 0, kinds, base, inside) for part in parts or [left]])

    def inside_class(counts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The logarithm of a type's share within its class."""
        seen_once = math.log10((1 - classes.unseen) / classes.once) if classes.once else 0.0
        share = np.log10(np.maximum(counts, 1) / np.maximum(classes.tokens[kinds], 1))
        share[kinds == END_CLASS] = 0.0
        rare = kinds == RARE
        share[rare] = np.where(counts[rare] > 0, seen_once, math.log10(classes.unseen))
        return share

    def encoded(
        left: pa.Table, places, known: np.ndarray, kind: np.ndarray, type_base: np.ndarray, type_inside: np.ndarray
    ) -> pa.Table:
        tokens, first = _tokens(left)
        n = len(tokens)
        kinds, seen, base, inside = np.empty(n, np.uint8), np.empty(n, bool), np.empty(n), np.empty(n)
        marks = np.empty(n, np.uint16)
        for a in range(0, n, SLICE):
            part = slice(a, a + SLICE)
            place = places(tokens[part])
            kinds[part], seen[part] = kind.take(place), known.take(place)
            base[part], inside[part] = type_base.take(place), type_inside.take(place)
            marks[part] = mix(tokens[part]) & np.uint64(0xFFFF)
        add = lambda x: np.add.reduceat(x, first[:-1])
        sizes = np.diff(first)
        kind_ends, mark_ends = first.astype(np.int32), (2 * first).astype(np.int32)
        binary = lambda ends, data: pa.Array.from_buffers(
            pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)]
        )
        return pa.table(
            {
                "doc_id": left.column("doc_id"),
                "train": left.column("train"),
                "part": left.column("part"),
                "n_tokens": pa.array(sizes),
                "n_known": pa.array(add(seen.astype(np.int64))),
                "base_score": pa.array(add(base)),
                "inside": pa.array(add(inside)),
                "kinds": binary(kind_ends, kinds),
                "marks": binary(mark_ends, marks),
            }
        )

    return run


_ENCODED = (
    "doc_id long, train boolean, part int, n_tokens long, n_known long, base_score double, inside double, "
    "kinds binary, marks binary"
)


def _decoded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, weight rows (tokens, 4), first token of each text)"""

    def data(name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
        column = batch.column(name)
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind), (ends - ends[0]).astype(np.int64)

    kinds, first = data("kinds", np.uint8)
    marks = np.frombuffer(data("marks", np.uint8)[0].tobytes(), np.uint16)
    at = np.arange(len(kinds)) - np.repeat(first[:-1], np.diff(first))

    def before(x: np.ndarray, k: int) -> np.ndarray:
        """The value ``k`` tokens earlier, plus one; 0 before the text."""
        out = np.zeros(len(x), np.uint32)
        out[k:] = x[:-k] + np.uint32(1) if k < len(x) else 0
        out[at < k] = 0
        return out

    words = [before(marks, k) for k in (1, 2)]
    one, two, three = (before(kinds, k) for k in (1, 2, 3))
    pair = one * np.uint32(256) + two
    rows = np.empty((len(marks), 4), np.uint16)
    for j, x in enumerate((*words, pair, pair * np.uint32(256) + three)):
        x = (x + np.uint32(j + 1)) * _SEEDS[j]
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        rows[:, j] = (x ^ (x >> np.uint32(13))) % np.uint32(ROWS) + np.uint32(ROWS if j > 1 else 0)
    return kinds, rows, first


def _scores(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Class probabilities for rows of features."""
    at = rows.T.astype(np.intp)
    z = weights.take(at[0], axis=0)
    more = np.empty_like(z)
    for row in at[1:]:
        z += weights.take(row, axis=0, out=more, mode="clip")
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _segment_sums(
    x: np.ndarray, start: np.ndarray, rounds: int = 32, at: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Sums of consecutive rows (or of the rows ``at``) from each ``start``, longest segments first: (segment, sum).

    The k-th rows of all segments are added at once; only the few long segments are finished one by one.
    """
    at = np.arange(len(x)) if at is None else at
    sizes = np.diff(start, append=len(at))
    shorter = sizes.max(initial=0) - sizes
    # a radix sort if the numbers have 16 bits
    order = np.argsort(shorter.astype(np.uint16) if shorter.max(initial=0) < 1 << 16 else shorter, kind="stable")
    first, length = start[order], sizes[order]
    total = x.take(at.take(first), axis=0)
    longer = np.searchsorted(-length, -np.arange(rounds + 1), "left").tolist()
    for k in range(1, rounds):
        n = longer[k]
        if not n:
            break
        total[:n] += x.take(at.take(first[:n] + k), axis=0)
    for i in range(longer[rounds]):
        total[i] += x.take(at[first[i] + rounds : first[i] + length[i]], axis=0).sum(axis=0)
    return order, total


def _trainer(weights: np.ndarray, bias: np.ndarray, chunks: int):
    """One pass of AdaGrad over a task's documents; yields the change of the weights in chunks, as float16."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = weights.copy(), bias.copy()
        past_w, past_b = np.full(w.shape, 1e-4, np.float32), np.full(b.shape, 1e-4, np.float32)
        held = np.empty((2, 4 * STEP, w.shape[1]), np.float32)  # space that all steps share
        seen = 0
        for batch in batches:
            if not len(batch):
                continue
            kinds, rows, _ = _decoded(batch)
            for a in range(0, len(kinds), STEP):
                kind, row = kinds[a : a + STEP], rows[a : a + STEP]
                slope = _scores(w, b, row)
                slope[np.arange(len(kind)), kind] -= 1
                slope /= len(kind)
                flat = row.ravel()
                order = np.argsort(flat, kind="stable")  # a radix sort, as the rows have 16 bits
                ids = flat[order]
                start = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
                ids = ids[start]
                place, g = _segment_sums(slope, start, at=order >> 2)
                ids = ids[place].astype(np.intp)
                past = past_w.take(ids, axis=0, out=held[0][: len(ids)], mode="clip")
                past += np.multiply(g, g, out=held[1][: len(ids)])
                past_w[ids] = past
                g *= RATE
                g /= np.sqrt(past, out=past)
                now = w.take(ids, axis=0, out=past, mode="clip")
                now -= g
                w[ids] = now
                g = slope.sum(axis=0)
                past_b += g * g
                b -= RATE * g / np.sqrt(past_b)
                seen += len(kind)
        if seen:
            change = np.concatenate([w - weights, (b - bias)[None, :]]).astype(np.float16)
            parts = np.array_split(change, chunks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(chunks), pa.int32()), pa.array([seen] * chunks, pa.int64()), pa.array([p.tobytes() for p in parts])],
                names=["chunk", "seen", "change"],
            )

    return run


def _summed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums of the changes, chunk by chunk as they come; memory holds the sums alone."""
    sums: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for chunk, seen, change in zip(*(batch.column(k).to_pylist() for k in ("chunk", "seen", "change")), strict=True):
            n, total = sums.get(chunk, (0, 0.0))
            sums[chunk] = (n + seen, total + seen * np.frombuffer(change, np.float16).astype(np.float64))
    if sums:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([n for n, _ in sums.values()], pa.int64()),
                pa.array([x.tobytes() for _, x in sums.values()]),
            ],
            names=["chunk", "seen", "change"],
        )


def fit(encoded: DataFrame, classes: Classes, rounds: int = ROUNDS, chunks: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Weights (FEATURES, classes) and bias, starting from the classes' shares of all training tokens."""
    shares = (classes.tokens + 0.5) / (classes.tokens + 0.5).sum()
    weights = np.zeros((FEATURES, classes.count), np.float32)
    bias = np.log(shares).astype(np.float32)
    for turn in range(rounds):
        share = encoded.filter(F.col("train") & (F.col("part") % rounds == turn)).select("kinds", "marks")
        changes = share.mapInArrow(_trainer(weights, bias, chunks), "chunk int, seen long, change binary")
        changes = changes.repartition(chunks, "chunk").mapInArrow(_summed_rows, "chunk int, seen long, change binary")
        # one row per chunk: FEATURES x classes numbers, whatever the corpus
        rows = sorted(changes.collect(), key=lambda r: r.chunk)
        if not rows:
            continue
        change = np.concatenate([np.frombuffer(r.change, np.float64) / r.seen for r in rows])
        change = change.reshape(FEATURES + 1, classes.count).astype(np.float32)
        weights, bias = weights + change[:-1], bias + change[-1]
    return weights, bias


def _scorer(weights: np.ndarray, bias: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            kinds, rows, first = _decoded(batch)
            logs = np.empty(len(kinds))
            for a in range(0, len(kinds), BATCH):
                p = _scores(weights, bias, rows[a : a + BATCH])
                logs[a : a + BATCH] = np.log10(p[np.arange(len(p)), kinds[a : a + BATCH]].astype(np.float64) + 1e-30)
            score = np.add.reduceat(logs, first[:-1]) + batch.column("inside").to_numpy()
            names = ["doc_id", "n_tokens", "n_known", "base_score"]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in names], pa.array(score)], names=[*names, "score"])

    return run


def _centroids(types: DataFrame) -> np.ndarray:
    """Centroids of the directions of all ``types``: of the types themselves if there are few, else of the cells of the grid."""
    few = types.limit(FEW + 1).toArrow()
    if not len(few):
        return np.empty((0, DIMS), np.float32)
    if len(few) <= FEW:
        few = few.sort_by([("n", "descending"), ("token", "ascending")])
        return fit_centroids(few.column("signs").to_numpy(), few.column("n").to_numpy())
    sums = ["weight", *_SIGNS]
    cells = types.mapInArrow(_cell_rows, "cell long, " + ", ".join(f"{c} long" for c in sums))
    # one row per cell, LEVELS ** DIMS at most whatever the corpus
    cells = cells.groupBy("cell").agg(*[F.sum(c).alias(c) for c in sums]).toArrow().sort_by("cell")
    weight, *weighted = (cells.column(c).to_numpy() / _UNITS for c in sums)
    return fit_centroids_of_cells(np.column_stack(weighted), weight)


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame, Classes]:
    """The texts as classes and marks, the distinct tokens of each block with count and direction, and the classes."""
    arrow_sized(docs.sparkSession)
    train = F.coalesce(crc_mod("doc_id", FOLDS) != HELD_OUT, F.lit(False))
    part = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(997)).cast("int"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), train.alias("train"), part.alias("part"), "text")
    kind = "doc_id long, train boolean, part int, text string, block long"
    blocks = materialize(rows.mapInArrow(_blocked_rows, kind), "blocks", "zstd")
    schema = "block long, token long, n long, " + ", ".join(f"{c} long" for c in _SIGNS)
    tokens = blocks.select("block", "train", "text").mapInArrow(_token_rows, schema)
    same = Window.partitionBy("token")
    # after the sum over blocks a token has one row per block, so no token's rows grow with its frequency
    sums = {c: F.sum(c).over(same) for c in ("n", *_SIGNS)}
    numbered = tokens.withColumns({**sums, "turn": F.row_number().over(same.orderBy("block"))}).select(
        "block", "token", "n", packed_direction().alias("signs"), (F.col("turn") == 1).alias("is_first")
    )
    looked = materialize(numbered, "token-counts", "zstd")
    types = looked.filter("is_first and n > 0").select("token", "n", "signs")
    centroids = _centroids(types.filter("signs IS NOT NULL AND n > 1").select("token", "n", "signs"))
    found = types.mapInArrow(_class_rows(centroids), "kind long, n long, types long, once long, twice long")
    found = found.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("n", "types", "once", "twice")])
    classes = class_table(found.collect(), centroids)
    pairs = blocks.groupBy("block").cogroup(looked.select("block", "token", "n", "signs").groupBy("block"))
    encoded = materialize(pairs.applyInArrow(_encoder(classes), _ENCODED), "encoded", "zstd")
    return encoded, looked, classes


def score_texts(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    encoded, _, classes = prepared(docs)
    weights, bias = fit(encoded, classes, rounds)
    scored = encoded.select("doc_id", "n_tokens", "n_known", "base_score", "inside", "kinds", "marks").mapInArrow(
        _scorer(weights, bias), "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(classes.total).cast("long"))


@query("op5_lm_scoring")
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))
    held = F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
