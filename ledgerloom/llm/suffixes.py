"""Removal of byte strings that occur twice, by bucket-pointer refinement on chosen suffixes.

Every string of ``LENGTH`` bytes that occurs at two places must be found. A string belongs to its gram of ``Q`` bytes with
the least hash, the anchor, so equal strings have equal anchors at equal offsets; neighbouring strings mostly share
one. Only anchors are shuffled, about one in 80 bytes, each with the stretch its strings cover. They fall into initial
buckets by gram. Sorted by bucket and stretch, an anchor beside an equal stretch needs no more work: all its strings recur. Buckets of
different stretches are refined: strings whose common core (``LENGTH - CORE + 1`` bytes) is alone drop out; the others get
bucket numbers at depth ``LENGTH / 4``, then by the pair (own bucket, bucket of the later half) at twice that depth, and so again.
The sort is a range sort, so a bucket of any size is spread; what stands at a range's edge counts as different. A bucket with more
than ``HOT`` different stretches is refined by a distributed count instead.

Matches never cross documents, may lie in one document, and may overlap. Nulls: a null text is empty; a null doc_id is
kept. Equal rows are repeats of each other, as any two documents of equal text are. Texts shorter than ``LENGTH`` bytes never match;
very long ones are worked in slices. An empty table gives an empty result. Other columns are carried along as they are, whatever their names, but for ``spans``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import _BASE, _CODES, SLICE, mix, packed
from ledgerloom.llm.common import arrow_sized, discard, keyed, query, table, unused
from ledgerloom.session import materialize

#: Length of the strings that may occur once only, and of the grams that anchor them; both in bytes.
LENGTH = 200
Q = 40
#: Strings whose offsets to the anchor fall into one part of this width have a common core.
CORE = 40
#: Buckets with more different stretches than this are not refined inside one task.
HOT = 20_000
#: Stretches that one refinement handles, unless a single bucket has more.
AT_ONCE = 8_000
#: Bits that hold a place inside a slice.
_PLACE = np.uint64(22)

_inverse = pow(int(_BASE), -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["up"]) < n:
        for name, base in (("up", int(_BASE)), ("down", _inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["up"][:n], _tables["down"][:n]


class _Hashes:
    """Hashes of any stretch of a buffer, from one pass over it."""

    def __init__(self, buf: np.ndarray):
        up, self.down = _powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_CODES[buf] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def _running(values: np.ndarray, width: int, pick: np.ufunc, fill: int) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours, by running values inside blocks of that width."""
    n = len(values)
    rows = -(-n // width)
    grid = np.full(rows * width, fill, np.uint64)
    grid[:n] = values
    grid = grid.reshape(rows, width)
    ahead = pick.accumulate(grid, axis=1).ravel()
    back = np.ascontiguousarray(pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).ravel()
    return pick(back[: n - width + 1], ahead[width - 1 : n])


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, q: int = Q) -> tuple[np.ndarray, ...]:
    """Anchors of a batch with their strings: (text index, place of the anchor, start and end of the stretch, gram, stretch hash)."""
    found = []
    for a in range(0, len(buf), SLICE):
        b = min(len(buf), a + SLICE)
        hi = min(len(buf), b + length - 1)
        if hi - a < length:
            continue
        hashes = _Hashes(buf[a:hi])
        at = np.arange(hi - a - q + 1)
        grams = hashes.of(at, at + q)
        # the least hash, of equal ones the first place
        least = _running(((grams >> _PLACE) << _PLACE) | at.astype(np.uint64), length - q + 1, np.minimum, 2**64 - 1)
        starts = np.arange(min(len(least), b - a))
        ends = np.repeat(offsets[1:], np.diff(np.clip(offsets, a, a + len(starts))))
        starts = starts[starts + a + length <= ends]
        if not len(starts):
            continue
        place = (least[starts] & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
        new = np.concatenate([[True], place[1:] != place[:-1]])
        first = np.flatnonzero(new)
        start, place = starts[first], place[first]
        end = starts[np.concatenate([first[1:] - 1, [len(starts) - 1]])] + length
        form = ((place - start) * 4096 + end - place).astype(np.uint64)
        text = np.searchsorted(offsets, start + a, "right") - 1
        found.append((text, place + a, start + a, end + a, grams[place], mix(hashes.of(start, end) + mix(form))))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _buckets(hashes: _Hashes, at: np.ndarray, depth: int, base: int) -> np.ndarray:
    """Bucket numbers of suffixes by their first ``depth`` bytes, from the buckets of both halves."""
    if depth <= base:
        return np.unique(hashes.of(at, at + depth), return_inverse=True)[1]
    half = (depth + 1) // 2
    halves = _buckets(hashes, np.concatenate([at, at + depth - half]), half, base)
    key = halves[: len(at)] * np.int64(2 * len(at)) + halves[len(at) :]
    return np.unique(key, return_inverse=True)[1]


def refined(
    buf: np.ndarray, offsets: np.ndarray, left: np.ndarray, start: np.ndarray, key: np.ndarray, length: int = LENGTH
) -> np.ndarray:
    """Which places of stretches start a string that also starts at another place of the corpus.

    ``left`` is the anchor's offset in its stretch; ``start`` and ``key`` give the stretch's place and document.
    """
    out = np.zeros(len(buf), bool)
    if not len(buf):
        return out
    hashes = _Hashes(buf)
    counts = np.diff(offsets) - length + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    back = left[owner] - inside
    part = back // CORE
    head = (inside == 0) | (back % CORE == CORE - 1)
    anchor = (offsets[:-1] + left)[owner[head]]
    low = anchor - CORE * part[head]
    core = mix(hashes.of(low, low + length - CORE + 1) + part[head].astype(np.uint64))
    _, same, times = np.unique(core, return_inverse=True, return_counts=True)
    stays = (times[same] > 1)[np.cumsum(head) - 1]
    owner, inside = owner[stays], inside[stays]
    at = offsets[owner] + inside
    if len(at):
        bucket = _buckets(hashes, at, length, -(-length // 4))
        place = mix(key[owner] + mix((start[owner] + inside).astype(np.uint64)))
        n = int(bucket.max()) + 1
        least, most = np.full(n, 2**64 - 1, np.uint64), np.zeros(n, np.uint64)
        np.minimum.at(least, bucket, place)
        np.maximum.at(most, bucket, place)
        out[at] = least[bucket] != most[bucket]
    return out


def _runs(flags: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, start, end) of what the flagged starts cover, in places of each text."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    text = np.searchsorted(offsets, at, "right") - 1
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(text) != 0)])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])
    owner = text[new]
    return owner, at[new] - offsets[owner], at[last] - offsets[owner] + length


_ANCHOR = "doc_id long, key long, start long, left int, size int, gram long, around long"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        buf, offsets = packed(batch.column("text"))
        text, place, start, end, gram, around = anchors(buf, offsets)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(text)),
                batch.column("key").take(pa.array(text)),
                pa.array(start - offsets[text]),
                pa.array((place - start).astype(np.int32)),
                pa.array((end - start).astype(np.int32)),
                pa.array(gram.view(np.int64)),
                pa.array(around.view(np.int64)),
            ],
            names=["doc_id", "key", "start", "left", "size", "gram", "around"],
        )


def _neighbour_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of anchors sorted by gram and stretch: those beside an equal stretch (full), or beside a different one of their bucket (wanted)."""
    held, before = None, None
    for batch in batches:
        if not len(batch):
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        out, before = _judged(rows, before, False)
        held = rows.slice(len(rows) - 1).to_batches()[0]
        yield out
    if held is not None:
        yield _judged(pa.Table.from_batches([held]), before, True)[0]


def _judged(rows: pa.Table, before: tuple[int, int] | None, last: bool) -> tuple[pa.RecordBatch, tuple[int, int]]:
    """Judge all rows but the last one, which still lacks its next row (``last``: there is none)."""
    gram, around = rows.column("gram").to_numpy(), rows.column("around").to_numpy()
    n = len(gram) if last else len(gram) - 1
    near = np.concatenate([[before is not None and before[0] == gram[0]], gram[1:] == gram[:-1], [False]])
    same = near & np.concatenate([[before is not None and before[1] == around[0]], around[1:] == around[:-1], [False]])
    edge = np.zeros(len(gram) + 1, bool)
    edge[0] = before is None
    edge[-1] = last
    full = same[:-1] | same[1:]
    differs = (near & ~same) | edge
    wanted = differs[:-1] | differs[1:]
    pick = np.flatnonzero((full | wanted)[:n])
    chosen = rows.take(pa.array(pick)).drop_columns(["around"])
    chosen = chosen.append_column("full", pa.array(full[pick])).append_column("wanted", pa.array(wanted[pick]))
    previous = (int(gram[n - 1]), int(around[n - 1])) if n else before
    return chosen.combine_chunks().to_batches()[0] if len(pick) else _nothing(chosen), previous


def _nothing(table_: pa.Table) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in table_.schema], schema=table_.schema)


def _around_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes at each wanted place: one row per element of ``wanted``."""
    for batch in batches:
        buf, offsets = packed(batch.column("text"))
        wanted = batch.column("wanted")
        row = np.repeat(np.arange(len(batch)), np.diff(wanted.offsets.to_numpy()))
        parts = {f.name: c for f, c in zip(wanted.type.value_type, wanted.flatten().flatten(), strict=True)}
        start = parts["start"].to_numpy()
        size = parts["size"].to_numpy()
        raw = buf.tobytes()
        begin = start + offsets[row]
        pieces = [raw[x : x + n] for x, n in zip(begin.tolist(), size.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(row)),
                batch.column("key").take(pa.array(row)),
                parts["start"],
                parts["left"],
                parts["gram"],
                pa.array(pieces, pa.binary()),
            ],
            names=["doc_id", "key", "start", "left", "gram", "piece"],
        )


_SPAN = "doc_id long, key long, lo long, hi long"


def _spans(rows: pa.Table, flags: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    owner, lo, hi = _runs(flags, offsets, LENGTH)
    start = rows.column("start").to_numpy()[owner]
    take = pa.array(owner)
    column = lambda name: rows.column(name).take(take).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [column("doc_id"), column("key"), pa.array(start + lo), pa.array(start + hi)],
        names=["doc_id", "key", "lo", "hi"],
    )


def _flat(pieces: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in pieces.to_pylist()], np.int64)
    return np.frombuffer(b"".join(pieces.to_pylist()), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _refine(rows: pa.Table) -> pa.RecordBatch:
    buf, offsets = _flat(rows.column("piece"))
    left, start = (rows.column(n).to_numpy().astype(np.int64) for n in ("left", "start"))
    key = rows.column("key").to_numpy().view(np.uint64)
    return _spans(rows, refined(buf, offsets, left, start, key), offsets)


def _refined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Refine whole buckets, which come one after the other; many small ones together."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        gram = batch.column("gram").to_numpy()
        if count + len(gram) >= AT_ONCE and len(gram):
            previous = held[-1].column("gram")[-1].as_py() if held else None
            change = np.concatenate([[previous is not None and previous != gram[0]], np.diff(gram) != 0])
            if change.any():
                cut = int(np.flatnonzero(change)[-1])
                held.append(batch.slice(0, cut))
                yield _refine(pa.Table.from_batches(held))
                batch, held, count = batch.slice(cut), [], 0
        held.append(batch)
        count += len(batch)
    if count:
        yield _refine(pa.Table.from_batches(held))


def _string_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each string through an anchor as a row, for buckets too large for one task."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        buf, offsets = _flat(rows.column("piece"))
        owner = np.repeat(np.arange(len(batch)), np.diff(offsets))
        at = np.flatnonzero(np.arange(len(buf)) + LENGTH <= offsets[owner + 1])
        owner = owner[at]
        inside = at - offsets[owner]
        take = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(take),
                batch.column("key").take(take),
                pa.array(rows.column("start").to_numpy()[owner] + inside),
                batch.column("gram").take(take),
                pa.array((rows.column("left").to_numpy()[owner] - inside).astype(np.int32)),
                pa.array(_Hashes(buf).of(at, at + LENGTH).view(np.int64)),
            ],
            names=["doc_id", "key", "lo", "gram", "offset", "string"],
        )


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per document with repeated strings: doc_id, key (see ``keyed``), spans (not merged)."""
    arrow_sized(docs.sparkSession)
    texts = keyed(docs.select("doc_id", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_key").alias("key"), "text")
    chosen = materialize(texts.mapInArrow(_anchor_rows, _ANCHOR), "anchors")
    order = ["gram", "around", "key", "start"]
    sorted_ = chosen.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = materialize(
        sorted_.mapInArrow(
            _neighbour_rows,
            "doc_id long, key long, start long, left int, size int, gram long, full boolean, wanted boolean",
        ),
        "neighbours",
    )
    discard(chosen)
    end = (F.col("start") + F.col("size")).alias("hi")
    spans = marked.filter("full").select("doc_id", "key", F.col("start").alias("lo"), end)
    mixed = marked.filter("wanted")
    wanted = mixed.groupBy(F.col("doc_id").alias("w_id"), F.col("key").alias("w_key")).agg(
        F.collect_set(F.struct("start", "left", "size", "gram")).alias("wanted")
    )
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["w_id"]) & (texts["key"] == wanted["w_key"]))
    pieces = found.select("doc_id", "key", "text", "wanted").mapInArrow(
        _around_rows, "doc_id long, key long, start long, left int, gram long, piece binary"
    )
    large = mixed.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("gram")
    large = materialize(large, "large-buckets")
    usual = pieces
    if not large.isEmpty():
        usual = pieces.join(large, "gram", "left_anti")
        strings = pieces.join(large, "gram", "left_semi").mapInArrow(
            _string_rows, "doc_id long, key long, lo long, gram long, offset int, string long"
        )
        strings = materialize(strings, "strings")
        spot = F.struct("key", "lo")
        twice = (
            strings.groupBy("gram", "offset", "string")
            .agg(F.min(spot).alias("a"), F.max(spot).alias("b"))
            .filter("a != b")
            .select("gram", "offset", "string")
        )
        more = strings.join(twice, ["gram", "offset", "string"])
        spans = spans.unionByName(more.select("doc_id", "key", "lo", (F.col("lo") + LENGTH).alias("hi")))
    ordered = usual.repartition("gram").sortWithinPartitions("gram")
    spans = spans.unionByName(ordered.mapInArrow(_refined_rows, _SPAN))
    return spans.groupBy("doc_id", "key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def _merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.concatenate([[True], lo[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])
    return lo[new], reach[last]


def _cuts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Each text of a batch with its merged spans."""
    buf, offsets = packed(batch.column("text"))
    raw = buf.tobytes()
    spans = batch.column("spans")
    bounds = spans.offsets.to_numpy()
    lo, hi = (x.to_numpy() for x in spans.values.flatten())
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        x, y = bounds[i], bounds[i + 1]
        if x == y:
            yield raw[a:b], []
        else:
            los, his = _merged(lo[x:y], hi[x:y])
            yield raw[a:b], list(zip(los.tolist(), his.tolist(), strict=True))


def _left(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for cut in cuts for x in cut), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(t, c, _left(t, c)) for t, c in _cuts(batch)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(t) for t, _, _ in rows], pa.int64()),
                pa.array([len(t) - len(k) for t, _, k in rows], pa.int64()),
                pa.array([len(c) for _, c, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for _, _, k in rows], pa.string()),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _cleaned_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text; a character that loses one of its bytes goes as a whole."""
    for batch in batches:
        texts = [_left(t, c).decode("utf-8", "ignore") if c else t.decode() for t, c in _cuts(batch)]
        new = pa.array(texts, pa.string())
        new = pa.compute.if_else(pa.compute.is_null(batch.column("text")), pa.scalar(None, pa.string()), new)
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", new).drop_columns(["spans"])


def with_spans(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its repeated ``spans`` (empty if none)."""
    name = unused(docs, "_key")
    rows, spans = keyed(docs, name), repeated_spans(docs).withColumnRenamed("doc_id", "_s_id").withColumnRenamed("key", "_s_key")
    met = rows["doc_id"].eqNullSafe(spans["_s_id"]) & (rows[name] == spans["_s_key"])
    kind = "array<struct<lo:bigint,hi:bigint>>"
    none = F.array().cast(kind)
    return rows.join(spans.withColumnRenamed("spans", "_spans"), met, "left").select(
        *[rows[f"`{c}`"] for c in docs.columns if c != "spans"], F.coalesce("_spans", none).cast(kind).alias("spans")
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the bytes that repeated strings cover; a column named spans is dropped."""
    rows = with_spans(docs)
    schema = rows.drop("spans").schema
    return rows.mapInArrow(_cleaned_rows, schema)


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_spans(docs).mapInArrow(
        _digest_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
