"""Near-duplicate documents by BagMinHash signatures of word shingles.

A document is a bag of shingles of ``SHINGLE`` words (a shorter text is one shingle); two documents are linked if the weighted
Jaccard similarity of their bags is ``SIMILARITY`` or more. A shingle's weight is cut into the levels (0,1], (1,2],
(2,4], ...; each level carries a Poisson process seeded by shingle and level, whose rate is the level's width. A
point hits a random register if it lies below the shingle's weight; a register keeps its earliest point. A process is
followed only until it is later than all registers of its document, so heavy bags cost few points per shingle, and two
registers agree with the probability of the weighted Jaccard similarity.

Bands of registers give candidates. Documents with the same words are one node from the start. A bucket is not paired
off: its hub (the node that meets most others) is compared with its members, which gives first classes. The members of a
bucket outside the class of its hub then join the hub's class in a family, where tasks compare them with all of the family by
counting shared shingles in posting lists; a family beyond ``ELEMENTS`` shingles is cut into blocks that meet pairwise. So every
candidate pair of two classes is verified, rows grow with the documents, and links inside a class are not listed. Verification counts the
overlap of the whole bags. Classes are connected components of the links, found by star contraction.

Nulls and empty texts: a row without words is in no group; its class is its own doc_id. A null doc_id is kept and never names a class
that has another doc_id. Equal rows share a class. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.bytesops import mix, packed, text_keys, windows, word_hashes, word_spans
from ledgerloom.llm.common import arrow_sized, query, table
from ledgerloom.session import materialize

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
#: Shingles of a family that one task compares with as many.
ELEMENTS = 500_000
#: Shared places counted at a time.
_AT_ONCE = 2_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 1.0 / (1 << 53)


def bags(hashes: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of each text of a batch: (text index, hash, weight), sorted by text and hash."""
    grams, text, _ = windows(hashes, first, size)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        grams = np.concatenate([grams, text_keys(hashes, first, 7)[short]])
        text = np.concatenate([text, short])
    if not len(grams):
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.concatenate([[True], (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])])
    at = np.flatnonzero(new)
    return text[at], grams[at], np.diff(np.concatenate([at, [len(grams)]]))


def _uniform(seed: np.ndarray, turn: int, what: int) -> np.ndarray:
    x = mix(seed + np.uint64((3 * turn + what + 1) * int(_GOLDEN) & (2**64 - 1)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * _UNIT


def signatures(text: np.ndarray, grams: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """BagMinHash of ``n`` bags: the earliest arrival per register, infinite for an empty bag."""
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    doc = np.repeat(text, levels)
    level = np.arange(len(doc)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0).astype(np.float64)
    width = np.where(level > 0, low, 1.0)
    bound = np.repeat(weight, levels).astype(np.float64)
    seed = mix(np.repeat(grams, levels) + level.astype(np.uint64) * _GOLDEN)
    out = np.full(n * registers, np.inf)
    time = np.zeros(len(doc))
    turn = 0
    while len(doc):
        time = time - np.log(_uniform(seed, turn, 0)) / width
        register = (_uniform(seed, turn, 1) * registers).astype(np.int64)
        inside = low + np.floor(_uniform(seed, turn, 2) * width) < bound
        np.minimum.at(out, doc[inside] * registers + register[inside], time[inside])
        if turn < 4 or turn % 8 == 0:
            last = out.reshape(n, registers).max(axis=1)
            open_ = time <= last[doc]
            doc, time, seed, low, width, bound = (x[open_] for x in (doc, time, seed, low, width, bound))
        turn += 1
    return out.reshape(n, registers)


def _batch_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    buf, offsets = packed(batch.column("text"))
    starts, ends, first = word_spans(buf, offsets)
    return word_hashes(buf, starts, ends), first


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _signed_rows(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = _batch_words(batch)
            text, grams, weight = bags(hashes, first)
            n = len(batch)
            signed = signatures(text, grams, weight, n, bands * rows)
            # an arrival time is the identity of its point; the last bits may depend on the processor
            marks = mix(signed.astype(np.float32).view(np.uint32).astype(np.uint64)).reshape(n, bands, rows)
            keys = np.zeros((n, bands), np.uint64)
            for k in range(rows):
                keys = mix(keys * _GOLDEN + marks[:, :, k])
            values = _long(keys.ravel())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    _long(text_keys(hashes, first, 1)),
                    _long(text_keys(hashes, first, 2)),
                    pa.array(np.bincount(text, weight, n).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), values),
                ],
                names=["doc_id", "text_hash", "k1", "k2", "total", "bands"],
            )

    return run


def _bag_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's bag as a sorted list of distinct longs: the j-th equal shingle counts as an element of its own."""
    for batch in batches:
        hashes, first = _batch_words(batch)
        text, grams, weight = bags(hashes, first)
        owner = np.repeat(text, weight)
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(weight) - weight, weight)
        each = mix(np.repeat(grams, weight) + turn.astype(np.uint64) * _GOLDEN)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(batch)))]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [_long(text_keys(hashes, first, 1)), _long(text_keys(hashes, first, 2)), pa.ListArray.from_arrays(pa.array(ends), _long(each))],
            names=["k1", "k2", "bag"],
        )


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links between comparable nodes: (node, root), root the least node.

    Large-star and small-star steps by turns, written to the shared folder each time, until nothing changes.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges"
    )
    before = None
    while True:
        # aggregates are written before they are joined: adaptive execution can then split the rows of a hot node
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        least = materialize(least, "least")
        # large star: neighbours above a node point to the least node around it
        large = both.join(least, both["u"] == least["c"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u != v").distinct(), "large")
        # small star: a node and its lower neighbours point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        low = materialize(low, "low")
        small = large.join(low, large["u"] == low["c"])
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(F.col("c").alias("u"), F.col("m").alias("v"))
        )
        edges = materialize(small.filter("u != v").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _same(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def _linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose bags overlap enough."""
    one = sets.select(F.col("node").alias("_a"), F.col("bag").alias("_x"))
    two = sets.select(F.col("node").alias("_b"), F.col("bag").alias("_y"))
    joined = pairs.join(one, _same("a", "_a")).join(two, _same("b", "_b"))
    common = F.size(F.array_intersect("_x", "_y"))
    joined = joined.select("a", "b", common.alias("n"), (F.size("_x") + F.size("_y")).alias("all"))
    return joined.filter(F.col("n") >= similarity * (F.col("all") - F.col("n"))).select("a", "b")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, class_id, class_size, is_first (the one to keep)."""
    spark = docs.sparkSession
    arrow_sized(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_hash().alias("text_hash"), "text")
    schema = "doc_id long, text_hash long, k1 long, k2 long, total long, bands array<long>"
    signed = materialize(texts.mapInArrow(_signed_rows(bands, rows), schema), "signatures")
    node = F.struct("k1", "k2")
    nodes = (
        signed.filter("total > 0")
        .groupBy(node.alias("node"))
        .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("total").alias("total"), F.first("bands").alias("bands"))
    )
    nodes = materialize(nodes, "nodes")
    spread = nodes.select("node", "total", F.posexplode("bands").alias("band", "mark"))
    shared = spread.groupBy("band", "mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # written before the join, as in ``components``: a bucket may be hot
    shared = materialize(shared, "shared")
    met = spread.join(shared, ["band", "mark"]).select("node", "total", F.struct("band", "mark").alias("bucket"), "n")
    met = materialize(met, "buckets")
    degree = met.groupBy(F.col("node").alias("_n")).agg(F.sum("n").alias("degree"))
    open_ = materialize(
        met.join(degree, _same("node", "_n")).select("node", "total", "bucket", "degree"), "candidates"
    )
    # the whole bags of the nodes that met another one
    owners_ = degree.join(nodes.select("node", "least"), _same("_n", "node")).select("least").distinct()
    found = texts.join(owners_, texts["doc_id"].eqNullSafe(owners_["least"]), "left_semi")
    sets = found.mapInArrow(_bag_rows, "k1 long, k2 long, bag array<long>").select(node.alias("node"), "bag")
    sets = sets.join(degree.select("_n"), _same("node", "_n"), "left_semi").dropDuplicates(["node"])
    sets = materialize(sets, "bags")
    roots = None
    if not sets.isEmpty():
        hubs = open_.groupBy(F.col("bucket").alias("h_bucket")).agg(
            F.max(F.struct("degree", "node", "total")).alias("hub")
        )
        hubs = materialize(
            hubs.select("h_bucket", F.col("hub.node").alias("h_node"), F.col("hub.total").alias("h_total")), "hubs"
        )
        pairs = open_.join(hubs, _same("bucket", "h_bucket")).filter(
            (F.col("node") != F.col("h_node"))
            & (F.least("total", "h_total") >= similarity * F.greatest("total", "h_total"))
        )
        pairs = pairs.select(F.least("node", "h_node").alias("a"), F.greatest("node", "h_node").alias("b")).distinct()
        links = materialize(_linked(pairs, sets, similarity), "links")
        more = materialize(_family_links(open_, hubs, components(links), sets, similarity), "links")
        roots = components(links.unionByName(more))
    rows_ = signed.select("doc_id", "text_hash", "total", node.alias("_node"))
    if roots is not None:
        rows_ = rows_.join(roots, _same("_node", "node"), "left")
    else:
        rows_ = rows_.withColumn("root", F.lit(None).cast("struct<k1:bigint,k2:bigint>"))
    rows_ = rows_.withColumn("root", F.when(F.col("total") > 0, F.coalesce("root", "_node")))
    rows_ = materialize(rows_.select("doc_id", "text_hash", "root"), "rooted")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    named = rows_.filter("root is not null").groupBy(F.col("root").alias("_root"))
    named = named.agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_size"))
    rows_ = rows_.join(materialize(named, "named"), _same("root", "_root"), "left")
    alone = F.col("root").isNull()
    return rows_.select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_first.doc_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("_size")).cast("long").alias("class_size"),
        (alone | (row == F.col("_first"))).alias("is_first"),
    )


def _family_links(
    open_: DataFrame, hubs: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float, elements: int = ELEMENTS
) -> DataFrame:
    """Links between classes: of the nodes that met a hub's class in a bucket, and that class."""
    names = roots.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
    of = hubs.join(names, _same("h_node", "_n"), "left").select("h_bucket", F.coalesce("_r", "h_node").alias("family"))
    named = open_.join(names, _same("node", "_n"), "left")
    named = named.select("node", "total", "bucket", F.coalesce("_r", "node").alias("root"))
    guests = named.join(of, _same("bucket", "h_bucket")).filter("root != family")
    guests = materialize(guests.select("family", "node", "root", "total", F.lit(True).alias("probe")).distinct(), "guests")
    invited = guests.select(F.col("family").alias("_f")).distinct()
    own = named.select("node", "root", "total").distinct().join(invited, _same("root", "_f"), "left_semi")
    rows = guests.unionByName(own.select(F.col("root").alias("family"), "node", "root", "total", F.lit(False).alias("probe")))
    rows = _copies(rows, elements).join(sets.select(F.col("node").alias("_s"), "bag"), _same("node", "_s"))
    flat = rows.select(
        F.col("family.k1").alias("f1"), F.col("family.k2").alias("f2"), "part.i", "part.j",
        F.col("node.k1").alias("n1"), F.col("node.k2").alias("n2"),
        F.col("root.k1").alias("r1"), F.col("root.k2").alias("r2"), "part.probe", "part.target", "bag",
    )
    key = ["f1", "f2", "i", "j"]
    found = flat.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        _family_rows(similarity), "a1 long, a2 long, b1 long, b2 long"
    )
    pair = lambda x: F.struct(F.col(f"{x}1").alias("k1"), F.col(f"{x}2").alias("k2")).alias(x)
    return found.select(pair("a"), pair("b"))


def _copies(rows: DataFrame, elements: int) -> DataFrame:
    """Rows (family, node, root, total, probe) with a ``part`` (i, j, probe, target) for each task that needs them.

    Probes are cut into blocks i, and all nodes, as what is met, into blocks j, of about ``elements`` shingles; part (i, j) holds one of each. A node
    is met once per block of probes, of which there is mostly one, and only probes go to every block of the others.
    """
    blocks = lambda total: F.greatest(F.ceil(F.coalesce(total, F.lit(0)) / elements), F.lit(1)).cast("int")
    size = rows.groupBy(F.col("family").alias("_f")).agg(
        blocks(F.sum(F.when(F.col("probe"), F.col("total")))).alias("_pi"), blocks(F.sum("total")).alias("_pj")
    )
    # written before the join: a family may be hot
    rows = rows.join(materialize(size, "sizes"), _same("family", "_f"))
    own = [F.pmod(F.xxhash64("node", F.lit(n)), F.col(f"_p{n}")).cast("int") for n in "ij"]
    part = lambda i, j, probe, target: F.struct(
        i.alias("i"), j.alias("j"), probe.alias("probe"), target.alias("target")
    )
    met = F.transform(
        F.sequence(F.lit(0), F.col("_pi") - 1), lambda x: part(x, own[1], F.col("probe") & (x == own[0]), F.lit(True))
    )
    others = F.filter(F.sequence(F.lit(0), F.col("_pj") - 1), lambda y: y != own[1])
    probes = F.transform(others, lambda y: part(own[0], y, F.lit(True), F.lit(False)))
    parts = F.when(F.col("probe"), F.concat(met, probes)).otherwise(met)
    return rows.withColumn("part", F.explode(parts)).drop("_f", "_pi", "_pj")


def _family_rows(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("f1", "f2", "i", "j")])
            size = int(batch.column("bag").offsets[-1].as_py() - batch.column("bag").offsets[0].as_py())
            if held and count + size >= ELEMENTS:
                before = np.array([held[-1].column(c)[-1].as_py() for c in ("f1", "f2", "i", "j")])
                change = np.concatenate([[(before != keys[:, 0]).any()], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
                if change.any():
                    cut = int(np.flatnonzero(change)[-1])
                    yield _compared(pa.Table.from_batches([*held, batch.slice(0, cut)]), similarity)
                    batch, held, count = batch.slice(cut), [], 0
            held.append(batch)
            count += size
        if held:
            yield _compared(pa.Table.from_batches(held), similarity)

    return run


def _compared(rows: pa.Table, similarity: float) -> pa.RecordBatch:
    """Links of whole families: of the probes with every target of their family, as a forest."""
    rows = rows.combine_chunks()
    n = rows.num_rows
    bags_ = rows.column("bag").combine_chunks()
    bags_ = bags_.chunk(0) if isinstance(bags_, pa.ChunkedArray) else bags_
    sizes = np.diff(bags_.offsets.to_numpy()).astype(np.int64)
    column = lambda c: rows.column(c).to_numpy()
    family = np.zeros(n, np.int64)
    for c in ("f1", "f2", "i", "j"):
        family[1:] |= column(c)[1:] != column(c)[:-1]
    family = np.cumsum(family)
    owner = np.repeat(np.arange(n), sizes)
    values = bags_.flatten().to_numpy().view(np.uint64)
    _, element = np.unique(mix(values + family[owner].astype(np.uint64) * _GOLDEN), return_inverse=True)
    # posting lists hold targets only
    listed = np.flatnonzero(rows.column("target").to_numpy()[owner])
    posting = listed[np.argsort(element[listed], kind="stable")]
    first = np.concatenate([[0], np.cumsum(np.bincount(element[listed], minlength=int(element.max(initial=-1)) + 1))])
    length = np.diff(first)
    probe = np.flatnonzero(rows.column("probe").to_numpy())
    begin = np.concatenate([[0], np.cumsum(sizes)])
    work = np.add.reduceat(np.concatenate([length[element], [0]]), np.minimum(begin[:-1], len(element))) * (sizes > 0)
    label = np.arange(n)
    root = mix(column("r1").view(np.uint64) + mix(column("r2").view(np.uint64)))
    a = 0
    while a < len(probe):
        b = a + 1
        total = work[probe[a]]
        while b < len(probe) and total + work[probe[b]] <= _AT_ONCE:
            total += work[probe[b]]
            b += 1
        some = probe[a:b]
        entry = np.concatenate([np.arange(begin[u], begin[u + 1]) for u in some])
        of = np.repeat(np.arange(len(some)), sizes[some])
        e = element[entry]
        times = length[e]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        other = owner[posting[np.repeat(first[e], times) + inside]]
        pair, shared = _counted(np.repeat(of, times) * n + other, len(some) * n)
        u, v = some[pair // n], pair % n
        good = (root[u] != root[v]) & (shared >= similarity * (sizes[u] + sizes[v] - shared))
        u, v = u[good], v[good]
        # only roots are hooked, and trees are flat in between, so links of earlier chunks stay in the labels
        while (open_ := label[u] != label[v]).any():
            u, v = u[open_], v[open_]
            np.minimum.at(label, np.maximum(label[u], label[v]), np.minimum(label[u], label[v]))
            while (label[label] != label).any():
                label = label[label]
        a = b
    moved = np.flatnonzero(label != np.arange(n))
    n1, n2 = column("n1"), column("n2")
    return pa.RecordBatch.from_arrays(
        [pa.array(n1[moved]), pa.array(n2[moved]), pa.array(n1[label[moved]]), pa.array(n2[label[moved]])],
        names=["a1", "a2", "b1", "b2"],
    )


def _counted(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    if bound > 8 * _AT_ONCE:
        return np.unique(keys, return_counts=True)
    counts = np.bincount(keys, minlength=bound)
    found = np.flatnonzero(counts)
    return found, counts[found]


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, that of the least doc_id; rows without words all stay."""
    found = classes(docs, similarity)
    id_, text = F.col("doc_id").cast("long").alias("_id"), _text_hash().alias("_text")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), id_, text)

    def of(which: DataFrame) -> tuple[DataFrame, Column]:
        ids = which.select(F.col("doc_id").alias("_w_id"), F.col("text_hash").alias("_w_text")).distinct()
        return ids, F.col("_id").eqNullSafe(F.col("_w_id")) & _same("_text", "_w_text")

    rows = rows.join(*of(found.filter("not is_first")), "left_anti")
    # equal rows of one class are first together: one of them stays
    firsts = found.filter("is_first and class_size > 1").groupBy("doc_id", "text_hash").count().filter("count > 1")
    single = rows.join(*of(firsts), "left_anti")
    again = rows.join(*of(firsts), "left_semi").groupBy("_id", "_text").agg(F.first("_doc").alias("_doc"))
    return single.select("_doc.*").unionByName(again.select("_doc.*"))


@query("op7_minhash_neardup")
def op7_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select("doc_id", "class_id", "class_size")
