"""Prefix trie of rebuilt conversations, as burst tries.

A conversation c is rebuilt from the first h turns of conversation c - c % 5 and its own turns after its first h, h being
crc32 of the decimal c, modulo 9. (``%`` takes the sign of c.) Each distinct sequence of first d turns is a node of depth d.

A turn's id is a hash of role and text. A conversation is cut into stretches of ``BLOCK`` turns, each a row whose
container is the trie head it hangs on: the root, or the whole sequence before the stretch. Equal suffixes of a container are one row with sums over
their conversations, made before the shuffle, so a group of copies of any size is one row. A container with more than ``HELD`` rows bursts: its rows go to containers
below a new head for each next turn id, and so on. The remaining containers are sorted and swept into nodes, one container
at a time with a stack. A node is known by its smallest member and its depth.

Subtree figures come from sums over members, in two sweeps. With T the bytes of a conversation from a node on, the sum of n_convs times bytes over
the node's subtree is the sum of T over its members. The first sweep tells which nodes each conversation owns (is the smallest member
of); the second one sums, over the members, their owned bytes and owned childless nodes. So no step walks the tree level by level.

Order of turns: by turn, null first; ties by role and text, null as empty. Repeated rows are turns of their own. Rows without conv_id are in
no conversation. Empty texts are turns of 0 bytes. A conversation of any number of turns is numbered in runs and stored in stretches. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_sized, query, table
from ledgerloom.operators.ordered import positions, running_total
from ledgerloom.session import materialize

#: Conversations in a family that may share first turns, and how many turns at most, less one.
FAMILY, SHARED = 5, 9
#: Turns of a stretch, and rows that a container may hold before it bursts.
BLOCK, HELD = 64, 200
#: Hexadecimal digits of a turn's id.
WIDTH = 32
#: Conversation numbers of one piece of a digest's text.
ENDS = 20_000


# ---- rebuilt conversations


def shared_turns(conv_id: Column) -> Column:
    """h of a conversation."""
    return (F.crc32(conv_id.cast("string")) % SHARED).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, id, bytes) of the rebuilt conversations' turns, and all conv_ids."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")]
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *[s.alias(c) for s, c in zip(said, ("role", "text"), strict=True)],
    )
    rows = positions(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "place")
    # the role's length keeps role and text apart
    mark = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.select(
        "conv_id",
        "place",
        F.substring(mark, 1, WIDTH).alias("id"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    rows = materialize(rows, "turns")
    convs = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    opening = rows.filter(F.col("place") < SHARED).groupBy(F.col("conv_id").alias("o_id"))
    opening = opening.agg(F.array_sort(F.collect_list(F.struct("place", "id", "bytes"))).alias("opening"))
    convs = convs.withColumns({"h": shared_turns(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    convs = convs.join(opening, F.col("base") == F.col("o_id"), "left")
    first = F.slice(F.coalesce("opening", F.array().cast(opening.schema["opening"].dataType)), 1, F.col("h").cast("int"))
    convs = materialize(convs.select("conv_id", "h", first.alias("first"), F.size(first).cast("long").alias("lead")), "convs")
    heads = convs.select("conv_id", F.explode("first").alias("t"))
    heads = heads.select("conv_id", F.col("t.place").alias("depth"), "t.id", "t.bytes")
    own = rows.join(convs.select("conv_id", "h", "lead"), "conv_id").filter(F.col("place") > F.col("h"))
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("lead")).alias("depth"), "id", "bytes")
    return heads.unionByName(own), convs.select("conv_id")


def stretches(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Rows (conv_id, block, head, path, sizes, rest, last) of the stretches; a turnless conversation has an empty one.

    ``head`` names the sequence before the stretch, ``path`` joins the turns' ids, ``rest`` are the bytes from its first turn to the conversation's end.
    """
    block = F.floor((F.col("depth") - 1) / BLOCK).cast("long").alias("block")
    parts = turns.groupBy("conv_id", block).agg(F.array_sort(F.collect_list(F.struct("depth", "id", "bytes"))).alias("t"))
    parts = parts.select(
        "conv_id",
        "block",
        F.array_join(F.col("t.id"), "").alias("path"),
        F.col("t.bytes").alias("sizes"),
        F.aggregate("t.bytes", F.lit(0).cast("long"), lambda a, b: a + b).alias("here"),
    )
    empty = convs.join(parts.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id",
        F.lit(0).cast("long").alias("block"),
        F.lit("").alias("path"),
        F.array().cast("array<long>").alias("sizes"),
        F.lit(0).cast("long").alias("here"),
    )
    parts = parts.unionByName(empty)
    # one row per BLOCK turns; sums of hashes that depend on the place are hashes of the sequence
    each = Window.partitionBy("conv_id").orderBy("block")
    earlier = each.rowsBetween(Window.unboundedPreceding, -1)
    later = each.rowsBetween(0, Window.unboundedFollowing)
    marks = [F.xxhash64("block", "path"), F.xxhash64("path", F.lit("second"), "block")]

    def head(number: Column, frame: WindowSpec) -> Column:
        sums = [F.coalesce(F.sum(m.cast("decimal(20,0)")).over(frame), F.lit(0)) for m in marks]
        return F.concat_ws(":", number.cast("string"), *[s.cast("string") for s in sums])

    parts = parts.select(
        "conv_id",
        "block",
        head(F.col("block"), earlier).alias("head"),
        head(F.col("block") + 1, each.rowsBetween(Window.unboundedPreceding, 0)).alias("following"),
        "path",
        "sizes",
        F.sum("here").over(later).alias("rest"),
        F.lead("block").over(each).isNull().alias("last"),
    )
    # a conversation that ends with a full stretch is still a member of the head of the next one
    stubs = parts.filter(F.col("last") & (F.size("sizes") == BLOCK)).select(
        "conv_id",
        (F.col("block") + 1).alias("block"),
        F.col("following").alias("head"),
        F.lit("").alias("path"),
        F.array().cast("array<long>").alias("sizes"),
        F.lit(0).cast("long").alias("rest"),
        F.lit(False).alias("last"),
    )
    parts = parts.drop("following").unionByName(stubs)
    return parts.withColumn("key", F.md5(F.concat_ws("|", "head", "path")))


# ---- containers


def _suffixes(parts: DataFrame) -> DataFrame:
    """The distinct stretches of each head with sums over their conversations."""
    return parts.groupBy("key").agg(
        F.first("block").alias("block"),
        F.first("head").alias("container"),
        F.first("path").alias("path"),
        F.first("sizes").alias("sizes"),
        F.count(F.lit(1)).alias("n"),
        F.sum("rest").alias("rest"),
        F.min("conv_id").alias("least"),
        F.max("last").alias("ends"),
    )


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, bytes long, rest long, ends string"


def _burst(rows: DataFrame, held: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows in containers of at most ``held`` rows, and the heads (nodes) that stand above burst ones.

    A row gets ``at``, the turns it has spent, and ``heads``, the nodes in its block above its container.
    """
    rows = rows.withColumns({"at": F.lit(0), "heads": F.array().cast("array<struct<conv_id:bigint,depth:bigint>>")})
    done, nodes = None, None
    while True:
        rows = materialize(rows, "containers")
        large = rows.groupBy("container").agg(F.count(F.lit(1)).alias("rows"), F.min("least").alias("parent"))
        large = materialize(large.filter(F.col("rows") > held).select("container", "parent"), "large")
        if large.isEmpty():
            return (rows if done is None else done.unionByName(rows)), nodes
        quiet = rows.join(large, "container", "left_anti")
        hot = rows.join(large, "container").withColumn(
            "next", F.substring(F.col("path"), F.col("at") * WIDTH + 1, F.lit(WIDTH))
        )
        # a row that is spent is a member of its head only
        spent = hot.filter(F.col("next") == "").select(*rows.columns)
        spent = spent.withColumn("container", F.concat(F.lit("spent:"), "key"))
        quiet = quiet.unionByName(spent)
        done = quiet if done is None else done.unionByName(quiet)
        hot = hot.filter(F.col("next") != "")
        stops = (F.length("path") == (F.col("at") + 1) * WIDTH) & F.col("ends")
        before = F.aggregate(F.slice("sizes", 1, F.col("at")), F.lit(0).cast("long"), lambda a, b: a + b)
        heads = hot.groupBy("container", "next").agg(
            F.min("least").alias("conv_id"),
            (F.first("block") * BLOCK + F.first("at") + 1).cast("long").alias("depth"),
            F.first("parent").alias("parent_conv_id"),
            F.sum("n").alias("n_convs"),
            F.first(F.get("sizes", F.col("at"))).alias("bytes"),
            F.sum(F.col("rest") - F.col("n") * before).alias("rest"),
            F.max(F.when(stops, F.col("key"))).alias("ends"),
        )
        heads = materialize(heads, "heads")
        found = heads.drop("container", "next")
        nodes = found if nodes is None else nodes.unionByName(found)
        above = heads.select("container", "next", F.struct("conv_id", "depth").alias("above"))
        rows = hot.join(above, ["container", "next"]).select(
            *[c for c in rows.columns if c not in ("container", "at", "heads")],
            F.md5(F.concat_ws("|", "container", "next")).alias("container"),
            (F.col("at") + 1).alias("at"),
            F.concat("heads", F.array("above")).alias("heads"),
        )


class _Sweep:
    """Nodes of one container at a time, from its rows in the order of their paths."""

    def __init__(self, sums: int):
        self.sums, self.container = sums, None
        self.stack: list[list] = []
        self.nodes: list[list] = []

    def add(self, row: dict) -> list[list]:
        """Take a row; the nodes of the container before it, if it begins a new one."""
        out = []
        if row["container"] != self.container:
            out = self.finished()
            self.container = row["container"]
            self.least, self.at, self.path = row["least"], row["at"], ""
        self.least = min(self.least, row["least"])
        path, sizes = row["path"], row["sizes"]
        depth, whole = self.at, len(path) // WIDTH
        while depth < whole and depth - self.at < len(self.stack) and self.path.startswith(path[: (depth + 1) * WIDTH]):
            depth += 1
        del self.stack[depth - self.at :]
        spent = sum(sizes[:depth])
        for d in range(depth, whole):
            # smallest member, depth, parent node, members, bytes, bytes before, key, sums
            node = [row["least"], row["block"] * BLOCK + d + 1, self.stack[-1] if self.stack else None, 0, sizes[d], spent, None]
            node += [0] * self.sums
            spent += sizes[d]
            self.stack.append(node)
            self.nodes.append(node)
        for node in self.stack:
            node[0] = min(node[0], row["least"])
            node[3] += row["n"]
            for i in range(self.sums):
                node[7 + i] += row[f"sum{i}"]
        if row["ends"] and self.stack:
            self.stack[-1][6] = row["key"]
        self.path = path
        return out

    def finished(self) -> list[list]:
        out = [[n[0], n[1], n[2][0] if n[2] else self.least, *n[3:]] for n in self.nodes]
        self.stack, self.nodes = [], []
        return out


def _node_rows(sums: int):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "bytes", "before", "ends"] + [f"sum{i}" for i in range(sums)]
    schema = pa.schema([(c, pa.string() if c == "ends" else pa.int64()) for c in names])

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep(sums)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                out += sweep.add(row)
            if out:
                yield batch_of(out)
        if rest := sweep.finished():
            yield batch_of(rest)

    return run


def _swept(rows: DataFrame, sums: list[Column]) -> DataFrame:
    """Nodes inside the containers with the sums of their rows' ``sums``."""
    arrow_sized(rows.sparkSession)
    kept = rows.select(
        *["container", "path", "block", "at", "sizes", "n", "least", "key", "ends"],
        *[s.alias(f"sum{i}") for i, s in enumerate(sums)],
    )
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, bytes long, before long, ends string"
    schema += "".join(f", sum{i} long" for i in range(len(sums)))
    dealt = kept.repartition("container").sortWithinPartitions("container", "path")
    return dealt.mapInArrow(_node_rows(len(sums)), schema)


# ---- digests of the conversations that end at a node


def _joined_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (key, conv_id) as texts of at most ``ENDS`` numbers."""
    for batch in batches:
        keys, numbers = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
        out, i = [], 0
        while i < len(keys):
            j = i
            while j < len(keys) and keys[j] == keys[i] and j - i < ENDS:
                j += 1
            out.append((keys[i], numbers[i], ",".join(map(str, numbers[i:j]))))
            i = j
        columns = zip(*out, strict=True) if out else [[], [], []]
        types = (pa.string(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "conv_id", "text"]
        )


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's texts, joined by commas; texts come in order, and only a running digest is kept."""
    key, digest = None, None
    for batch in batches:
        out = []
        for k, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.encode())
        yield _digests(out)
    if key is not None:
        yield _digests([(key, digest.hexdigest())])


def _digests(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["key", "ends_sha256"])


def _ends(parts: DataFrame) -> DataFrame:
    """key, ends_sha256: digest of the conversations whose last stretch has that key."""
    ended = parts.filter("last").select("key", "conv_id")
    runs = ended.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    runs = materialize(runs.mapInArrow(_joined_rows, "key string, conv_id long, text string"), "ends")
    return runs.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_digest_rows, "key string, ends_sha256 string")


def prefix_trie(turns: DataFrame, held: int = HELD) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    said, convs = rebuilt(turns)
    parts = materialize(stretches(said, convs), "stretches")
    rows, heads = _burst(_suffixes(parts), held)
    rows = materialize(rows, "suffixes")
    nodes = _swept(rows, [F.col("rest")])
    nodes = nodes.withColumn("rest", F.col("sum0") - F.col("n_convs") * F.col("before")).drop("sum0", "before")
    if heads is not None:
        nodes = nodes.unionByName(heads)
    first = rows.filter(F.col("block") == 0)
    root = first.agg(
        F.min("least").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.sum("n").alias("n_convs"),
        F.lit(0).cast("long").alias("bytes"),
        F.sum("rest").alias("rest"),
        F.max(F.when(F.col("path") == "", F.col("key"))).alias("ends"),
    ).filter(F.col("conv_id").isNotNull())
    nodes = materialize(nodes.unionByName(root), "nodes")

    children = nodes.filter(F.col("depth") > 0).groupBy(
        F.col("parent_conv_id").alias("c_id"), (F.col("depth") - 1).alias("c_depth")
    )
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    met = (nodes["conv_id"] == children["c_id"]) & (nodes["depth"] == children["c_depth"])
    nodes = nodes.join(children, met, "left").drop("c_id", "c_depth")
    nodes = materialize(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "counted")

    # what each conversation owns, summed over the members of each node
    owned = nodes.groupBy("conv_id").agg(
        F.sum("bytes").alias("o_bytes"), F.count_if(F.col("n_children") == 0).cast("long").alias("o_leaves")
    )
    weights = parts.select("conv_id", "key").join(owned, "conv_id").groupBy("key")
    weights = weights.agg(F.sum("o_bytes").alias("o_bytes"), F.sum("o_leaves").alias("o_leaves"))
    rows = materialize(rows.join(weights, "key", "left").fillna(0, ["o_bytes", "o_leaves"]), "weighed")
    sums = _swept(rows, [F.col("o_bytes"), F.col("o_leaves")]).select("conv_id", "depth", "sum0", "sum1")
    above = rows.select(F.explode("heads").alias("a"), "o_bytes", "o_leaves").groupBy("a.conv_id", "a.depth")
    whole = rows.filter(F.col("block") == 0)
    tops = whole.agg(F.min("least").alias("conv_id"), F.sum("o_bytes").alias("sum0"), F.sum("o_leaves").alias("sum1"))
    sums = sums.unionByName(above.agg(F.sum("o_bytes").alias("sum0"), F.sum("o_leaves").alias("sum1")))
    sums = sums.unionByName(tops.withColumn("depth", F.lit(0).cast("long")))
    sums = sums.select(F.col("conv_id").alias("s_id"), F.col("depth").alias("s_depth"), "sum0", "sum1")
    upto = running_total(nodes, ["conv_id"], ["depth"], "bytes", "upto")
    upto = upto.select(F.col("conv_id").alias("u_id"), F.col("depth").alias("u_depth"), "upto")
    ends = _ends(parts).withColumnRenamed("key", "e_key")
    out = nodes.join(sums, (nodes["conv_id"] == sums["s_id"]) & (nodes["depth"] == sums["s_depth"]))
    out = out.join(upto, (F.col("conv_id") == F.col("u_id")) & (F.col("depth") == F.col("u_depth")))
    out = out.join(ends, F.col("ends") == F.col("e_key"), "left")
    earlier = F.col("upto") - F.col("bytes")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("sum1").cast("long").alias("n_leaves"),
        (F.col("rest") - (F.col("sum0") - earlier)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


@query("op12_prefix_trie")
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
