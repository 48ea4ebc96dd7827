"""The block paths against pandas on data with one very hot key."""

from __future__ import annotations

import random
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom import session as S
from ledgerloom.operators import joins as J
from ledgerloom.operators import ordered as O


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    keys = ["hot"] * 120 + [f"k{rng.randrange(25)}" for _ in range(80)] + [None] * 20
    return [
        (i, k, rng.randrange(60), rng.choice([None, None, rng.randrange(9)]), rng.randrange(100))
        for i, k in enumerate(keys)
    ]


@pytest.fixture
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, t int, sparse int, v int").repartition(5)


@pytest.fixture(scope="module")
def pdf(rows):
    p = pd.DataFrame(rows, columns=["id", "k", "t", "sparse", "v"])
    p["k"] = p["k"].fillna("<null>")
    return p.sort_values(["k", "t", "id"]).reset_index(drop=True)


def order():
    return [F.col("t"), F.col("id")]


def by_id(df, column):
    return {r["id"]: r[column] for r in df.select("id", column).collect()}


@pytest.mark.parametrize("big", [False, True])
class TestBothPaths:
    @pytest.fixture(autouse=True)
    def _size(self, request, big):
        if big:
            request.getfixturevalue("large")

    def test_positions(self, df, pdf, big):
        want = dict(zip(pdf["id"], pdf.groupby("k").cumcount() + 1))
        assert by_id(O.positions(df, ["k"], order()), "pos") == want

    def test_global_positions(self, df, pdf, big):
        p = pdf.sort_values(["t", "id"]).reset_index(drop=True)
        assert by_id(O.positions(df, [], order()), "pos") == dict(zip(p["id"], p.index + 1))

    def test_fill_forward(self, df, pdf, big):
        filled = pdf.groupby("k")["sparse"].ffill()
        want = {i: None if pd.isna(x) else int(x) for i, x in zip(pdf["id"], filled)}
        assert by_id(O.fill_forward(df, ["k"], order(), {"sparse": "last"}), "last") == want

    def test_neighbours(self, df, pdf, big):
        def add(w):
            return {
                "before": F.lag("v", 2).over(w),
                "after": F.lead("v", 1).over(w),
                "roll": F.sum("v").over(w.rowsBetween(-6, 0)),
            }

        out = O.over_neighbours(df, ["k"], order(), add, before=6, after=1)
        g = pdf.groupby("k")["v"]
        none = lambda s: {i: None if pd.isna(x) else int(x) for i, x in zip(pdf["id"], s)}
        assert by_id(out, "before") == none(g.shift(2))
        assert by_id(out, "after") == none(g.shift(-1))
        rolled = g.rolling(7, min_periods=1).sum().reset_index(level=0, drop=True)
        assert by_id(out, "roll") == none(rolled)

    def test_running_total_shares_ties(self, df, pdf, big):
        out = O.running_total(df, ["k"], ["t"], "v", "total")
        got = {(r["k"] or "<null>", r["t"]): r["total"] for r in out.collect()}
        sums = pdf.groupby(["k", "t"])["v"].sum().groupby(level=0).cumsum()
        assert got == {key: int(x) for key, x in sums.items()}

    def test_ranks(self, df, pdf, big):
        out = O.attach_ranks(df, ["k"], ["t"])
        g = pdf.groupby("k")["t"]
        assert by_id(out, "rank") == {i: int(x) for i, x in zip(pdf["id"], g.rank(method="min"))}
        assert by_id(out, "dense_rank") == {i: int(x) for i, x in zip(pdf["id"], g.rank(method="dense"))}

    def test_group_values(self, df, pdf, big):
        out = O.attach_group(df, ["k"], {"n": F.count(F.lit(1))})
        assert by_id(out, "n") == dict(zip(pdf["id"], pdf.groupby("k")["id"].transform("count")))

    def test_asof(self, df, spark, rows, big):
        points = spark.createDataFrame([(k, p) for k in ("hot", "k1", "none") for p in (-1, 10, 30, 70)], "k string, p int")
        out = J.asof_join(points, df, ["k"], "p", "t", ["v"], tie=["id"], keep_unmatched=True)
        want = set()
        for k in ("hot", "k1", "none"):
            for p in (-1, 10, 30, 70):
                seen = [r for r in rows if r[1] == k and r[2] <= p]
                want.add((k, p, max(seen, key=lambda r: (r[2], r[0]))[4] if seen else None))
        assert {tuple(r) for r in out.collect()} == want

    def test_bands(self, spark, big):
        bands = spark.createDataFrame([(0.0, 9.5, "a"), (8.0, 20.0, "b"), (30.0, 30.0, "c")], "lo double, hi double, label string")
        values = [-1.0, 0.0, 8.5, 9.5, 15.0, 20.0, 30.0, 31.0, None]
        out = J.band_join(spark.createDataFrame([(v,) for v in values], "x double"), bands, "x", "lo", "hi", ["label"])
        got = sorted((str(r["x"]), str(r["label"])) for r in out.collect())
        want = []
        for v in values:
            hits = [] if v is None else [n for lo, hi, n in [(0, 9.5, "a"), (8, 20, "b"), (30, 30, "c")] if lo <= v <= hi]
            want += [(str(v), n) for n in hits or ["None"]]
        assert got == sorted(want)

    def test_merge_chain(self, spark, big):
        edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "s long, v long")
        out = J.merge_chain(edges, "s", "v", depth=3)
        assert {(r["survivor"], r["victim"], r["depth"]) for r in out.collect()} == {
            (1, 2, 1), (2, 3, 1), (3, 4, 1), (9, 8, 1), (1, 3, 2), (2, 4, 2), (1, 4, 3),
        }

    def test_merge_chain_stops_on_a_cycle(self, spark, big):
        edges = spark.createDataFrame([(1, 2), (2, 1)], "s long, v long")
        assert J.merge_chain(edges, "s", "v", depth=10).count() == 20


@pytest.mark.parametrize("big", [False, True])
def test_running_total_before_the_first_value(spark, request, big):
    if big:
        request.getfixturevalue("large")
    rows = [(k, t, None if t < 3 else t) for k in ("hot", "cold") for t in range(40 if k == "hot" else 5)]
    out = O.running_total(spark.createDataFrame(rows, "k string, t int, v long"), ["k"], ["t"], "v", "total")
    got = {(r.k, r.t): r.total for r in out.collect()}
    assert got == {(k, t): None if t < 3 else sum(range(3, t + 1)) for k, t, _ in rows}


def test_an_exploded_input_is_not_small(spark):
    df = spark.range(10)
    assert S.is_small(df)
    many = df.select(F.explode(F.sequence(F.lit(1), F.lit(10**8))).alias("x"))
    assert not S.is_small(many) and not S.may_broadcast(many)


def test_merge_chain_reports_what_is_open(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(130)], "s long, v long")
    chain = J.merge_chain(edges, "s", "v", depth=3)
    assert J.open_chains(chain, edges, "s", "v", 3).count() == 130 - 3
    small = edges.filter("s < 3")
    assert J.open_chains(J.merge_chain(small, "s", "v", depth=3), small, "s", "v", 3).isEmpty()


def test_merge_chain_deeper_than_a_hundred(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(104)], "s long, v long")
    chain = J.merge_chain(edges, "s", "v", depth=103)
    assert chain.agg(F.max("depth")).first()[0] == 103


def test_asof_matches_no_null(spark):
    events = spark.createDataFrame([("a", None, 1), (None, 1, 2), ("a", 5, 3)], "k string, t int, v int")
    points = spark.createDataFrame([("a", 4), ("a", 6), ("a", None), (None, 9)], "k string, p int")
    out = J.asof_join(points, events, ["k"], "p", "t", ["v"], tie=["v"], keep_unmatched=True)
    assert {tuple(r) for r in out.collect()} == {("a", 4, None), ("a", 6, 3), ("a", None, None), (None, 9, None)}
    with pytest.raises(ValueError):
        J.asof_join(points, events, ["k"], "p", "t", ["v"], tie=[])


def test_bands_with_an_open_end(spark, large):
    bands = spark.createDataFrame([(float(i), i + 0.9 if i < 999 else 9.99e11, i) for i in range(1000)], "lo double, hi double, n int")
    values = [(0.5,), (500.2,), (500.95,), (999.5,), (8e11,), (None,)]
    out = J.band_join(spark.createDataFrame(values, "x double"), bands, "x", "lo", "hi", ["n"])
    assert {(r.x, r.n) for r in out.collect()} == {(0.5, 0), (500.2, 500), (500.95, None), (999.5, 999), (8e11, 999), (None, None)}


def test_proximity_join_refuses_outer_right(spark):
    a = spark.range(1).withColumn("t", F.current_timestamp())
    b = a.toDF("i", "u")
    for how in ("right", "full", "full_outer"):
        with pytest.raises(ValueError):
            J.proximity_join(a, b, [("id", "i")], "t", "u", 5, how)


def test_proximity_join_against_brute_force(spark):
    rng = random.Random(3)
    a = [(i, rng.choice("xy"), rng.randrange(400)) for i in range(60)]
    b = [(i, rng.choice("xy"), rng.randrange(400)) for i in range(60)]
    frame = lambda rows, p: spark.createDataFrame(rows, f"{p}id int, {p}k string, {p}s int").withColumn(
        f"{p}t", F.timestamp_seconds(F.col(f"{p}s") + 1700000000).cast("timestamp_ntz")
    )
    for n in (0, 1, 7, 50):
        out = J.proximity_join(frame(a, "a"), frame(b, "b"), [("ak", "bk")], "at", "bt", n)
        got = sorted((r["aid"], r["bid"]) for r in out.collect())
        assert got == sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and abs(x[2] - y[2]) <= n)


@pytest.mark.parametrize(
    "listed, want",
    [([], {1, 2, None}), ([1], {2}), ([1, None], set()), ([None], set()), ([5], {1, 2})],
)
def test_not_in(spark, listed, want):
    left = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    right = spark.createDataFrame([(v,) for v in listed], "y int")
    assert {r["x"] for r in J.not_in(left, right, "x", "y").collect()} == want


def test_a_job_removes_its_scratch(spark):
    with S.job_scratch(spark):
        stored = S.materialize(spark.range(5), "step")
        folder = stored.inputFiles()[0].removeprefix("file://").rsplit("/", 2)[0]
        assert stored.count() == 5 and Path(folder).exists()
    assert not Path(folder).exists()
    assert "job-" not in S.scratch_path(spark, "x")


def test_a_local_checkpoint_folder_is_refused_on_a_cluster(spark, monkeypatch):
    class Cluster:
        conf = spark.conf
        sparkContext = type("C", (), {"master": "spark://host:7077", "getConf": spark.sparkContext.getConf, "_jsc": spark.sparkContext._jsc})

    monkeypatch.setattr(Cluster, "conf", {"spark.checkpoint.dir": "file:/tmp/x"})
    with pytest.raises(ValueError, match="one machine"):
        S.shared_dir(Cluster)
    monkeypatch.setattr(Cluster, "conf", {"spark.checkpoint.dir": "file:/mnt/x", "spark.ledgerloom.sharedMount": "true"})
    assert S.shared_dir(Cluster) == "file:/mnt/x"
    monkeypatch.setattr(Cluster, "conf", {"spark.checkpoint.dir": "hdfs://n/x/"})
    assert S.shared_dir(Cluster) == "hdfs://n/x"


class _Cluster:
    """The test session as if it ran on a cluster with the given settings."""

    def __init__(self, spark, conf):
        context = spark.sparkContext
        self.conf, self.range, self.read = conf, spark.range, spark.read
        self.sparkContext = type("C", (), {
            "master": "spark://host:7077", "getConf": lambda: {}, "_jsc": context._jsc, "_jvm": context._jvm,
            "applicationId": context.applicationId, "defaultParallelism": context.defaultParallelism,
        })


def test_a_file_checkpoint_folder_that_executors_share_is_taken_on_a_cluster(spark, tmp_path):
    shared = f"file:{tmp_path}/kept"
    assert S.shared_dir(_Cluster(spark, {"spark.checkpoint.dir": shared + "/"})) == shared
    assert not list(Path(tmp_path).rglob("*.parquet"))


def test_a_cluster_without_checkpoint_folder_uses_the_warehouse(spark, tmp_path):
    shared = f"file:{tmp_path}/warehouse"
    assert S.shared_dir(_Cluster(spark, {"spark.sql.warehouse.dir": shared})) == shared


def test_folders_in_which_the_driver_misses_rows_of_executors_are_refused(spark, tmp_path):
    """The rows of some tasks stay on the disk of their executor."""
    lost = _Cluster(spark, {"spark.checkpoint.dir": f"file:{tmp_path}/own"})
    lost.range = lambda a, n, step, parts: spark.range(a, n - 1, step, parts)
    with pytest.raises(ValueError, match="one machine"):
        S.shared_dir(lost)
    lost.conf = {"spark.sql.warehouse.dir": f"file:{tmp_path}/own2"}
    with pytest.raises(ValueError, match="one machine"):
        S.shared_dir(lost)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(5, 100), (5, 100)], "s long, v long")
    written = []
    write = J.materialize
    monkeypatch.setattr(J, "materialize", lambda df, label: written.append(label) or write(df, label))
    chain = J.merge_chain(edges, "s", "v", depth=64)
    want = {(i, j, j - i): 1 for i in range(71) for j in range(i + 1, min(70, i + 64) + 1)} | {(i, 100, 6 - i): 2 for i in range(6)}
    assert {(r.survivor, r.victim, r.depth): r["count"] for r in chain.groupBy("survivor", "victim", "depth").count().collect()} == want
    assert len(written) == 7
