"""Stored tables: versions, appends of runs, changes of single partitions, layout, and proven sizes."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerloom import session as S
from ledgerloom.operators import changes as C
from ledgerloom.operators import ordered as O
from ledgerloom.sources import tables as W


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    """Data files below a folder with their times."""
    out = {}
    for folder, _, names in os.walk(path):
        out.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return out


# ---- versions


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["_switch", "_tidy"])
def test_a_reader_sees_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    W.swap_in(spark.range(3), path)
    reader = W.read_table(spark, path)

    def lost(*args):
        raise Lost

    with monkeypatch.context() as m:
        m.setattr(W, step, lost)
        with pytest.raises(Lost):
            W.swap_in(spark.range(10, 12), path)
    assert rows(W.read_table(spark, path)) == ([(0,), (1,), (2,)] if step == "_switch" else [(10,), (11,)])
    # a reader that began before still finds its files
    assert reader.count() == 3
    W.swap_in(spark.range(5, 6), path)
    assert rows(W.read_table(spark, path)) == [(5,)]


def test_old_versions_and_lost_folders_go(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for i in range(5):
        W.swap_in(spark.range(i, i + 1), path)
    with monkeypatch.context() as m:
        m.setattr(W, "_switch", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            W.swap_in(spark.range(99), path)
    W.swap_in(spark.range(7, 8), path)
    assert len([n for n in os.listdir(path) if n.startswith("v=")]) == W.KEPT
    assert rows(W.read_table(spark, path)) == [(7,)]


def test_no_data_is_moved(spark, tmp_path):
    path = str(tmp_path / "t")
    W.swap_in(spark.range(3), path)
    before = files(path)
    W.swap_in(spark.range(4), path)
    assert before.items() <= files(path).items()


def test_the_slower_of_two_writers_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    W.swap_in(spark.range(1), path)
    switch = W._switch

    def overtaken(s, p, number, entry):
        monkeypatch.setattr(W, "_switch", switch)
        W.swap_in(spark.range(2), path)
        switch(s, p, number, entry)

    monkeypatch.setattr(W, "_switch", overtaken)
    with pytest.raises(W.ConcurrentChange):
        W.swap_in(spark.range(3), path)
    assert W.read_table(spark, path).count() == 2


def test_an_incomplete_version_file_does_not_count(spark, tmp_path):
    path = tmp_path / "t"
    W.swap_in(spark.range(2), str(path))
    (path / "_versions" / "000000000002").write_text('{"fold')
    assert W.read_table(spark, str(path)).count() == 2


def test_an_unversioned_table_gets_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    W.append_only(spark.range(2), path)
    W.swap_in(W.read_table(spark, path).filter("id = 1"), path)
    assert rows(W.read_table(spark, path)) == [(1,)]
    W.append_only(spark.range(8, 9), path)
    assert rows(W.read_table(spark, path)) == [(1,), (8,)]


# ---- appends of runs


@pytest.mark.parametrize("by", [(), ("day",)])
def test_a_run_is_appended_once(spark, tmp_path, monkeypatch, by):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, day string")
    two = spark.createDataFrame([(3, "a")], "k int, day string")
    assert W.append_run(one, path, "2024-01-01", by)
    with monkeypatch.context() as m:
        m.setattr(W, "_put_new", lambda *a: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            W.append_run(two, path, "0007", by)
    # written, but not marked: not in the table yet
    assert rows(W.read_table(spark, path).select("k")) == [(1,), (2,)]
    assert W.append_run(two, path, "0007", by)
    assert not W.append_run(two, path, "0007", by)
    assert not W.append_run(one, path, "2024-01-01", by)
    assert rows(W.read_table(spark, path).select("k", "day")) == [(1, "a"), (2, "b"), (3, "a")]
    with pytest.raises(ValueError, match="do not fit"):
        W.append_run(two.drop("day"), path, "8")
    with pytest.raises(ValueError, match="run id"):
        W.append_run(two, path, "../8")


def test_a_run_without_rows_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k int")
    assert W.append_run(empty, path, "1") and not W.append_run(empty, path, "1")
    W.append_run(spark.createDataFrame([(1,)], "k int"), path, "2")
    assert rows(W.read_table(spark, path).select("k")) == [(1,)]


# ---- changes of single partitions


def ledger(spark, path, n=50):
    """Ten rows in each of ``n`` partitions."""
    df = spark.range(10 * n).select(F.col("id").alias("k"), (F.col("id") % n).cast("int").alias("p"), F.lit(1).alias("v"))
    W.replace_partitions(df, path, ["p"])
    return files(path)


SET = {"v": lambda t, s: s("v")}


def unchanged(before, path, *parts):
    """Whether exactly the files of ``parts`` are new."""
    after = files(path)
    touched = {p.split("/p=")[1].split("/")[0] for p in before.items() ^ after.items() for p in [p[0]]}
    return touched == {str(p) for p in parts}


def test_a_merge_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    before = ledger(spark, path)
    # key 3 is stored in partition 3; key 1007 is new and goes to partition 7
    source = spark.createDataFrame([(3, 3, 9), (1007, 7, 8)], "k long, p int, v int")
    out = W.merge_into(spark, path, source, ["k"], ["p"], update=SET, insert=True)
    assert rows(out) == [(3,), (7,)]
    assert unchanged(before, path, 3, 7)
    got = {r.k: (r.p, r.v) for r in W.read_table(spark, path).collect()}
    assert len(got) == 501 and got[3] == (3, 9) and got[1007] == (7, 8)
    assert all(v == (k % 50, 1) for k, v in got.items() if k not in (3, 1007))


def test_a_stored_merge_equals_the_frame_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger(spark, path, 7)
    stored = spark.createDataFrame([tuple(r) for r in W.read_table(spark, path).select("k", "p", "v").collect()], "k long, p int, v int")
    source = spark.createDataFrame([(1, 6, 5), (2, None, 6), (900, 3, 7), (901, 99, 7), (None, 1, 1)], "k long, p int, v int")
    rules = {"v": lambda t, s: s("v") + t("v"), "p": lambda t, s: s("p")}
    want = C.merge(stored, source, ["k"], rules, lambda t, s: s("v") > 4, insert=True)
    W.merge_into(spark, path, source, ["k"], ["p"], rules, lambda t, s: s("v") > 4, insert=True)
    assert rows(W.read_table(spark, path).select("k", "p", "v")) == rows(want)


def test_a_merge_may_empty_a_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    W.replace_partitions(spark.createDataFrame([(1, "a b", 1), (2, "c", 1)], "k long, p string, v int"), path, ["p"])
    W.merge_into(spark, path, spark.createDataFrame([(1, "c", 5)], "k long, p string, v int"), ["k"], ["p"], {"p": lambda t, s: s("p")})
    assert rows(W.read_table(spark, path).select("k", "p", "v")) == [(1, "c", 1), (2, "c", 1)]


def test_a_merge_creates_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    source = spark.createDataFrame([(1, "a", 1)], "k long, p string, v int")
    with pytest.raises(ValueError, match="no table"):
        W.merge_into(spark, path, source, ["k"], ["p"], SET)
    W.merge_into(spark, path, source, ["k"], ["p"], SET, insert=True)
    assert W.read_table(spark, path).count() == 1


def test_updates_and_deletes_touch_their_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    before = ledger(spark, path)
    W.update_rows(spark, path, ["p"], F.col("k").isin(4, 5), {"v": F.col("v") + 10})
    assert unchanged(before, path, 4, 5)
    before = files(path)
    # all of partition 6 and one row of partition 8
    W.delete_rows(spark, path, ["p"], (F.col("p") == 6) | (F.col("k") == 8))
    assert unchanged(before, path, 6, 8)
    got = W.read_table(spark, path)
    assert got.count() == 489 and got.filter("v = 11").count() == 2 and got.filter("p = 6").count() == 0


def test_a_lost_change_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    """Fail before and after each step of a merge that moves rows; repeating it gives what one run gives."""
    source = spark.createDataFrame([(1, "b", 5), (3, "a", 6), (9, "n", 7)], "k long, p string, v int")
    rules = {"p": lambda t, s: s("p"), "v": lambda t, s: t("v") + s("v")}
    steps, lost_at = [0], [None]

    def failing(f):
        def run(*args, **kwargs):
            steps[0] += 1
            if lost_at[0] == (steps[0], "before"):
                raise Lost
            out = f(*args, **kwargs)
            if lost_at[0] == (steps[0], "after"):
                raise Lost
            return out

        return run

    for name in ("_put_new", "replace_partitions", "remove_path"):
        monkeypatch.setattr(W, name, failing(getattr(W, name)))

    def merged(folder, lost):
        path = str(tmp_path / folder)
        start = [(1, "a", 1), (2, "b", 1), (3, "c d", 1), (4, "e", 1)]
        lost_at[0] = None
        W.replace_partitions(spark.createDataFrame(start, "k long, p string, v int"), path, ["p"])
        steps[0], lost_at[0] = 0, lost
        try:
            W.merge_into(spark, path, source, ["k"], ["p"], rules, insert=True)
        except Lost:
            before = rows(W.read_table(spark, path).select("k", "p", "v"))
            lost_at[0] = None
            # what was made binding is finished first; then it is there, and nothing else is
            if W.recover(spark, path):
                return rows(W.read_table(spark, path).select("k", "p", "v"))
            if before == want:
                return before
            assert before == rows(spark.createDataFrame(start, "k long, p string, v int"))
            W.merge_into(spark, path, source, ["k"], ["p"], rules, insert=True)
        return rows(W.read_table(spark, path).select("k", "p", "v"))

    want = [(1, "b", 6), (2, "b", 1), (3, "a", 7), (4, "e", 1), (9, "n", 7)]
    assert merged("whole", None) == want
    n = steps[0]
    assert n >= 5
    for k in range(1, n + 1):
        for when in ("before", "after"):
            assert merged(f"{when}{k}", (k, when)) == want, (k, when)


def test_more_partitions_than_are_listed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "LISTED", 3)
    path = str(tmp_path / "t")
    ledger(spark, path)
    W.update_rows(spark, path, ["p"], F.col("k") < 20, {"v": F.lit(7)})
    got = W.read_table(spark, path)
    assert got.count() == 500 and got.filter("v = 7").count() == 20


def test_date_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None)], "k int, d date")
    W.full_refresh(df, path, ["d"])
    W.delete_rows(spark, path, ["d"], F.col("k") >= 2)
    assert rows(W.read_table(spark, path)) == [(1, date(2024, 1, 1))]


def test_a_merge_reads_each_input_once(spark):
    grouped = lambda n: spark.range(n).groupBy((F.col("id") % 50).alias("k")).agg(F.count("id").alias("v"))
    out = C.merge(grouped(100), grouped(90), ["k"], update=SET, insert=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [(id" not in plan and "Range" not in plan


# ---- layout


def test_reclustering_has_a_state(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4000).select((F.col("id") * 7919 % 4000).alias("a"), (F.col("id") % 3).alias("b")).repartition(6)
    W.full_refresh(df, path)
    assert W.overlapping_files(W.read_table(spark, path), "a").count() > 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert W.recluster(spark, path, ["a"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = files(path)
    stored = W.read_table(spark, path)
    assert W.file_ranges(stored, "a").count() > 1 and W.overlapping_files(stored, "a").isEmpty()
    assert not W.recluster(spark, path, ["a"])
    assert files(path) == before
    assert W.recluster(spark, path, ["b"]) and W.read_table(spark, path).count() == 4000


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS bucket_left")
    spark.sql("DROP TABLE IF EXISTS bucket_right")
    for name, n in (("bucket_left", 1000), ("bucket_right", 500)):
        W.write_bucketed(spark.range(n).withColumn("v", F.lit(name)), name, 4, ["id"], str(tmp_path / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucket_left").join(spark.table("bucket_right"), "id").groupBy("id").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        assert joined.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE bucket_left")
        spark.sql("DROP TABLE bucket_right")
    # one file per bucket, not one per bucket and task
    assert len(files(tmp_path / "bucket_left")) == 4


# ---- proven sizes


def test_constant_columns_do_not_make_a_table_small(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(12_000_000).select(F.lit(7).cast("long").alias("k"), F.lit("abcdefghijklmnopqrstuvwxyz").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    assert sum(os.stat(f).st_size for f in files(path)) < 4 << 20
    assert not S.is_small(df) and not S.may_broadcast(df) and not S.may_broadcast(df.select("k"))
    # numbered by ranges, not in one task
    numbered = O.positions(df.select("k"), [], [F.col("k")])
    assert "Window" not in numbered._jdf.queryExecution().optimizedPlan().toString() or "_run" in numbered._jdf.queryExecution().optimizedPlan().toString()


def test_sizes_come_from_counts_and_lengths(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", F.repeat(F.lit("x"), 1000).alias("v")).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    assert S.bounded_bytes(df, 10**7) == 1000 * (16 + 2 * 16) + 10**6
    assert S.bounded_bytes(df, 10**6) is None
    assert S.bounded_bytes(df, 10**7, measure=False) is None
    assert S.bounded_bytes(df.select("id"), 10**6) == 1000 * 32
    assert S.bounded_bytes(df.unionByName(df).select("id"), 10**6) == 2000 * 32
    # what an expression makes longer is measured as well
    assert S.bounded_bytes(df.select(F.repeat("v", 100).alias("w")), 10**7) is None
    assert S.bounded_bytes(df.select(F.split("v", ",")), 10**7) is None
    assert S.bounded_bytes(df.crossJoin(df), 10**7) is None


def test_sources_without_counts_are_not_small(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.csv(path)
    assert not S.is_small(spark.read.schema("id long").csv(path))


def test_rows_of_many_files_are_counted_by_a_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "_FOOTERS", 2)
    path = str(tmp_path / "t")
    spark.range(100).repartition(5).write.parquet(path)
    assert S.bounded_bytes(spark.read.parquet(path), 10**6) == 100 * 32
