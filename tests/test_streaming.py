from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.streaming import incremental as I

SCHEMA = T.StructType().add("k", "integer").add("ts", "timestamp").add("v", "integer").add("optype", "string")
START = datetime(2024, 1, 1)


def deliver(spark, folder, rows):
    data = [(k, START + timedelta(minutes=m), v, op) for k, m, v, op in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def test_latest_state_over_several_batches(spark, tmp_path):
    inbox, table, cp = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    deliver(spark, inbox, [(1, 5, 10, "I"), (2, 1, 20, "I"), (3, 1, 30, "I")])
    run = lambda: I.run_available(I.file_stream(spark, str(inbox), SCHEMA), cp, I.keep_latest(table, ["k"], ["ts", "v"], fanout=2))
    run()
    # an older change arrives late, one key is deleted, one is new
    deliver(spark, inbox, [(1, 2, 99, "U"), (2, 8, 0, "D"), (4, 1, 40, "I")])
    run()
    # a change older than the delete must not revive the key
    deliver(spark, inbox, [(2, 7, 77, "U")])
    run()
    state = I.read_state(spark, table, ["k"], ["ts", "v"])
    assert state.count() == 4
    assert sorted((r["k"], r["v"]) for r in state.filter("optype <> 'D'").collect()) == [(1, 10), (3, 30), (4, 40)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, START, 1, "I"), (1, START + timedelta(1), 2, "U")], SCHEMA)
    apply = I.keep_latest(table, ["k"], ["ts"], fanout=2)
    for number in (0, 0, 1, 1, 0):
        apply(batch, number)
        assert [(r["k"], r["v"]) for r in I.read_state(spark, table, ["k"], ["ts"]).collect()] == [(1, 2)]


def test_a_small_batch_leaves_stored_files_alone(spark, tmp_path):
    table = tmp_path / "t"
    apply = I.keep_latest(str(table), ["k"], ["ts"])
    many = [(k, START, k, "I") for k in range(2000)]
    for number in range(4):
        apply(spark.createDataFrame(many[number * 500 : number * 500 + 500], SCHEMA), number)
    files = lambda: {p: p.stat().st_mtime_ns for p in table.rglob("*.parquet")}
    before = files()
    apply(spark.createDataFrame([(7, START + timedelta(1), -7, "U")], SCHEMA), 4)
    after = files()
    assert before.items() <= after.items() and len(after) == len(before) + 1
    state = {r.k: r.v for r in I.read_state(spark, str(table), ["k"], ["ts"]).collect()}
    assert len(state) == 2000 and state[7] == -7


def test_counts_are_replaced_as_windows_grow(spark, tmp_path):
    inbox, table, cp = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    for rows in ([(1, 0, 1, "I"), (2, 10, 2, "I")], [(3, 20, 4, "I"), (4, 70, 8, "I")]):
        deliver(spark, inbox, rows)
        counts = I.windowed_counts(I.file_stream(spark, str(inbox), SCHEMA), "ts", "1 hour", "1 day", total=F.sum("v"))
        I.run_available(counts, cp, I.replace_by_key(table, ["bucket"], fanout=2), mode="update")
    got = sorted((r["bucket"].hour, r["n"], r["total"]) for r in I.read_state(spark, table, ["bucket"]).collect())
    assert got == [(0, 3, 7), (1, 1, 8)]


def test_duplicates_in_later_files_are_dropped(spark, tmp_path):
    inbox, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for rows in ([(1, 0, 1, "I"), (1, 0, 1, "I")], [(1, 0, 1, "I"), (2, 5, 2, "I")]):
        deliver(spark, inbox, rows)
        I.run_available(I.deduplicated(I.file_stream(spark, str(inbox), SCHEMA), ["k"], "ts", "1 day"), cp, out)
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == [1, 2]


def test_missing_events_wait_for_the_watermark(spark, tmp_path):
    inbox, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        stream = lambda op: I.file_stream(spark, str(inbox), SCHEMA).filter(F.col("optype") == op)
        issued = stream("I").select("k", F.col("ts").alias("issued_at"))
        seen = stream("U").select(F.col("k").alias("sk"), F.col("ts").alias("seen_at"))
        I.run_available(I.missing_events(issued, seen, "k", "issued_at", "sk", "seen_at", "30 minutes", "1 minute"), cp, out)
        return sorted(r["k"] for r in spark.read.schema("k int").parquet(out).collect())

    deliver(spark, inbox, [(1, 0, 0, "I"), (2, 1, 0, "I"), (1, 10, 0, "U")])
    assert run() == []
    deliver(spark, inbox, [(9, 600, 0, "I"), (9, 601, 0, "U")])
    assert run() == [2]


def test_messages_of_a_batch_are_replaced_when_it_is_repeated(spark, tmp_path):
    messages = spark.createDataFrame([("1", "{}")], "key string, value string")
    send = I.publish_each(str(tmp_path / "topic"))
    send(messages, 0)
    send(messages, 0)
    assert spark.read.json(str(tmp_path / "topic")).count() == 1


def test_a_new_checkpoint_replaces_no_stored_rows(spark, tmp_path):
    table = str(tmp_path / "t")
    for n, rows in enumerate([[(1, 5, 10, "I"), (2, 5, 20, "I")], [(2, 4, 99, "U"), (3, 1, 30, "I")]]):
        inbox = tmp_path / f"in{n}"
        deliver(spark, inbox, rows)
        # another query with its own checkpoint, which counts its batches from 0 again
        I.run_available(I.file_stream(spark, str(inbox), SCHEMA), str(tmp_path / f"cp{n}"), I.keep_latest(table, ["k"], ["ts"]))
    state = I.read_state(spark, table, ["k"], ["ts"])
    assert sorted((r.k, r.v) for r in state.collect()) == [(1, 10), (2, 20), (3, 30)]


def test_a_later_query_replaces_by_key_whatever_its_batch_numbers(spark, tmp_path):
    table = str(tmp_path / "t")
    for n, deliveries in enumerate([[[(1, 0, 1, "I")], [(1, 0, 2, "I")], [(1, 0, 3, "I")]], [[(1, 0, 9, "I")]]]):
        for rows in deliveries:
            deliver(spark, tmp_path / f"in{n}", rows)
            I.run_available(I.file_stream(spark, str(tmp_path / f"in{n}"), SCHEMA), str(tmp_path / f"cp{n}"), I.replace_by_key(table, ["k"], fanout=2))
    assert [(r.k, r.v) for r in I.read_state(spark, table, ["k"]).collect()] == [(1, 9)]


def test_columns_named_like_folders_are_kept(spark, tmp_path):
    table = str(tmp_path / "t")
    batch = spark.createDataFrame([(1, "a", 7)], "k int, part string, level int")
    apply = I.keep_latest(table, ["k"], ["level"], fanout=2)
    for number in range(3):
        apply(batch, number)
    assert [tuple(r) for r in I.read_state(spark, table, ["k"], ["level"]).collect()] == [(1, "a", 7)]
