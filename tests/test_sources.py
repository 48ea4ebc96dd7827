from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import quality as Q
from ledgerloom.sources import files, fixed_width, pulls, records, sinks
from ledgerloom.sources import tables as W

SCHEMA = T.StructType().add("id", "integer").add("name", "string").add("amount", "double")


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_counts_bad_records(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,amount\n1,a,1.5\nx,b,2\n3,c,3.5,extra\n4,,\n")
    with pytest.raises(ValueError, match="more than 1 bad"):
        files.read_csv(spark, path, SCHEMA, max_bad_records=1)
    good = files.read_csv(spark, path, SCHEMA, max_bad_records=2)
    assert sorted(r["id"] for r in good.collect()) == [1, 4]


def test_csv_with_unknown_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,amount\n1,a,1.5\n3,c,3.5,extra\nx,c,3.5,extra\n")
    rows = files.read_csv(spark, path, SCHEMA, max_bad_records=1, ignore_unknown_values=True)
    assert sorted(r["id"] for r in rows.collect()) == [1, 3]


def test_csv_types_are_inferred_without_a_schema(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id;name\n1;a\n")
    assert files.read_csv(spark, path, sep=";").dtypes == [("id", "int"), ("name", "string")]


def test_newest_file(spark, tmp_path):
    for name, at in [("load_1.csv", 100), ("load_2.csv", 300), ("load_3.csv", 200), ("other.csv", 900)]:
        write(tmp_path / name, "x")
        os.utime(tmp_path / name, (at, at))
    assert files.newest_file(spark, str(tmp_path), r"load_\d+\.csv").endswith("load_2.csv")
    with pytest.raises(FileNotFoundError):
        files.newest_file(spark, str(tmp_path), r"nothing")
    assert files.newest_of([("/a/x1", 1.0), ("/a/x2", 3.0), ("/a/y", 9.0)], r"x\d") == "/a/x2"


def test_positional_records(spark, tmp_path):
    path = write(tmp_path / "p.txt", "H,20240101\nD,1,a,x\nD,2,,y,more\nT,2\n")
    rows = files.read_positional(spark, path, [(1, "id", "int"), (2, "name", "string")])
    assert sorted((r["id"], r["name"], r["file_name"]) for r in rows.collect()) == [(1, "a", "p.txt"), (2, None, "p.txt")]


def chunks(spark, start, end, months):
    bounds = spark.createDataFrame([(date.fromisoformat(start), date.fromisoformat(end))], "s date, e date")
    return sorted((str(a), str(b)) for a, b in pulls.month_chunks(bounds, "s", "e", months).collect())


def test_month_chunks(spark):
    assert chunks(spark, "2024-01-15", "2024-03-10", 1) == [
        ("2024-01-15", "2024-02-01"), ("2024-02-01", "2024-03-01"), ("2024-03-01", "2024-03-10"),
    ]
    assert chunks(spark, "2024-01-01", "2024-04-01", 3) == [("2024-01-01", "2024-04-01")]
    assert chunks(spark, "2024-01-10", "2024-01-20", 1) == [("2024-01-10", "2024-01-20")]
    assert chunks(spark, "2024-01-01", "2024-01-01", 1) == []
    with pytest.raises(ValueError):
        chunks(spark, "2024-01-01", "2024-02-01", 13)


@pytest.mark.parametrize(
    "low, high, size, want",
    [(0, 10, 4, [(0, 4), (4, 10)]), (0, 8, 4, [(0, 8)]), (0, 3, 10, [(0, 3)]), (5, 17, 3, [(5, 8), (8, 11), (11, 17)]), (4, 4, 2, [])],
)
def test_range_chunks_cover_without_gap(spark, low, high, size, want):
    bounds = spark.createDataFrame([(low, high)], "lo long, hi long")
    assert sorted(tuple(r) for r in pulls.range_chunks(bounds, "lo", "hi", size).collect()) == want


def test_strides_take_every_row_once(spark):
    df = spark.createDataFrame([(i,) for i in [None, -5, *range(0, 103, 3), 500]], "k int")
    counted = pulls.count_by_predicate(df, pulls.stride_predicates("k", 0, 100, 7)).collect()
    assert len(counted) == 7
    assert sum(r["n_rows"] for r in counted) == df.count()
    assert pulls.stride_predicates("k", 0, 1, 5) == ["1 = 1"]


def test_bound_query_quotes_text():
    assert pulls.bound_query("a >= {x} AND b = {n}", {"x": "O'Neil", "n": 5}) == "a >= 'O''Neil' AND b = 5"
    assert pulls.query_options("jdbc:x", "SELECT {n}", {"n": 1})["dbtable"] == "(SELECT 1) q"
    with pytest.raises(KeyError):
        pulls.bound_query("{missing}", {})


def test_run_window():
    now = datetime(2024, 3, 5, 13, 30)
    assert pulls.run_window(now) == (datetime(2024, 3, 4), datetime(2024, 3, 5))
    assert pulls.run_window(now, "18:00:00", "12:00:00") == (datetime(2024, 3, 4, 18), datetime(2024, 3, 5, 12))
    assert pulls.run_window(now, "06:00:00", "12:00:00", same_day=True) == (datetime(2024, 3, 5, 6), datetime(2024, 3, 5, 12))


def test_the_same_window_is_not_loaded_twice(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 5),)], "ts timestamp_ntz")
    window = (datetime(2024, 1, 1), datetime(2024, 1, 2))
    schema = "load_from timestamp_ntz, load_to timestamp_ntz, run_at timestamp_ntz"
    empty, done = spark.createDataFrame([], schema), spark.createDataFrame([(*window, datetime(2024, 1, 2))], schema)
    assert pulls.incremental(rows, "ts", window, empty).count() == 1
    assert pulls.incremental(rows, "ts", window, done).count() == 0


def test_upsert_statement():
    text = sinks.upsert_statement("t", ["k", "v", "n"], ["k"], ["v", "n"], ["n"])
    assert text == 'INSERT INTO t ("k", "v", "n") VALUES (?, ?, ?) ON CONFLICT ("k") DO UPDATE SET "v" = EXCLUDED."v", "n" = EXCLUDED."n" + t."n"'
    assert sinks.upsert_statement("t", ["k"], ["k"]).endswith("DO NOTHING")


def test_upsert_that_does_nothing_keeps_the_stored_row(spark):
    stored = spark.createDataFrame([(1, 1)], "k int, v int")
    new = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    assert sorted(tuple(r) for r in sinks.upsert(stored, new, ["k"]).collect()) == [(1, 1), (2, 6)]


def test_jdbc_append_passes_the_options(spark, monkeypatch):
    seen = {}
    from pyspark.sql.readwriter import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: seen.update(url=url, table=table, mode=mode, **properties))
    sinks.append_jdbc(spark.range(3), "jdbc:x", "t", {"user": "u"})
    assert seen == {"url": "jdbc:x", "table": "t", "mode": "append", "user": "u"}


def test_one_file_in_order(spark, tmp_path):
    from pyspark.sql import functions as F

    body = spark.range(500).select(F.col("id"), F.format_string("%04d", "id").alias("text")).repartition(7)
    lines = sinks.with_header_trailer(body, "text", ["id"], F.lit("HEAD"), F.format_string("TAIL%d", "record_count"), {})
    sinks.write_ordered_lines(lines, str(tmp_path / "shards"), ["part", "id"], windows=True)
    sinks.compose(spark, str(tmp_path / "shards"), str(tmp_path / "out.txt"))
    want = ["HEAD", *[f"{i:04d}" for i in range(500)], "TAIL500"]
    assert (tmp_path / "out.txt").read_bytes().decode() == "".join(x + "\r\n" for x in want)


def test_control_file_order(spark, tmp_path):
    rows = spark.createDataFrame([("b", 1, "R1", 1.5), ("a", 2, "R2", 2.0), ("b", 3, "R3", 0.25)], "batch string, seq int, line string, amount double")
    lines = sinks.control_file(rows, "batch", ["seq"], "line", "amount", "FH", "FT%d/%d/%d", "BH%s", "BT%s/%d/%d")
    got = [r["line"] for r in lines.orderBy("section", "batch", "part", "seq").collect()]
    assert got == ["FH", "BHa", "R2", "BTa/1/200", "BHb", "R1", "R3", "BTb/2/175", "FT2/3/375"]


def test_nothing_is_published_for_no_messages(spark, tmp_path):
    empty = sinks.events(spark.createDataFrame([], "k int"), "k")
    assert sinks.publish(empty, str(tmp_path / "t")) is False
    assert not (tmp_path / "t").exists()


def test_delimiter_is_removed(spark):
    df = spark.createDataFrame([("a|b", 1)], "s string, n int")
    assert sinks.without_delimiter(df, "|").first()["s"] == "ab"


def test_typed_extract_refuses_unknown_types(spark):
    with pytest.raises(ValueError):
        sinks.typed_extract(spark.range(1), {"id": "blob(3)"})


def test_swap_in_may_read_the_table_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    W.swap_in(spark.range(5), path)
    W.swap_in(W.read_table(spark, path).filter("id > 2"), path)
    assert sorted(r[0] for r in W.read_table(spark, path).collect()) == [3, 4]
    assert os.listdir(tmp_path) == ["t"]


def test_gate(spark):
    decide = lambda n: Q.gate(spark.range(n), 3).first()["decision"]
    assert [decide(n) for n in (0, 3, 4)] == ["skip", "continue", "fail"]
    assert Q.require_at_most(spark.range(3), 3) == 3
    with pytest.raises(ValueError):
        Q.require_at_most(spark.range(4), 3)


def test_file_checks():
    assert Q.csv_problems(["A", "b"], "in.CSV", ["a"]) == {"extension": True, "required": True}
    assert Q.csv_problems(["A"], "in.txt", ["a", "z"]) == {"extension": False, "required": False}


def test_file_date_must_not_be_older(spark):
    day = lambda *d: spark.createDataFrame([(date(2024, 1, x),) for x in d], "d date")
    accepted = lambda a, b: Q.not_older_than_loaded(a, b, "d").first()["accepted"]
    assert accepted(day(2), day(1)) and accepted(day(1), day(1)) and accepted(day(2), day())
    assert not accepted(day(1), day(2)) and not accepted(day(), day(1))


def test_dates_as_integers(spark):
    df = spark.createDataFrame([(20240229,), (20240230,), (9991231,), (None,)], "d int")
    assert tuple(Q.date_int_counts(df, "d").first()) == (3, 2)


def test_mandatory_fields(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (" ", None), ("", 3)], "Name string, n int")
    assert tuple(Q.mandatory_counts(df, ["NAME", "n"]).first()) == (4, 2, 2, 3, False)
    kinds = sorted(r["violation_type"] for r in Q.violations(df, ["name", "n"]).collect())
    assert kinds == ["EMPTY_VIOLATION", "NULL_VIOLATION", "NULL_VIOLATION"]


def test_trailer_without_a_count_is_skipped(spark):
    body = spark.createDataFrame([("A",), ("A",), ("B",), ("C",)], "segment string")
    trailer = spark.createDataFrame([("A", 2), ("B", 5), ("C", 0)], "segment string, n int")
    got = {r["segment"]: r["status"] for r in Q.trailer_counts(body, trailer, "segment", "n").collect()}
    assert got == {"A": "Match", "B": "Mismatch", "C": "Skipped"}


def test_an_unreadable_count_is_told_apart(spark):
    body = spark.createDataFrame([("A",), ("B",)], "segment string")
    trailer = spark.createDataFrame([("A", "x1"), ("C", "0")], "segment string, n string")
    got = {r["segment"]: r["status"] for r in Q.trailer_counts(body, trailer, "segment", "n").collect()}
    assert got == {"A": "Unreadable", "B": "Unreadable", "C": "Skipped"}


def test_csv_quoted_record_with_an_extra_field(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'name,n\n"x,y",2,extra\n"a,b"\n')
    rows = files.read_csv(spark, path, "name string, n int", max_bad_records=1, ignore_unknown_values=True)
    assert [tuple(r) for r in rows.collect()] == [("x,y", 2)]


def test_csv_without_a_schema_counts_bad_records(spark, tmp_path):
    path = write(tmp_path / "n.csv", "a,b\n1,2\n1,2,3,4\n5\n")
    with pytest.raises(ValueError, match="bad records"):
        files.read_csv(spark, path)
    assert [tuple(r) for r in files.read_csv(spark, path, max_bad_records=2).collect()] == [(1, 2)]


def test_json_and_shards_count_bad_records(spark, tmp_path):
    path = write(tmp_path / "j.json", '{"a": 1}\n{"a": \n')
    with pytest.raises(ValueError, match="bad records"):
        files.read_json(spark, path, "a int")
    assert [r.a for r in files.read_json(spark, path, "a int", max_bad_records=1).collect()] == [1]
    write(tmp_path / "s1.csv", "a,b\n1,x\n")
    write(tmp_path / "s2.csv", "a,b\nno,y\n")
    with pytest.raises(ValueError, match="bad records"):
        files.read_shards(spark, str(tmp_path / "s*.csv"), schema="a int, b string")


def test_append_refuses_another_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    W.append_only(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    W.append_only(spark.createDataFrame([("b", 2)], "v string, k long"), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="do not fit"):
        W.append_only(spark.createDataFrame([(3, "c")], "k int, w string"), path)


def test_shards_are_ordered_by_number():
    names = ["x/part-99999-a.txt", "x/part-100000-a.txt", "x/part-00002-a.txt"]
    assert sorted(names, key=sinks.shard_number) == [names[2], names[0], names[1]]


def test_totals_are_not_rounded_row_by_row(spark):
    summary = spark.createDataFrame([(10, 0.04)], "n int, total double")
    body = spark.createDataFrame([(0.004,)] * 10, "amount double")
    assert Q.totals_match(body, summary, "amount", "n", "total").first()["validation_status"] == "Match"
    big = spark.sql("SELECT CAST('90071992547409.93' AS DECIMAL(20,2)) AS amount")
    one = spark.sql("SELECT 1 AS n, CAST('90071992547409.93' AS DECIMAL(20,2)) AS total")
    assert Q.totals_match(big, one, "amount", "n", "total").first()["total_status"] == "Match"


def test_mod10_with_length(spark):
    df = spark.createDataFrame([("046454286",), ("79927398713",)], "s string")
    assert [r[0] for r in df.select(Q.mod10("s", 9)).collect()] == ["Valid", "Invalid"]


def leading(n, *bodies):
    """Files whose first ``n`` lines are not records."""
    return ["".join(f"note {i}, of {n}\n" for i in range(n)) + body for body in bodies]


@pytest.mark.parametrize("n", [0, 1, 3])
@pytest.mark.parametrize("split", [None, "16"])
def test_leading_rows_of_each_file_are_skipped(spark, tmp_path, n, split):
    bodies = ['1,"a, b",1.5\n\n2,,2\n', "", "3,c,3\n4,d,4\n5,e,5\n6,f,6"]
    for i, text in enumerate(leading(n, *bodies)):
        write(tmp_path / f"f{i}.csv", text)
    # a file with fewer lines than are skipped
    write(tmp_path / "short.csv", "only, a\n" if n > 1 else "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            # blocks of a few bytes: the leading lines lie in several tasks
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        rows = files.read_csv(spark, str(tmp_path), SCHEMA, skip_leading_rows=n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [(1, "a, b", 1.5), (2, None, 2.0), (3, "c", 3.0), (4, "d", 4.0), (5, "e", 5.0), (6, "f", 6.0)]


def test_leading_rows_and_bad_records(spark, tmp_path):
    write(tmp_path / "a.csv", "t\nu\n1,a,1\nx,b,2\n3,c,3,more\n")
    with pytest.raises(ValueError, match="more than 1 bad"):
        files.read_csv(spark, str(tmp_path), SCHEMA, skip_leading_rows=2, max_bad_records=1)
    rows = files.read_csv(spark, str(tmp_path), SCHEMA, skip_leading_rows=2, max_bad_records=1, ignore_unknown_values=True)
    assert sorted(r["id"] for r in rows.collect()) == [1, 3]
    with pytest.raises(ValueError, match="schema"):
        files.read_csv(spark, str(tmp_path), skip_leading_rows=2)


@pytest.mark.parametrize("split", [None, "16"])
def test_existing_files_are_composed_in_name_order(spark, tmp_path, split):
    folder = tmp_path / "in"
    folder.mkdir()
    texts = {"a": "", "b": 'k,v\n1,""\n2,x\n', "c": "k,v\n", "d": "k,v\n3,y", "e": 'k,v\n4,"z"\n'}
    for name, text in texts.items():
        write(folder / f"{name}.csv", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        n = sinks.compose_files(spark, f"{folder}/*.csv", str(tmp_path / "shards"), windows=True, empty_to_blank=True)
        sinks.compose(spark, str(tmp_path / "shards"), str(tmp_path / "whole.csv"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert n == 5
    assert (tmp_path / "whole.csv").read_bytes() == b'k,v\r\n1,\r\n2,x\r\n3,y\r\n4,"z"\r\n'
    with pytest.raises(FileNotFoundError):
        sinks.compose_files(spark, f"{folder}/a.csv", str(tmp_path / "none"))


LAYOUT = fixed_width.parse_layout(["k:1:6:0:L:int", "name:7:10: :R"])


def bytes_of(folder):
    parts = sorted(p for p in folder.iterdir() if p.name.startswith("part-"))
    return b"".join(p.read_bytes() for p in parts), len(parts)


def test_records_without_separators(spark, tmp_path):
    # every byte value occurs, those of line feeds and field separators too
    df = spark.range(3000).select("id", F.to_binary(F.lpad(F.hex("id"), 6, "0"), F.lit("hex")).alias("raw")).repartition(7)
    path = tmp_path / "records"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records.write_records(df, str(path), "raw", 3, ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    data, parts = bytes_of(path)
    assert data == b"".join(i.to_bytes(3, "big") for i in range(3000)) and parts > 1
    (path / "part-99999.bin").write_bytes(data[:9])
    back = records.read_records(spark, str(path), 3)
    assert back.count() == 3003
    records.write_records(df.limit(5), str(path), "raw", 3)
    assert records.read_records(spark, str(path), 3).count() == 5


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 1000000).alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    lines = fixed_width.format_records(rows, LAYOUT)
    records.write_ebcdic_records(lines, str(tmp_path / "shards"), ["k"], "line", 16)
    sinks.compose(spark, str(tmp_path / "shards"), str(tmp_path / "whole.bin"))
    assert (tmp_path / "whole.bin").stat().st_size == 4000 * 16
    assert (tmp_path / "whole.bin").read_bytes()[:16] == "000000n0        ".encode("cp037")
    raw = records.read_records(spark, str(tmp_path / "whole.bin"), 16, split_bytes=10_001)
    assert raw.select(F.spark_partition_id().alias("p")).distinct().count() == 7
    back = records.read_ebcdic_records(spark, str(tmp_path / "whole.bin"), 16, LAYOUT, split_bytes=10_001)
    assert sorted(tuple(r) for r in back.collect()) == [(i, f"n{i}") for i in range(4000)]


def test_broken_record_files_are_refused(spark, tmp_path):
    (tmp_path / "r.bin").write_bytes(b"x" * 33)
    with pytest.raises(ValueError, match="33 bytes"):
        records.read_records(spark, str(tmp_path / "r.bin"), 16)
    path = tmp_path / "out"
    mixed = spark.createDataFrame([(bytearray(b"abc"),), (bytearray(b"ab"),)], "raw binary").repartition(2)
    with pytest.raises(Exception, match="does not have 3 bytes"):
        records.write_records(mixed, str(path), "raw", 3)
    assert not path.exists() or not [p for p in path.iterdir()]
    empty = mixed.filter("false")
    records.write_records(empty, str(path), "raw", 3)
    assert records.read_records(spark, str(path), 3).count() == 0
