from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import operations as P
from ledgerloom.plans import domain as D
from ledgerloom.plans.load import FILE_LOAD, TABLE_LOAD, LoadRefused, Segment, load_segment_file, run_chain
from ledgerloom.sources import tables as W
from ledgerloom.sources.fixed_width import parse_layout


@pytest.mark.parametrize("opened, year, want", [("2020-02-29", 2023, "2023-03-01"), ("2020-02-29", 2024, "2024-02-29"), ("2020-05-07", 2023, "2023-05-07")])
def test_anniversary(spark, opened, year, want):
    got = spark.range(1).select(D.anniversary(F.lit(opened).cast("date"), year)).first()[0]
    assert str(got) == want


def test_evaluation_events(spark):
    d = date(2024, 6, 15)
    rows = [(1, date(2020, 6, 15), None, False), (2, date(2025, 1, 1), d, True), (3, date(2020, 1, 1), d, False), (4, date(2020, 6, 14), None, True)]
    accounts = spark.createDataFrame(rows, "account_id int, opened date, closed date, zero_balance boolean")
    out = D.evaluation_events(accounts, d, date(2025, 1, 1), "0.48", "0.35")
    assert {(r["account_id"], r["event"], r["threshold"]) for r in out.collect()} == {(1, "anniversary", "0.48"), (2, "closure", "0.35")}


@pytest.mark.parametrize(
    "first, frequency, want",
    [
        ("2024-01-20", "once", "2024-01-20"), ("2024-01-01", "once", None), ("2024-01-01", "weekly", "2024-01-15"),
        ("2024-01-02", "weekly", "2024-01-16"), ("2024-01-02", "bi-weekly", "2024-01-16"), ("2023-12-20", "monthly", "2024-01-20"),
        ("2023-12-03", "monthly", "2024-02-03"), ("2024-03-01", "weekly", "2024-03-01"), ("2024-01-01", "yearly", None),
    ],
)
def test_next_transfer(spark, first, frequency, want):
    df = spark.createDataFrame([(date.fromisoformat(first), frequency)], "first date, frequency string")
    got = D.next_transfer(df, "first", "frequency", date(2024, 1, 15)).first()["next_date"]
    assert (str(got) if got else None) == want


def test_refund_is_minus_base_minus_bonus(spark):
    day = datetime(2024, 1, 5)
    moves = spark.createDataFrame([(1, day, 100, 10, False), (1, day, 100, 30, True), (2, datetime(2024, 9, 1), 5, 0, False)], "payment_id int, moved_at timestamp_ntz, base long, bonus long, is_refund boolean")
    pays = spark.createDataFrame([(1, 7, day), (2, 7, day)], "payment_id int, wallet_id int, paid_at timestamp_ntz")
    ids = spark.createDataFrame([(7, "old", day, 1), (7, "new", day, 2)], "wallet_id int, tier string, effective_at timestamp_ntz, identity_no int")
    out = D.points_by_period(moves, pays, ids, days=30).collect()
    assert [(r["wallet_id"], r["tier"], str(r["month"]), r["points"]) for r in out] == [(7, "new", "2024-01-01", 40)]


def test_inherited_open_interval_ends_at_the_merge(spark):
    t = lambda d: datetime(2024, 1, d)
    versions = spark.createDataFrame([(1, "A", t(1)), (2, "B", t(2)), (2, "C", t(5))], "c int, p string, f timestamp_ntz")
    edges = spark.createDataFrame([(1, 2, t(20))], "survivor int, victim int, merged_at timestamp_ntz")
    out = D.survivor_history(versions, edges, "c", "p", "f")
    assert {(r["c"], r["p"], r["effective_from"].day, r["effective_to"] and r["effective_to"].day) for r in out.collect()} == {
        (1, "A", 1, None), (2, "B", 2, 5), (2, "C", 5, None), (1, "B", 2, 5), (1, "C", 5, 20),
    }


def test_due_days(spark):
    days = spark.createDataFrame([(date(2024, 3, d),) for d in (29, 30, 31)], "d date")  # Friday to Sunday
    due = lambda f: [r[0] for r in days.orderBy("d").select(P.is_due(F.lit(f), F.col("d"))).collect()]
    assert due("daily") == ["Y", "Y", "Y"]
    assert due("1-5") == ["Y", "N", "N"]
    assert due("2-6") == ["Y", "Y", "N"]
    assert due("sundays") == ["N", "N", "Y"]
    assert due("monthly") == ["N", "N", "Y"]
    assert due("never") == [None, None, None]


def test_chain_order_decides_what_a_step_sees(spark):
    rows = spark.createDataFrame([(1, 5), (1, 7), (2, 9)], "k int, v int")
    names = spark.createDataFrame([(1, "one")], "id int, name string")
    config = {
        "join": [{"table": "names", "columns": ["name"], "on": [("k", "id")], "how": "left"}],
        "add": ["v * 2 as w"], "drop": ["v"], "time_columns": [], "filters": ["name is not null"],
        "dedup": ["k"], "dedup_order": ["w desc"], "target": ["w", "k", "name"],
    }
    table = run_chain(rows, config, {"names": names}, TABLE_LOAD)
    assert sorted((r["k"], r["w"], r["name"]) for r in table.collect()) == [(1, 10, "one"), (1, 14, "one")]
    file = run_chain(rows, config, {"names": names}, FILE_LOAD)
    assert file.columns == ["w", "k", "name"]
    assert sorted((r["k"], r["w"], r["name"] or "") for r in file.collect()) == [(1, 14, "one"), (2, 18, "")]


def test_missing_target_column_is_an_error(spark):
    with pytest.raises(ValueError, match="zzz"):
        run_chain(spark.range(1), {"target": ["zzz"]}, {}, FILE_LOAD)


def load(spark, tmp_path, text, run):
    (tmp_path / f"{run}.txt").write_text(text)
    body = parse_layout(["k:2:3:0:L:int"])
    segments = {"A": Segment(body, str(tmp_path / "a"), {"add": ["k * 2 as w"]}, "n_a"), "B": Segment(body, str(tmp_path / "b"), mode="refresh")}
    trailer = Segment(parse_layout(["day:2:4: :R", "n_a:6:3:0:L:int"]), str(tmp_path / "trailers"))
    return load_segment_file(
        spark, str(tmp_path / f"{run}.txt"), segments, "T", trailer, ["day"], str(tmp_path / "control"), run, datetime(2024, 1, 1)
    )


def test_segment_load(spark, tmp_path):
    control = load(spark, tmp_path, "A001\nA002\nB007\nTday1002\n", "r1")
    assert sorted((r["segment"], r["n_rows"], r["status"]) for r in control.collect()) == [("A", 2, "C"), ("B", 1, "C")]
    with pytest.raises(LoadRefused, match="before"):
        load(spark, tmp_path, "A001\nA002\nTday1002\n", "r2")
    with pytest.raises(LoadRefused, match="counts"):
        load(spark, tmp_path, "A001\nTday2002\n", "r3")
    load(spark, tmp_path, "A003\nB009\nTday2001\n", "r4")
    rows = lambda name: sorted(tuple(r) for r in W.read_table(spark, str(tmp_path / name)).drop(W.RUN).collect())
    assert rows("a") == [(1, 2), (2, 4), (3, 6)]
    assert rows("b") == [(9,)]
    assert [r[0] for r in rows("trailers")] == ["day1", "day2"]


@pytest.mark.parametrize(
    "text, why",
    [
        ("A001\nA002\n", "no trailer"),
        ("A001\nTday1001\nTday1001\n", "several trailers"),
        ("A001\nTday1xyz\n", "Unreadable"),
        ("A001\nX999\nTday1001\n", "no known segment"),
    ],
)
def test_files_that_are_refused(spark, tmp_path, text, why):
    with pytest.raises(LoadRefused, match=why):
        load(spark, tmp_path, text, "r1")
    assert not (tmp_path / "a").exists() and not (tmp_path / "control").exists()


class Lost(Exception):
    pass


def test_a_failure_at_any_step_leaves_each_row_once(spark, tmp_path, monkeypatch):
    """Fail before and after each write of a load in turn; the repeated run completes it."""
    from pyspark.sql.readwriter import DataFrameWriter

    text = "A001\nA002\nB007\nTday1002\n"
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

    monkeypatch.setattr(DataFrameWriter, "parquet", failing(DataFrameWriter.parquet))
    for name in ("_put_new", "_tidy", "remove_path"):
        monkeypatch.setattr(W, name, failing(getattr(W, name)))
    (tmp_path / "whole").mkdir()
    load(spark, tmp_path / "whole", text, "r1")
    n = steps[0]
    assert n > 10
    for k in range(1, n + 1):
        for when in ("before", "after"):
            folder = tmp_path / f"{when}{k}"
            folder.mkdir()
            steps[0], lost_at[0] = 0, (k, when)
            with pytest.raises(Lost):
                load(spark, folder, text, "r1")
            lost_at[0] = None
            try:
                load(spark, folder, text, "r1")
            except LoadRefused as e:
                # only the very last step, after which everything is stored
                assert "before" in str(e) and (k, when) == (n, "after")
            stored = {x: sorted(tuple(r) for r in W.read_table(spark, str(folder / x)).drop(W.RUN).collect()) for x in ("a", "b", "trailers")}
            assert stored == {"a": [(1, 2), (2, 4)], "b": [(7,)], "trailers": [("day1", 2)]}
            control = W.read_table(spark, str(folder / "control"))
            assert sorted((r.segment, r.n_rows) for r in control.collect()) == [("A", 2), ("B", 1)]


def test_redefining_segments_are_not_counted(spark, tmp_path):
    (tmp_path / "r.txt").write_text("A001\nR001\nR001\nTday1001\n")
    body = parse_layout(["k:2:3:0:L:int"])
    segments = {"A": Segment(body, str(tmp_path / "a"), count_column="n"), "R": Segment(body, str(tmp_path / "r"), count_column="n", redefines=True)}
    trailer = Segment(parse_layout(["day:2:4: :R", "n:6:3:0:L:int"]), str(tmp_path / "t"))
    load_segment_file(spark, str(tmp_path / "r.txt"), segments, "T", trailer, ["day"], str(tmp_path / "c"), "r1", datetime(2024, 1, 1))
    assert W.read_table(spark, str(tmp_path / "r")).count() == 2


def brute_flow(rows, points, by_day=False):
    key = (lambda t: t.date()) if by_day else (lambda t: t)
    counts, shown = {}, set()
    for g in {r[0] for r in rows if None not in r[:3]}:
        for p in points.get(g, []):
            last = {}
            for _, e, t, s, n in (r for r in rows if r[0] == g and r[1] is not None and r[2] is not None):
                if key(t) <= key(p):
                    last[e] = max(last.get(e, (datetime.min, -1, None)), (t, n, s))
            for _, _, s in last.values():
                counts[g, p, s] = counts.get((g, p, s), 0) + 1
                shown.add((g, s))
    return {(g, p, s): counts.get((g, p, s), 0) for g, s in shown for p in points[g]}


@pytest.mark.parametrize("by_day", [False, True])
@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("every", ["1 day", "1 month"])
def test_cumulative_flow_against_brute_force(spark, request, by_day, own, every):
    import random

    rng = random.Random(7)
    start = datetime(2024, 1, 1)
    rows = [
        (rng.choice(["a", "b", "c", None]), rng.choice([1, 2, 3, 4, None]), start + timedelta(hours=rng.randrange(-50, 2500)), rng.choice("xyz"), n)
        for n in range(120)
    ] + [("a", 1, None, "x", 999), ("late", 1, start + timedelta(days=900), "x", 1000)]
    df = spark.createDataFrame(rows, "g string, e int, t timestamp_ntz, s string, n int").repartition(3)
    common = [start + timedelta(days=k) for k in range(91)] if every == "1 day" else [datetime(2024, m, 1) for m in (1, 2, 3, 4)]
    if own:
        points = {"a": common, "b": common[1:3], "late": common}
        calendars = spark.createDataFrame([(g, p) for g, p in points.items()], "g string, points array<timestamp_ntz>")
    else:
        points, calendars = {g: common for g in ("a", "b", "c", "late")}, None
    if own:
        request.getfixturevalue("large")
    flow = D.cumulative_flow(df, "g", "e", "t", "s", ["n"], str(common[0]), str(common[-1]), every, by_day, calendars)
    assert {(r.g, r.point, r.s): r.n for r in flow.collect()} == brute_flow(rows, points, by_day)


def test_no_row_of_the_flow_carries_a_calendar(spark):
    df = spark.createDataFrame([("a", 1, datetime(2024, 1, 1), "x", 1)], "g string, e int, t timestamp_ntz, s string, n int")
    flow = D.cumulative_flow(df, "g", "e", "t", "s", ["n"], "2024-01-01", "2024-12-31", "1 hour")
    assert "first(_points" not in flow._jdf.queryExecution().optimizedPlan().toString()
    assert flow.count() == 365 * 24 + 1
