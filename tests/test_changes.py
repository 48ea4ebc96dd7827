from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes as C


def frame(spark, rows, schema="k int, v int"):
    return spark.createDataFrame(rows, schema)


def pairs(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SET = {"v": lambda t, s: s("v")}


def test_upsert_updates_and_inserts(spark):
    out = C.merge(frame(spark, [(1, 1), (2, 2)]), frame(spark, [(2, 20), (3, 30)]), ["k"], update=SET, insert=True)
    assert pairs(out) == [(1, 1), (2, 20), (3, 30)]


def test_merge_is_idempotent(spark):
    source = frame(spark, [(2, 20), (3, 30)])
    once = C.merge(frame(spark, [(1, 1), (2, 2)]), source, ["k"], update=SET, insert=True)
    assert pairs(C.merge(once, source, ["k"], update=SET, insert=True)) == pairs(once)


def test_condition_and_partial_insert(spark):
    out = C.merge(
        frame(spark, [(1, 5), (2, 5)]), frame(spark, [(1, 9), (2, 1), (3, 7)]), ["k"],
        update=SET, when=lambda t, s: s("v") > t("v"), insert={"k": lambda t, s: s("k")},
    )
    assert pairs(out) == [(1, 9), (2, 5), (3, None)]


def test_null_keys_never_match(spark):
    out = C.merge(frame(spark, [(None, 1), (1, 1)]), frame(spark, [(None, 2), (1, 2)]), ["k"], update=SET, insert=True)
    assert pairs(out) == [(1, 2), (None, 1), (None, 2)]


def test_null_condition_updates_nothing(spark):
    out = C.merge(frame(spark, [(1, None)]), frame(spark, [(1, 3)]), ["k"], update=SET, when=lambda t, s: s("v") > t("v"))
    assert pairs(out) == [(1, None)]


def test_two_source_rows_for_one_key_are_an_error(spark):
    with pytest.raises(Exception, match="several rows for one key"):
        C.merge(frame(spark, [(1, 1)]), frame(spark, [(1, 2), (1, 3)]), ["k"], update=SET).collect()


def test_delete_keeps_rows_whose_condition_is_null(spark):
    out = C.delete_where(frame(spark, [(1, 1), (2, 9), (3, None)]), F.col("v") > 5)
    assert pairs(out) == [(1, 1), (3, None)]


def test_update_not_in_with_a_null_in_the_list_changes_nothing(spark):
    listed = frame(spark, [(1, 0), (None, 0)])
    out = C.update_where_not_in(frame(spark, [(1, 1), (2, 2)]), listed, "k", "k", {"v": F.lit(0)})
    assert pairs(out) == [(1, 1), (2, 2)]


def test_cdc_hash_with_a_null_key_replaces_nothing(spark):
    target = C.cdc_hash_replace(frame(spark, [], "a string, b string, cdc_hash string"), frame(spark, [("1", None), ("1", "2")], "a string, b string"), ["a", "b"])
    out = C.cdc_hash_replace(target, frame(spark, [("1", None), ("1", "2")], "a string, b string"), ["a", "b"])
    assert sorted((r["a"], r["b"] or "") for r in out.collect()) == [("1", ""), ("1", ""), ("1", "2")]


def test_latest_state_drops_deletes_and_untyped_changes(spark):
    rows = frame(spark, [(1, 1, "I"), (1, 2, "D"), (2, 1, "I"), (3, 1, "U"), (3, 2, None)], "k int, t int, optype string")
    out = C.cdc_latest_state(rows, ["k"], [F.desc("t")])
    assert [r["k"] for r in out.collect()] == [2]
    assert C.cdc_latest_state(rows, ["k"], [F.desc("t")], hide=["optype", "t", "position"]).columns == ["k"]


def test_roll_splits_every_row_once(spark):
    current, history = C.roll_current(frame(spark, [(1, 1), (2, 1)]), frame(spark, [(1, 2), (3, 1)]), ["k"], ["v"])
    assert pairs(current) == [(1, 2), (2, 1), (3, 1)]
    assert pairs(history) == [(1, 1)]


def test_insert_absent(spark):
    out = C.insert_absent(frame(spark, [(1, 1)]), frame(spark, [(1, 9), (2, 2)]), lambda df: F.col("k"))
    assert pairs(out) == [(1, 1), (2, 2)]


def test_unmatched_duplicates_are_all_inserted(spark):
    out = C.merge(frame(spark, [(1, 1)]), frame(spark, [(1, 5), (2, 2), (2, 3)]), ["k"], update=SET, insert=True)
    assert pairs(out) == [(1, 5), (2, 2), (2, 3)]


def test_merge_never_plans_a_full_outer_join(spark):
    out = C.merge(frame(spark, [(1, 1)]), frame(spark, [(1, 5)]), ["k"], update=SET, insert=True)
    assert "FullOuter" not in out._jdf.queryExecution().executedPlan().toString()


def flags(spark, snapshot):
    stored = frame(spark, [(1, "open"), (2, "open"), (None, "open"), (3, None), (4, "shut")], "k int, s string")
    out = C.flag_missing(stored, frame(spark, [(k,) for k in snapshot], "x int"), "k", "x", "s", "shut", "open", ["shut"])
    return {(r.k, r.s) for r in out.collect()}


def test_flag_missing_has_the_rules_of_not_in(spark):
    assert flags(spark, [1, 4]) == {(1, "open"), (2, "shut"), (None, "open"), (3, "shut"), (4, "open")}
    assert flags(spark, [1, None]) == {(1, "open"), (2, "open"), (None, "open"), (3, None), (4, "shut")}
    assert flags(spark, []) == {(k, "shut") for k in (1, 2, None, 3, 4)}
