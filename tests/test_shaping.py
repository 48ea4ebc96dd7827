from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import types as T

from ledgerloom.operators import changes as C
from ledgerloom.operators import shaping as S

DEEP = "id int, a array<struct<x:int, b:array<struct<y:string, c:struct<z:int, w:string>>>>>, m map<string, struct<v:int>>"
ROWS = [
    (1, [(1, [("p", (7, "q")), ("r", None), None]), (2, None), None], {"k": (5,), "n": None}),
    (2, None, None),
    (3, [], {}),
]
NAMES = {"a": "rates", "a.x": "plan", "a.b": "tiers", "a.b.y": "name", "a.b.c.z": "amount", "m.v": "value"}


def test_names_change_at_every_level(spark):
    df = spark.createDataFrame(ROWS, DEEP)
    out = S.rename_nested(df, NAMES)
    assert out.schema.simpleString() == (
        "struct<id:int,rates:array<struct<plan:int,tiers:array<struct<name:string,c:struct<amount:int,w:string>>>>>,m:map<string,struct<value:int>>>"
    )
    plain = lambda rows: [tuple(r) for r in sorted(rows, key=lambda r: r[0])]
    assert plain(out.collect()) == plain(df.collect())
    # projections only: nothing is exploded or shuffled
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("names, why", [({"a.nope": "x"}, "no such"), ({"a.b.y": "c"}, "same name"), ({"id": "m"}, "same name")])
def test_impossible_names(spark, names, why):
    with pytest.raises(ValueError, match=why):
        S.rename_nested(spark.createDataFrame([], DEEP), names)


def test_names_with_blanks_and_no_names(spark):
    df = spark.createDataFrame([((1,),)], "`a b` struct<`c d`:int>")
    assert S.rename_nested(df, {"a b.c d": "e"}).schema.simpleString() == "struct<a b:struct<e:int>>"
    assert S.rename_nested(df, {}).schema == df.schema


def test_nested_types_are_aligned(spark):
    df = spark.createDataFrame(ROWS, DEEP)
    want = T.StructType.fromDDL(
        "m map<string, struct<u:string, v:bigint>>, a array<struct<b:array<struct<c:struct<w:string, z:string, n:date>, y:string>>>>, extra double, id bigint"
    )
    got = {r.id: r for r in S.align_schema(df, want).collect()}
    assert S.align_schema(df, want).schema.simpleString() == want.simpleString()
    assert got[1].m == {"k": (None, 5), "n": None}
    assert got[1].a == [([(("q", "7", None), "p"), (None, "r"), None],), (None,), None]
    assert got[2].a is None and got[2].m is None and got[2].extra is None
    assert got[3].a == [] and got[3].m == {}
    assert S.align_schema(df, df.schema).schema == df.schema


def test_schema_sync_with_a_type(spark):
    df = spark.createDataFrame([((1, "2024-02-29"), 5)], "s struct<a:int, d:string>, n int")
    want = T.StructType.fromDDL("n string, s struct<d:date>")
    assert [tuple(r) for r in S.sync_schema(df, want).collect()] == [("5", (date(2024, 2, 29),))]
    with pytest.raises(ValueError, match="missing"):
        S.sync_schema(df, T.StructType.fromDDL("zzz int"))


def test_layouts_evolve_at_depth(spark):
    old = spark.createDataFrame([(1, [(1,)])], "k int, r array<struct<amt:int>>")
    new = spark.createDataFrame([(2, [(2, "x")])], "k int, r array<struct<amount:bigint, code:string>>")
    want = T.StructType.fromDDL("k int, r array<struct<amount:decimal(9,2), code:string>>")
    out = C.evolve(old, new, want, {"r.amt": "amount"})
    assert sorted((r.k, [tuple(x) for x in r.r]) for r in out.collect()) == [(1, [(1, None)]), (2, [(2, "x")])]
    with_names = C.evolve(old, new.select("k"), {"k": "bigint"}, {"r.amt": "amount"})
    assert with_names.schema.simpleString() == "struct<k:bigint,r:array<struct<amount:int>>>"
