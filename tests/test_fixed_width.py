from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_text
from ledgerloom.sources import fixed_width as W


@pytest.mark.parametrize(
    "value, length, pad, side, kind, want",
    [
        ("7.5", 6, "0", "left", "decimal", "0007.5"),
        ("-9.25", 9, "0", "left", "decimal", "-00009.25"),
        ("-61", 7, "0", "left", "decimal", "-000061"),
        ("oak", 6, "_", "right", "string", "oak___"),
        ("mahogany", 3, " ", "right", "string", "mah"),
        ("-98765", 5, "0", "left", "decimal", "-9876"),
        ("elm", 8, "<>", "left", "string", "<><><elm"),
        (None, 2, ".", "right", "string", ".."),
    ],
)
def test_field(spark, value, length, pad, side, kind, want):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(fixed_text("v", length, pad, side, kind)).first()[0] == want


def test_decimal_padding_must_be_numeric():
    with pytest.raises(ValueError):
        fixed_text("v", 5, "x", "left", "decimal")


def test_row(spark):
    layout = W.parse_layout(["tree:1:6:_:R:string", "height:7:5:0:L:decimal", "plot:14:3:0:L:string"])
    df = spark.createDataFrame([("9", "yew", "-2.5")], "plot string, tree string, height string")
    assert W.format_records(df, layout).first()["line"] == "yew___-02.5  009"


def test_layout_text():
    f = W.parse_layout(["plot:1:3:0:L:string", "tree:4:8:_:R:string", "girth:12:6:0:L:DECIMAL", "z:18:1::R"])
    assert [(x.name, x.start, x.length, x.pad, x.side, x.kind) for x in f] == [
        ("plot", 1, 3, "0", "left", "string"),
        ("tree", 4, 8, "_", "right", "string"),
        ("girth", 12, 6, "0", "left", "decimal"),
        ("z", 18, 1, " ", "right", "string"),
    ]
    for bad in ("A:1:2", "A:1:two: :L"):
        with pytest.raises(ValueError):
            W.parse_layout([bad])


def test_overlapping_fields_are_refused(spark):
    layout = W.parse_layout(["a:1:5: :L", "b:4:5: :L"])
    with pytest.raises(ValueError):
        W.format_records(spark.createDataFrame([("x", "y")], "a string, b string"), layout)


@pytest.mark.parametrize(
    "template, want",
    [
        ("GROVE", "GROVE"),
        ("TREES={record_count};", "TREES=42;"),
        ({"value": "LOT", "length": 5, "pad_value": "-"}, "LOT--"),
        ([{"template": "A/"}, {"value": "{record_count}", "length": 4, "pad_value": "0", "pad_type": "left"}, "/Z"], "A/0042/Z"),
    ],
)
def test_header_and_footer(spark, template, want):
    assert spark.range(1).select(W.template_line(template, F.lit(42))).first()[0] == want


def test_pad_type_is_checked():
    with pytest.raises(ValueError):
        W.template_line({"value": "x", "length": 3, "pad_type": "middle"}, F.lit(1))


def test_ebcdic_equals_the_codec(spark):
    text = "Hello, World! 0123456789 {}[]~^|"
    df = spark.createDataFrame([(text,)], "line string").select(W.to_ebcdic("line", 40).alias("raw"))
    assert bytes(df.first()["raw"]) == text.ljust(40).encode("cp037")
    assert df.select(W.from_ebcdic("raw")).first()[0] == text.ljust(40)


def test_ebcdic_does_not_cut(spark):
    df = spark.createDataFrame([("x" * 11,)], "line string").select(W.to_ebcdic("line", 10).alias("raw"))
    with pytest.raises(Exception, match="does not fit"):
        df.collect()


def test_ebcdic_file(spark, tmp_path):
    rows = [(i, f"Tree {i:03d} <é&@> 'x, y'") for i in range(50)]
    df = spark.createDataFrame(rows, "n int, line string").repartition(4)
    W.write_ebcdic(df, str(tmp_path / "e"), ["n"], "line", 30)
    shards = sorted((tmp_path / "e").glob("part-*"))
    got = b"".join(p.read_bytes() for p in shards)
    assert got == b"".join(line.ljust(30).encode("cp037") + "\n".encode("cp037") for _, line in rows)


@pytest.mark.parametrize("keep", [False, True])
def test_delimited_to_fixed_width(spark, tmp_path, keep):
    (tmp_path / "in.csv").write_text('tree,height\n"yew, old",2\noak,31\n')
    layout = W.parse_layout(["tree:1:8:_:R:string", "height:9:6:0:L:string"])
    W.convert_delimited(spark, str(tmp_path / "in.csv"), layout, str(tmp_path / "out"), keep_header=keep, footer="N{record_count}")
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines()]
    records = ["yew, old000002", "oak_____000031"]
    assert lines == (["tree____height", *records, "N3"] if keep else [*records, "N2"])


def test_segments(spark, tmp_path):
    (tmp_path / "in.txt").write_text("H20240101\nA001  12\nB00105\nA002  -7\nT002\n")
    layouts = {"A": W.parse_layout(["id:2:3: :L:int", "n:5:4: :L:int"]), "B": W.parse_layout(["id:2:3: :L:int", "k:5:2: :L:int"])}
    with pytest.raises(W.UnknownSegments):
        W.read_segments(spark, str(tmp_path / "in.txt"), layouts)
    seg = W.read_segments(spark, str(tmp_path / "in.txt"), layouts, ignore=["H", "T"])
    assert sorted(tuple(r) for r in seg["A"].collect()) == [(1, 12), (2, -7)]
    assert [tuple(r) for r in seg["B"].collect()] == [(1, 5)]


def test_segments_of_a_large_file(spark, tmp_path, large):
    (tmp_path / "in.txt").write_text("".join(f"{'AB'[i % 2]}{i:04d}\n" for i in range(100)))
    layout = W.parse_layout(["n:2:4: :L:int"])
    seg = W.read_segments(spark, str(tmp_path / "in.txt"), {"A": layout, "B": layout})
    assert sorted(r[0] for r in seg["B"].collect()) == list(range(1, 100, 2))


def test_lines_with_a_wrong_number_of_fields_are_refused(spark, tmp_path):
    (tmp_path / "in.csv").write_text("name,n\noak\nelm,3,9\nash,7\n")
    layout = W.parse_layout(["name:1:4: :R", "n:5:3:0:L:int"])
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="column count mismatch: expected 2"):
        W.convert_delimited(spark, str(tmp_path / "in.csv"), layout, out)
    assert not (tmp_path / "out").exists()
    with pytest.raises(ValueError, match="mismatch"):
        W.convert_delimited(spark, str(tmp_path / "in.csv"), layout, out, max_bad_records=1)
    W.convert_delimited(spark, str(tmp_path / "in.csv"), layout, out, max_bad_records=2, footer="{record_count}")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["1", "ash 007"]
