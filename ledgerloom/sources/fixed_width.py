"""Fixed-width records: layouts, parsing, segment files, formatting and EBCDIC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import fixed_text
from ledgerloom.session import scratch_path
from ledgerloom.sources.files import placed_lines


@dataclass(frozen=True)
class Field:
    """One field of a record; ``start`` counts from 1, ``side`` names where padding goes."""

    name: str
    start: int
    length: int
    pad: str = " "
    side: str = "left"
    kind: str = "string"


def parse_layout(lines: Sequence[str]) -> list[Field]:
    """Layout from ``name:start:length:pad:align[:type]`` texts; align R pads on the right."""
    out = []
    for line in lines:
        parts = line.split(":")
        if len(parts) < 5:
            raise ValueError(f"layout needs name:start:length:pad:align, got {line!r}")
        name, start, length, pad, align = parts[:5]
        if not length.strip().isdigit():
            raise ValueError(f"length {length!r} of column {name!r} is not an integer")
        kind = parts[5].lower() if len(parts) > 5 else "string"
        out.append(
            Field(name, int(start), int(length), pad or " ", "right" if align.upper() == "R" else "left", kind)
        )
    return out


def parse_records(lines: DataFrame, layout: Sequence[Field], column: str = "value") -> DataFrame:
    """Cut each line by the layout; text fields lose outer blanks, others are NULL when unreadable."""

    def cell(f: Field) -> Column:
        raw = F.trim(F.substring(column, f.start, f.length))
        return raw if f.kind == "string" else raw.try_cast("decimal(38,9)" if f.kind == "decimal" else f.kind)

    return lines.select(*[cell(f).alias(f.name) for f in layout])


def read_fixed_width(spark: SparkSession, path: str, layout: Sequence[Field]) -> DataFrame:
    return parse_records(spark.read.text(path), layout)


class UnknownSegments(ValueError):
    """The file holds records whose segment has no layout."""


def read_segments(
    spark: SparkSession,
    path: str,
    layouts: Mapping[str, Sequence[Field]],
    id_start: int = 1,
    id_length: int = 1,
    ignore: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Split a file of mixed records by segment id; one parsed DataFrame per layout.

    The file is scanned once and its lines are written by segment, so that each segment later reads only its own
    lines. Records of other segments raise ``UnknownSegments`` unless listed in ``ignore``; blank lines are skipped.
    """
    lines = spark.read.text(path).withColumn("segment", F.substring("value", id_start, id_length))
    lines = lines.filter((F.trim("value") != "") & ~F.col("segment").isin(*ignore))
    known = F.col("segment").isin(*layouts)
    lines = lines.withColumn("segment", F.when(known, F.col("segment")).otherwise(F.lit("__unknown__")))
    by_segment = scratch_path(spark, "segments")
    lines.write.partitionBy("segment").parquet(by_segment)
    lines = spark.read.schema("value string, segment string").parquet(by_segment)
    unknown = [r.value for r in lines.filter("segment = '__unknown__'").limit(3).collect()]
    if unknown:
        raise UnknownSegments(f"{path} has records of no known segment, such as {unknown}")
    return {s: parse_records(lines.filter(F.col("segment") == s), layout) for s, layout in layouts.items()}


def format_records(df: DataFrame, layout: Sequence[Field], name: str = "line") -> DataFrame:
    """Rows to fixed-width lines; a gap between fields is filled with blanks."""
    pieces, at = [], 1
    for f in sorted(layout, key=lambda x: x.start):
        if f.start < at:
            raise ValueError(f"field {f.name!r} overlaps the one before it")
        if f.start > at:
            pieces.append(F.lit(" " * (f.start - at)))
        pieces.append(fixed_text(f.name, f.length, f.pad, f.side, f.kind))
        at = f.start + f.length
    return df.withColumn(name, F.concat(*pieces))


def template_line(template: str | Mapping | Sequence, record_count: Column) -> Column:
    """Header or footer line from a text, a piece or a list of pieces.

    ``{record_count}`` stands for the number of records. A piece is a mapping with ``template`` or
    ``value`` and optionally ``length``, ``pad_value``, ``pad_type`` and ``data_type``.
    """
    if isinstance(template, str):
        parts = template.split("{record_count}")
        pieces = [F.lit(parts[0])]
        for p in parts[1:]:
            pieces += [record_count.cast("string"), F.lit(p)]
        return F.concat(*pieces)
    if isinstance(template, Mapping):
        text = template_line(template.get("template") or template.get("value", ""), record_count)
        side = template.get("pad_type", "right")
        if side not in ("left", "right"):
            raise ValueError(f"pad_type must be left or right, not {side!r}")
        length = template.get("length", 0)
        if not length:
            return text
        return fixed_text(text, length, template.get("pad_value", " "), side, template.get("data_type", "string"))
    return F.concat(*[template_line(t, record_count) for t in template])


def convert_delimited(
    spark: SparkSession,
    source: str,
    layout: Sequence[Field],
    target: str,
    sep: str = ",",
    has_header: bool = True,
    keep_header: bool = False,
    header: str | Mapping | Sequence | None = None,
    footer: str | Mapping | Sequence | None = None,
    max_bad_records: int = 0,
) -> None:
    """A delimited file to a fixed-width file in the order of its lines, as ordered shards.

    The first line is the input's header if ``has_header``: skipped, or with ``keep_header`` written like a record.
    ``header`` and ``footer`` are templates (see ``template_line``) that may count the records. A line whose number of fields is not that of the
    layout is bad: more than ``max_bad_records`` of them are an error before anything is written, fewer are left out.
    """
    lines = placed_lines(spark, source).filter("value <> ''")
    fields = sorted(layout, key=lambda f: f.start)
    names = ", ".join(f"`{f.name}` STRING" for f in fields) + ", `_bad` STRING"
    if has_header and not keep_header:
        first = lines.agg(F.min("at").alias("_first"))
        lines = lines.crossJoin(F.broadcast(first)).filter(F.col("at") != F.col("_first")).drop("_first")
    parsed = F.from_csv("value", names, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.select("at", parsed.alias("r")).select("at", "r.*")
    # every column is a text, so that only the number of fields can be wrong
    bad = rows.filter("_bad IS NOT NULL").select("_bad").limit(max_bad_records + 1).collect()
    if len(bad) > max_bad_records:
        raise ValueError(f"column count mismatch: expected {len(fields)} values in {bad[-1]['_bad']!r}")
    rows = rows.filter("_bad IS NULL").drop("_bad")
    body = format_records(rows, layout).select(F.lit(1).alias("part"), "at", "line")
    count = rows.agg(F.count(F.lit(1)).alias("record_count"))
    for part, template in ((0, header), (2, footer)):
        if template is not None:
            edge = count.select(F.lit(part).alias("part"), template_line(template, F.col("record_count")).alias("line"))
            body = body.unionByName(edge, allowMissingColumns=True)
    body.orderBy("part", "at").select("line").write.mode("overwrite").text(target)


def _code_page(charset: str) -> tuple[str, str]:
    """Characters of the charset and, position by position, the Latin-1 characters of their byte values."""
    source, target = [], []
    for byte in range(256):
        char = bytes([byte]).decode(charset)
        if char != chr(byte) and ord(char) < 256:
            source.append(char)
            target.append(chr(byte))
    return "".join(source), "".join(target)


def to_ebcdic(line: Column | str, length: int, charset: str = "cp037") -> Column:
    """Line padded with blanks to ``length`` and encoded in a single-byte EBCDIC code page; a longer line is an error.

    The code page is a permutation of Latin-1, so a character translation followed by the Latin-1
    encoding stays inside the JVM.
    """
    text = F.col(line) if isinstance(line, str) else line
    source, target = _code_page(charset)
    too_long = F.raise_error(F.format_string(f"record of %d characters does not fit into {length}", F.length(text)))
    fitted = F.when(F.length(text) > length, too_long.cast("string")).otherwise(F.rpad(text, length, " "))
    return F.encode(F.translate(fitted, source, target), "ISO-8859-1")


def write_ebcdic(df: DataFrame, path: str, order: Sequence[str], line: str, length: int, charset: str = "cp037") -> None:
    """Records of ``length`` bytes in ``order``, each followed by the code page's line feed.

    Written as shards by range, every task one stretch; their bytes in number order are the deliverable. A record is a
    string of byte values, which the delimited writer puts out byte by byte.
    """
    feed = "\n".encode(charset).decode("ISO-8859-1")
    text = F.decode(to_ebcdic(line, length, charset), "ISO-8859-1").alias("value")
    plain = {"sep": "\u0001", "quote": "", "escapeQuotes": "false", "emptyValue": ""}
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.orderBy(*order).select(text).write.mode("overwrite").options(**plain, **kept, lineSep=feed, encoding="ISO-8859-1").csv(path)


def from_ebcdic(data: Column | str, charset: str = "cp037") -> Column:
    raw = F.col(data) if isinstance(data, str) else data
    source, target = _code_page(charset)
    return F.translate(F.decode(raw, "ISO-8859-1"), target, source)
