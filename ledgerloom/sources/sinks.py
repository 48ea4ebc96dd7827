"""Writers: shards, delimited and fixed-width deliverables, control files, events, databases."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import fits_bytes, minor_units
from ledgerloom.operators.changes import merge
from ledgerloom.operators.ordered import positions
from ledgerloom.sources.files import placed_lines, without_leading
from ledgerloom.sources.tables import _fs


def without_delimiter(df: DataFrame, sep: str) -> DataFrame:
    """Remove the delimiter from every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.replace(F.col(c), F.lit(sep), F.lit("")) for c in text})


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    without_delimiter(df, sep).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def with_header_trailer(
    body: DataFrame, line: str, order: Sequence[str], header: Column, trailer: Column, totals: Mapping[str, Column]
) -> DataFrame:
    """Header, body and trailer lines with sort columns ``part`` and ``order``.

    ``header`` and ``trailer`` may use ``record_count`` and the named ``totals``, which one
    pre-aggregated pass over the body computes.
    """
    sums = body.agg(F.count(F.lit(1)).alias("record_count"), *[c.alias(n) for n, c in totals.items()])
    edge = lambda c, part: sums.select(F.lit(part).alias("part"), c.alias("line"))
    middle = body.select(F.lit(1).alias("part"), *order, F.col(line).alias("line"))
    return middle.unionByName(edge(header, 0), allowMissingColumns=True).unionByName(
        edge(trailer, 2), allowMissingColumns=True
    )


def control_file(
    records: DataFrame, batch: str, order: Sequence[str], line: str, amount: str,
    file_header: str, file_trailer: str, batch_header: str, batch_trailer: str,
) -> DataFrame:
    """Lines of a batched file with sort columns (batch, part, order).

    The four templates are ``format_string`` texts: file header (no value), file trailer (batches,
    records, cents), batch header (batch), batch trailer (batch, records, cents). Totals come from one
    aggregation per batch; no batch is gathered anywhere.
    """
    total = F.sum(minor_units(records, amount)).cast("long")
    per_batch = records.groupBy(batch).agg(F.count(F.lit(1)).alias("_n"), total.alias("_c"))
    whole = per_batch.agg(F.count(F.lit(1)).alias("_b"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"), F.coalesce(F.sum("_c"), F.lit(0)).alias("_c"))
    rows = lambda df, section, key, part, text: df.select(
        F.lit(section).alias("section"), key.alias("batch"), F.lit(part).alias("part"), text.alias("line")
    )
    none = F.lit(None).cast(records.schema[batch].dataType)
    body = records.select(F.lit(1).alias("section"), F.col(batch).alias("batch"), F.lit(1).alias("part"), *order, F.col(line).alias("line"))
    edges = [
        rows(whole, 0, none, 0, F.lit(file_header)),
        rows(per_batch, 1, F.col(batch), 0, F.format_string(batch_header, F.col(batch))),
        rows(per_batch, 1, F.col(batch), 2, F.format_string(batch_trailer, F.col(batch), "_n", "_c")),
        rows(whole, 2, none, 0, F.format_string(file_trailer, "_b", "_n", "_c")),
    ]
    for e in edges:
        body = body.unionByName(e, allowMissingColumns=True)
    return body


def write_ordered_lines(df: DataFrame, path: str, order: Sequence[str], line: str = "line", windows: bool = False) -> None:
    """Text shards in global order: their bytes in name order are the deliverable.

    Written by range, so every task handles one stretch of the file.
    """
    ordered = df.orderBy(*order).select(line)
    ordered.write.mode("overwrite").option("lineSep", "\r\n" if windows else "\n").text(path)


def shard_number(path: str) -> int:
    """Number of a shard: ``part-100000…`` comes after ``part-99999…``, which the order of names gets wrong."""
    return int(re.match(r"part-(\d+)", path.rsplit("/", 1)[-1])[1])


def read_ordered_lines(spark: SparkSession, path: str, windows: bool = False) -> DataFrame:
    """Lines of ordered shards with their number in the whole file (from 1): (line_no, value)."""
    lines = spark.read.option("lineSep", "\r\n" if windows else "\n").text(path)
    shard = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    # a shard may be read by several tasks: their stretches are ordered by where they start
    lines = lines.select(
        "value", shard.alias("shard"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id")
    )
    return positions(lines, [], [F.col("shard"), F.col("block"), F.col("id")], "line_no").select("line_no", "value")


def compose(spark: SparkSession, shards: str, target: str) -> None:
    """Join the shards of ``write_ordered_lines`` into one file.

    A store that can concatenate does so by itself, without moving data. Otherwise the bytes are copied
    in blocks; nothing is held in memory, but the copy runs at the speed of one stream.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, folder = _fs(spark, shards)
    names = [s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    parts = sorted(names, key=shard_number)
    target_path = jvm.org.apache.hadoop.fs.Path(target)
    if fs.getScheme() in ("hdfs", "abfs", "abfss"):
        fs.create(target_path, True).close()
        sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, p in enumerate(parts):
            sources[i] = jvm.org.apache.hadoop.fs.Path(p)
        fs.concat(target_path, sources)
        return
    out = fs.create(target_path, True)
    try:
        for p in parts:
            source = fs.open(jvm.org.apache.hadoop.fs.Path(p))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            source.close()
    finally:
        out.close()


def compose_files(
    spark: SparkSession, pattern: str | Sequence[str], path: str, windows: bool = False, empty_to_blank: bool = False, headers: int = 1
) -> int:
    """Join existing text files in the order of their names into ordered shards; returns the number of lines.

    The header (the first ``headers`` lines) of the first file that has lines stays, those of all others go; files without lines are
    passed over. ``windows`` ends lines with CRLF, ``empty_to_blank`` turns ``""`` into nothing. Lines are read by file block and written by range,
    so no task reads a whole file; ``compose`` makes one file of the shards. Every line ends with a line feed, the last ones of files too.
    """
    lines = placed_lines(spark, pattern)
    head = lines.agg(F.min("at.file")).first()[0]
    if head is None:
        raise FileNotFoundError(f"no lines in {pattern}")
    lines = without_leading(lines, headers, but=head)
    if empty_to_blank:
        lines = lines.withColumn("value", F.replace("value", F.lit('""'), F.lit("")))
    write_ordered_lines(lines, path, ["at"], "value", windows)
    return lines.count()


def typed_extract(df: DataFrame, target: Mapping[str, str]) -> DataFrame:
    """Fit columns to a narrower type system.

    ``varchar(n)`` keeps whole characters within n bytes, ``number(p,s)`` rounds to the scale (NULL when
    too large), ``timestamp(pattern)`` formats.
    """

    def fit(c: str, spec: str) -> Column:
        kind, _, inner = spec.rstrip(")").partition("(")
        kind = kind.strip().lower()
        if kind == "varchar":
            return fits_bytes(F.col(c).cast("string"), int(inner))
        if kind == "number":
            p, s = (int(x) for x in inner.split(","))
            return F.round(F.col(c).try_cast("decimal(38,9)"), s).try_cast(T.DecimalType(p, s))
        if kind == "timestamp":
            return F.date_format(c, inner)
        raise ValueError(f"unknown target type {spec!r}")

    return df.select(*[fit(c, spec).alias(c) for c, spec in target.items()])


def events(df: DataFrame, key: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Keyed messages: key as text, value as JSON of all columns under their event names."""
    renamed = df.withColumnsRenamed(dict(names or {}))
    k = (names or {}).get(key, key)
    return renamed.select(
        F.col(k).cast("string").alias("key"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )


def has_kafka(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def publish(messages: DataFrame, target: str, servers: str | None = None, mode: str = "append") -> bool:
    """Send messages to the topic ``target`` (with ``servers``) or to JSON files; False when there are none."""
    if messages.isEmpty():
        return False
    if servers:
        if not has_kafka(messages.sparkSession):
            raise RuntimeError("the Kafka connector is not on the class path")
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        messages.write.mode(mode).json(target)
    return True


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, connections: int = 16) -> None:
    """Insert the rows; ``connections`` bounds the sessions that write at once, not the tasks before them."""
    df.repartition(connections).write.jdbc(url, table, mode="append", properties=dict(properties or {}))


def upsert_statement(
    table: str, columns: Sequence[str], conflict: Sequence[str], update: Sequence[str] = (), append: Sequence[str] = ()
) -> str:
    """Parameterised INSERT … ON CONFLICT for one row; ``append`` columns add to the stored value."""
    q = lambda c: f'"{c}"'
    head = f"INSERT INTO {table} ({', '.join(map(q, columns))}) VALUES ({', '.join('?' * len(columns))})"
    target = f" ON CONFLICT ({', '.join(map(q, conflict))}) "
    if not update:
        return head + target + "DO NOTHING"
    new = [f"{q(c)} = EXCLUDED.{q(c)}" + (f" + {table}.{q(c)}" if c in append else "") for c in update]
    return head + target + "DO UPDATE SET " + ", ".join(new)


def upsert(
    stored: DataFrame, rows: DataFrame, conflict: Sequence[str], update: Sequence[str] = (), append: Sequence[str] = ()
) -> DataFrame:
    """What the table holds after the upsert: update, add to, or leave rows that exist; insert the rest."""
    rules = {
        c: (lambda t, s, c=c: s(c) + t(c)) if c in append else (lambda t, s, c=c: s(c)) for c in update
    }
    return merge(stored, rows, conflict, update=rules, insert=True)
