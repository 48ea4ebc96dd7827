"""File readers: Parquet, CSV, JSON, record-type files, newest-file selection."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialize

_CORRUPT = "_corrupt_record"


def parquet_glob(spark: SparkSession, pattern: str, view: str | None = None) -> DataFrame:
    """Parquet files by glob, optionally registered as a view for SQL."""
    df = spark.read.parquet(pattern)
    if view:
        df.createOrReplaceTempView(view)
    return df


def _checked(spark: SparkSession, rows: DataFrame, names: Sequence[str], max_bad_records: int, what: object, label: str) -> DataFrame:
    """The good rows of (columns, _bad), written once; more than ``max_bad_records`` bad ones are an error."""
    flagged = materialize(rows, label)
    n_bad = flagged.filter("_bad").limit(max_bad_records + 1).count()
    if n_bad > max_bad_records:
        raise ValueError(f"more than {max_bad_records} bad records in {what}")
    return flagged.filter("not _bad").select(*names)


def placed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines with their place: ``value``, and ``at``, a struct (file, block, id) that orders them by file name and within the file.

    Files stay splittable: a line's place is its file, the start of the block it was read in, and its number there. Written once, as the
    numbers could differ in another scan.
    """
    at = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    return materialize(spark.read.text(path).select("value", at.alias("at")), "lines")


def without_leading(lines: DataFrame, n: int, but: str | None = None) -> DataFrame:
    """Lines but the first ``n`` of each file (of the file ``but`` none are left out).

    Only the first lines of each file are ranked, ``n`` from each task; a file with fewer lines goes as a whole.
    """
    if n <= 0:
        return lines
    rank = F.row_number().over(Window.partitionBy("at.file").orderBy("at"))
    first = lines.select("at").withColumn("_rank", rank).filter(F.col("_rank") <= n)
    if but is not None:
        first = first.filter(F.col("at.file") != but)
    # one row per file
    cuts = first.groupBy(F.col("at.file").alias("_file")).agg(F.max("at").alias("_cut"))
    joined = lines.join(cuts, F.col("at.file") == F.col("_file"), "left")
    return joined.filter(F.col("_cut").isNull() | (F.col("at") > F.col("_cut"))).select(*lines.columns)


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    max_bad_records: int = 0,
    ignore_unknown_values: bool = False,
    null_value: str | None = None,
    skip_leading_rows: int | None = None,
) -> DataFrame:
    """CSV scan; without a schema the types are inferred first, and the records then checked against them.

    The text is parsed once into a written table, because which records count as bad depends on the columns that
    are parsed. More than ``max_bad_records`` bad records are an error, fewer are dropped.
    ``ignore_unknown_values`` accepts records whose only fault is to have too many fields. ``skip_leading_rows`` leaves out that many lines of
    each file, whatever they hold, in place of the one line of ``header``; it needs a schema.
    """
    options = {"sep": sep} | ({} if null_value is None else {"nullValue": null_value})
    reader = spark.read.options(**options).option("header", header)
    if schema is None and skip_leading_rows is not None:
        raise ValueError("skip_leading_rows needs a schema")
    if schema is None:
        schema = reader.option("inferSchema", True).csv(path).schema
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    if skip_leading_rows is None:
        rows = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).option(
            "enforceSchema", True
        ).schema(wide).csv(path)
    else:
        lines = without_leading(placed_lines(spark, path), skip_leading_rows).filter("value <> ''")
        # the value of an absent text is read as by the scan: NULL
        parse = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "emptyValue": ""}
        rows = lines.select(F.from_csv("value", _ddl(wide), parse).alias("r")).select("r.*")
    bad = F.col(_CORRUPT).isNotNull()
    if ignore_unknown_values:
        # the record again, as texts and with quotes read as in the scan; further fields are left out
        ddl = ", ".join(f"_f{i} STRING" for i in range(len(schema)))
        rows = rows.withColumn("_again", F.from_csv(F.col(_CORRUPT), ddl, options))
        raw = [F.nullif(F.col(f"_again._f{i}"), F.lit("")) for i in range(len(schema))]
        unreadable = F.lit(False)
        for x, f in zip(raw, schema.fields, strict=True):
            unreadable = unreadable | (x.isNotNull() & x.try_cast(f.dataType).isNull())
        unquoted = F.regexp_replace(F.col(_CORRUPT), r'"(?:[^"\\]|\\.)*"', "q")
        fields = F.size(F.split(unquoted, "\\Q" + sep + "\\E", -1))
        accepted = F.coalesce(bad & (fields > len(schema)) & ~unreadable, F.lit(False))
        rows = rows.select(
            *[F.when(accepted, x.try_cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) for x, f in zip(raw, schema.fields, strict=True)],
            (bad & ~accepted).alias("_bad"),
        )
    else:
        rows = rows.withColumn("_bad", bad)
    return _checked(spark, rows, schema.names, max_bad_records, path, "csv")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, max_bad_records: int = 0) -> DataFrame:
    """Newline-delimited JSON with a fixed schema (no inference pass); malformed lines count as bad records."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).schema(wide).json(path)
    return _checked(spark, rows.withColumn("_bad", F.col(_CORRUPT).isNotNull()), schema.names, max_bad_records, path, "json")


def newest_file(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the most recently modified file below ``folder`` whose name matches ``pattern``.

    Only file metadata is read. The result is a single path.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        .select("path", "modificationTime")
        .filter(F.element_at(F.split("path", "/"), -1).rlike(f"^(?:{pattern})$"))
    )
    path = files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if path is None:
        raise FileNotFoundError(f"no file in {folder} matches {pattern}")
    return path


def newest_of(paths_and_times: Sequence[tuple[str, float]], pattern: str) -> str | None:
    """The same choice over a listing that the caller already has."""
    hits = [(m, p) for p, m in paths_and_times if re.fullmatch(pattern, p.rsplit("/", 1)[-1])]
    return max(hits)[1] if hits else None


def read_positional(
    spark: SparkSession,
    path: str,
    fields: Sequence[tuple[int, str, str]],
    record_type: str = "D",
    sep: str = ",",
    type_index: int = 0,
) -> DataFrame:
    """Rows of one record type from an untyped delimited file.

    ``fields`` gives (index, name, type); the file name is added as ``file_name``. Lines may have
    different numbers of fields, so they are split as text.
    """
    parts = F.split("value", "\\Q" + sep + "\\E", -1)
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), parts.alias("p"))
    detail = lines.filter(F.get("p", F.lit(type_index)) == record_type)
    return detail.select(
        *[F.nullif(F.get("p", F.lit(i)), F.lit("")).try_cast(kind).alias(name) for i, name, kind in fields], "file_name"
    )


def read_shards(spark: SparkSession, pattern: str, sep: str = ",", schema: str | None = None, max_bad_records: int = 0) -> DataFrame:
    """Many delimited shards that all repeat the header line, as one table; blank means NULL."""
    return read_csv(spark, pattern, schema, sep, max_bad_records=max_bad_records, null_value="")
