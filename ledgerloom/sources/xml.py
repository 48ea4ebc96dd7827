"""XML rows: several row tags per file, flattened to leaf columns; XSD validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialize


def leaf_columns(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, leaf name) of every leaf of nested structs; a repeated leaf name gets its parents' names."""
    found: list[tuple[str, str]] = []
    for f in schema.fields:
        path = f"{prefix}`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            found += leaf_columns(f.dataType, path + ".")
        else:
            found.append((path, f.name))
    if prefix:
        return found
    names = [n for _, n in found]
    return [(p, n if names.count(n) == 1 else p.replace("`", "").replace(".", "_")) for p, n in found]


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to one column per leaf tag."""
    return df.select(*[F.col(p).alias(n) for p, n in leaf_columns(df.schema)])


def read_rows(spark: SparkSession, path: str, row_tag: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Rows of one tag, flattened. Give a schema for large files: inference reads them once more."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return flatten((reader.schema(schema) if schema else reader.option("inferSchema", False)).load(path))


def read_tags(spark: SparkSession, path: str, row_tags: Sequence[str]) -> dict[str, DataFrame]:
    return {tag: read_rows(spark, path, tag) for tag in row_tags}


def read_validated(
    spark: SparkSession, path: str, row_tag: str, xsd_path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the XSD, and the raw text of those that do not; the text is parsed once."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = (
        spark.read.format("xml").option("rowTag", row_tag).option("rowValidationXSDPath", xsd_path)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(wide).load(path)
    )
    rows = materialize(rows, "xml")
    bad = F.col("_corrupt_record").isNotNull()
    return rows.filter(~bad).drop("_corrupt_record"), rows.filter(bad).select("_corrupt_record")


def write_rows(df: DataFrame, path: str, root_tag: str, row_tag: str, drop_empty: bool = True) -> None:
    """Rows as XML; NULL and (by default) empty text elements are left out."""
    if drop_empty:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: _or_null(c) for c in text})
    df.write.format("xml").option("rootTag", root_tag).option("rowTag", row_tag).save(path)


def _or_null(c: str) -> Column:
    return F.nullif(F.col(c), F.lit(""))
