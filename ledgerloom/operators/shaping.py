"""Projections, filters and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import zoned_local
from ledgerloom.session import may_broadcast


def add_drop_columns(df: DataFrame, add: Sequence[str] = (), drop: Sequence[str] | str = ()) -> DataFrame:
    """Keep every column but ``drop`` (``"*"``: keep none) and append the SQL expressions ``add``."""
    kept = [] if drop == "*" else [f"`{c}`" for c in df.columns if c not in drop]
    return df.selectExpr(*kept, *add)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by table; names that are not listed pass through."""
    return df.withColumnsRenamed(dict(names))


def _names_below(path: str, names: Mapping[str, str]) -> bool:
    return any(n.startswith(path + ".") for n in names)


def _renamed(value: Column, kind: T.DataType, path: str, names: Mapping[str, str]) -> Column:
    """``value`` with the new names of the fields below ``path``; NULLs stay NULL at every level."""
    if not _names_below(path, names):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _renamed(x, kind.elementType, path, names))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _renamed(x, kind.valueType, path, names))
    fields = []
    for f in kind.fields:
        below = f"{path}.{f.name}"
        fields.append(_renamed(value.getField(f.name), f.dataType, below, names).alias(names.get(below, f.name)))
    return F.when(value.isNotNull(), F.struct(*fields))


def _paths(kind: T.DataType, path: str) -> list[str]:
    """Paths of all fields below; arrays and map values add no step of their own."""
    if isinstance(kind, T.ArrayType):
        return _paths(kind.elementType, path)
    if isinstance(kind, T.MapType):
        return _paths(kind.valueType, path)
    if not isinstance(kind, T.StructType):
        return []
    return [p for f in kind.fields for p in (f"{path}.{f.name}", *_paths(f.dataType, f"{path}.{f.name}"))]


def rename_nested(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename fields at any depth: ``{"rates.tiers.amt": "amount"}``, with the paths of the old names.

    Arrays and map values are passed through by the path; nothing is exploded, and NULL arrays, elements and structs stay NULL. An unknown path, or two
    fields of one struct with the same new name, is an error.
    """
    known = [p for f in df.schema.fields for p in (f.name, *_paths(f.dataType, f.name))]
    if unknown := [p for p in names if p not in known]:
        raise ValueError(f"no such fields: {', '.join(unknown)}")
    new = [(p.rpartition(".")[0], names.get(p, p.rpartition(".")[2])) for p in known]
    if len(set(new)) < len(new):
        raise ValueError("two fields would have the same name")
    return df.select(
        *[_renamed(df[f"`{f.name}`"], f.dataType, f.name, names).alias(names.get(f.name, f.name)) for f in df.schema.fields]
    )


def aligned(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` as the type ``want``: fields by name, missing ones NULL, others cast, surplus ones left out, at every level."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name: f.dataType for f in have.fields}
        fields = [
            (aligned(value.getField(f.name), kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: aligned(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                aligned(e["key"], have.keyType, want.keyType).alias("key"),
                aligned(e["value"], have.valueType, want.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    return value.cast(want)


def align_schema(df: DataFrame, target: T.StructType | str) -> DataFrame:
    """The columns of ``target`` in its order and types, nested fields included; what is missing is NULL."""
    target = T.StructType.fromDDL(target) if isinstance(target, str) else target
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (aligned(df[f"`{f.name}`"], kinds[f.name], f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def sync_schema(df: DataFrame, target: Sequence[str] | T.StructType) -> DataFrame:
    """Project to the target's columns in its order; a missing column is an error.

    With a type as ``target`` columns are brought to its types as well, nested fields included.
    """
    names = target.names if isinstance(target, T.StructType) else list(target)
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing in the source: {', '.join(missing)}")
    return align_schema(df, target) if isinstance(target, T.StructType) else df.select(*names)


def local_times(df: DataFrame, zone: str = "America/Toronto", columns: Sequence[str] | None = None) -> DataFrame:
    """Every TIMESTAMP column (or ``columns``) as local wall time."""
    chosen = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)
    ]
    return df.withColumns({c: zoned_local(c, zone) for c in chosen})


def add_lineage(df: DataFrame, **values: object) -> DataFrame:
    """Append constant load metadata."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def case_map(column: Column | str, table: Mapping[str, str], otherwise: Column | None = None) -> Column:
    """Translate codes through a literal table; other values become ``otherwise`` or NULL."""
    c = F.col(column) if isinstance(column, str) else column
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    found = F.try_element_at(pairs, c)
    return found if otherwise is None else F.coalesce(found, otherwise)


def priority_case(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """Label of the first rule that holds."""
    first, *rest = rules
    out = F.when(first[0], F.lit(first[1]))
    for condition, label in rest:
        out = out.when(condition, F.lit(label))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def filter_all(df: DataFrame, conditions: Sequence[str] | None) -> DataFrame:
    """Rows that meet every SQL condition; all rows when there is none."""
    return reduce(lambda d, c: d.filter(c), conditions or [], df)


def within_lengths(limits: Mapping[str, int]) -> Column:
    """True when every named field fits its maximum length (NULL fits)."""
    return reduce(
        lambda a, b: a & b,
        [F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) <= n for c, n in limits.items()],
    )


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet ``condition`` and all others (false or NULL)."""
    ok = F.coalesce(condition, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def latest_load(df: DataFrame, load_column: str) -> DataFrame:
    """Rows of the most recent load."""
    newest = df.agg(F.max(load_column).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(load_column) == F.col("_newest"), "left_semi")


def unpivot(
    df: DataFrame, ids: Sequence[str], labels: Mapping[str, str], name: str = "name", value: str = "value"
) -> DataFrame:
    """Columns to rows under new labels; NULL values are dropped."""
    pairs = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for c, label in labels.items()])
    return (
        df.select(*ids, F.explode(pairs).alias("_p"))
        .select(*ids, f"_p.{name}", f"_p.{value}")
        .filter(F.col(value).isNotNull())
    )


def pivot_max(
    df: DataFrame, keys: Sequence[str], pivot: str, labels: Sequence[object], values: Mapping[str, str]
) -> DataFrame:
    """One row per key; for every label the maximum of each value, named ``<label>_<alias>``."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(pivot) == F.lit(label), F.col(c))).alias(f"{label}_{alias}")
            for label in labels
            for c, alias in values.items()
        ]
    )


def rank_to_wide(
    df: DataFrame, keys: Sequence[str], rank: str, values: Sequence[str], ranks: Sequence[int]
) -> DataFrame:
    """Month-rank rows to ``<value>_t0 … <value>_tn`` columns in one aggregation."""
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(rank) == r, F.col(v))).alias(f"{v}_t{i}")
            for v in values
            for i, r in enumerate(ranks)
        ]
    )


def latest_to_wide(df: DataFrame, keys: Sequence[str], period: str, values: Sequence[str], n: int) -> DataFrame:
    """The ``n`` newest periods of each key to ``<value>_t0 … <value>_t(n-1)`` columns.

    ``df`` has one row per key and period, so ranks are dense per key whatever periods are missing; a key has at most
    one row per calendar period.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(period).desc()))
    return rank_to_wide(df.withColumn("_rank", rank), keys, "_rank", values, range(1, n + 1))


def name_value_to_wide(df: DataFrame, pairs: str, names: Sequence[str]) -> DataFrame:
    """Array of (name, value) structs to one column per name; no shuffle, the row stays whole."""
    lookup = F.map_from_entries(F.col(pairs))
    return df.withColumns({n: F.try_element_at(lookup, F.lit(n)) for n in names}).drop(pairs)


def wide_to_name_value(columns: Sequence[str]) -> Column:
    """Columns to an array of (name, value) structs, values as text."""
    return F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    )


def date_series(spark: SparkSession, start: str, end: str, step: str = "interval 1 day", name: str = "d") -> DataFrame:
    """One row per date from ``start`` to ``end``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(step))).alias(name)
    )


def decode_by_table(
    df: DataFrame, codes: DataFrame, on: str, code: str, meaning: str, name: str, otherwise: Column | None = None
) -> DataFrame:
    """Translate ``on`` through a code table (a function that looks a value up, as a left join)."""
    lookup = codes.select(F.col(code).alias("_code"), F.col(meaning).alias("_meaning"))
    if may_broadcast(lookup):
        lookup = F.broadcast(lookup)
    out = df.join(lookup, F.col(on) == F.col("_code"), "left").drop("_code")
    value = F.col("_meaning") if otherwise is None else F.coalesce("_meaning", otherwise)
    return out.withColumn(name, value).drop("_meaning")
