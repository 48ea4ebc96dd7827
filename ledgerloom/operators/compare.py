"""Comparing two tables and reconciling two records of the same flow."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.joins import full_join
from ledgerloom.session import computed_once, is_small, materialize

# statements that an expression may not contain (fixed values)
_UNSAFE = ("DROP", "DELETE", "INSERT", "UPDATE", "CREATE", "ALTER", "TRUNCATE", "MERGE", "GRANT", "REVOKE")

MISSING_IN_SOURCE = "MISSING_IN_SOURCE"
MISSING_IN_TARGET = "MISSING_IN_TARGET"
MISMATCH = "MISMATCH"


def type_category(data_type: T.DataType) -> str | None:
    """Comparison category of a column type: string, numeric, date, boolean or None."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    return "boolean" if isinstance(data_type, T.BooleanType) else None


def chain(column: str, expressions: Sequence[str]) -> str:
    """Nest expression templates: each one's word ``column`` stands for the result so far."""
    out = f"`{column}`"
    for e in expressions:
        if ";" in e or any(re.search(rf"\b{w}\b", e, re.IGNORECASE) for w in _UNSAFE):
            raise ValueError(f"unsafe expression: {e}")
        if not re.search(r"\bcolumn\b", e):
            raise ValueError(f"expression does not mention 'column': {e}")
        out = re.sub(r"\bcolumn\b", lambda _, inner=out: inner, e)
    return out


def compared_columns(
    source: DataFrame, target: DataFrame, keys: Sequence[str], given: Sequence[str] = (), exclude: Sequence[str] = ()
) -> list[str]:
    """Columns to compare: the given ones or all common ones, never keys, minus the excluded ones."""
    if set(exclude) & set(keys):
        raise ValueError("key columns cannot be excluded")
    common = [c for c in source.columns if c in target.columns]
    unknown = [c for c in (*keys, *given) if c not in common]
    if unknown:
        raise ValueError(f"not in both tables: {', '.join(unknown)}")
    return [c for c in (given or common) if c not in keys and c not in exclude]


def expressions_for(
    column: str,
    source: DataFrame,
    target: DataFrame,
    by_column: Mapping[str, Sequence[str]],
    by_type: Mapping[str, Sequence[str]],
) -> Sequence[str]:
    """A column's own expressions, else those of its type category when both sides share it."""
    if column in by_column:
        return by_column[column]
    a, b = type_category(source.schema[column].dataType), type_category(target.schema[column].dataType)
    return by_type.get(a, ()) if a is not None and a == b else ()


def _sides(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
    by_column: Mapping[str, Sequence[str]], by_type: Mapping[str, Sequence[str]],
) -> tuple[DataFrame, DataFrame]:
    """Both tables with keys, original and compared columns under names of their own."""

    def side(df: DataFrame, p: str) -> DataFrame:
        shaped = {c: F.expr(chain(c, expressions_for(c, source, target, by_column, by_type))) for c in columns}
        return df.select(
            *[F.col(k).alias(f"{p}k_{k}") for k in keys],
            *[F.col(c).alias(f"{p}o_{c}") for c in columns],
            *[e.alias(f"{p}c_{c}") for c, e in shaped.items()],
            F.lit(True).alias(f"{p}_here"),
        )

    return side(source, "s"), side(target, "t")


def digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits that are equal where the columns are equal, NULLs included; columns of plain types only."""
    parts = [F.lit(len(columns))]
    for c in columns:
        is_float = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
        # 0.0 and -0.0 are equal, and a hash passes over NULLs
        parts += [F.col(c) + F.lit(0.0) if is_float else F.col(c), F.col(c).isNull()]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *reversed(parts)).alias("b"))


def differing_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], columns: Sequence[tuple[str, str]]
) -> DataFrame:
    """One row per pair of rows that differ: the keys of both sides, ``l_here``, ``r_here`` and nothing else.

    What is shuffled is each side's keys and a digest of its columns. Columns whose types are not the same on both sides, or nested, are
    compared by their values.
    """
    plain = lambda a, b: left.schema[a].dataType == right.schema[b].dataType and not isinstance(
        left.schema[a].dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    )
    same = [(a, b) for a, b in columns if plain(a, b)]
    other = [(a, b) for a, b in columns if not plain(a, b)]
    x = left.select(
        *[F.col(k).alias(f"l_k{i}") for i, (k, _) in enumerate(keys)],
        digest(left, [a for a, _ in same]).alias("l_digest"),
        *[F.col(a).alias(f"l_v{i}") for i, (a, _) in enumerate(other)],
        F.lit(True).alias("l_here"),
    )
    y = right.select(
        *[F.col(k).alias(f"r_k{i}") for i, (_, k) in enumerate(keys)],
        digest(right, [b for _, b in same]).alias("r_digest"),
        *[F.col(b).alias(f"r_v{i}") for i, (_, b) in enumerate(other)],
        F.lit(True).alias("r_here"),
    )
    joined = full_join(x, y, [(f"l_k{i}", f"r_k{i}") for i in range(len(keys))])
    differs = F.col("l_here").isNull() | F.col("r_here").isNull() | (F.col("l_digest") != F.col("r_digest"))
    for i in range(len(other)):
        differs = differs | ~F.col(f"l_v{i}").eqNullSafe(F.col(f"r_v{i}"))
    names = [f"{p}_k{i}" for i in range(len(keys)) for p in "lr"]
    return joined.filter(differs).select(*names, "l_here", "r_here")


def _only_differing(
    left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], different: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The whole rows of both sides whose keys are among the ``different`` ones."""

    def kept(df: DataFrame, p: str, at: int) -> DataFrame:
        listed = different.filter(f"{p}_here").select(*[f"{p}_k{i}" for i in range(len(keys))]).distinct()
        met = reduce(lambda a, b: a & b, [F.col(k[at]).eqNullSafe(F.col(f"{p}_k{i}")) for i, k in enumerate(keys)])
        return df.join(listed, met, "left_semi")

    return kept(left, "l", 0), kept(right, "r", 1)


def _both_small(source: DataFrame, target: DataFrame) -> bool:
    return is_small(source, measure=False) and is_small(target, measure=False)


def row_diff(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] = (),
    exclude: Sequence[str] = (),
    by_column: Mapping[str, Sequence[str]] | None = None,
    by_type: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Rows that differ: keys, status, and an array with the original and compared value of both sides.

    Unless both tables are small, keys and digests are joined first, and whole rows are fetched for differing keys only.
    """
    return _row_diff(source, target, keys, columns, exclude, by_column, by_type)[0]


def _row_diff(source, target, keys, columns=(), exclude=(), by_column=None, by_type=None) -> tuple[DataFrame, DataFrame | None]:
    """The report and, if it was made in two phases, the pairs that differ."""
    chosen = compared_columns(source, target, keys, columns, exclude)
    different = None
    if not _both_small(source, target):
        source, target = computed_once(source, "compare-source"), computed_once(target, "compare-target")
    s, t = _sides(source, target, keys, chosen, by_column or {}, by_type or {})
    pairs = [(f"sk_{k}", f"tk_{k}") for k in keys]
    if not _both_small(source, target):
        different = differing_keys(s, t, pairs, [(f"sc_{c}", f"tc_{c}") for c in chosen])
        different = materialize(different, "differing")
        s, t = _only_differing(s, t, pairs, different)
    joined = full_join(s, t, pairs)
    differs = {c: ~F.col(f"sc_{c}").eqNullSafe(F.col(f"tc_{c}")) for c in chosen}
    in_source, in_target = F.col("s_here").isNotNull(), F.col("t_here").isNotNull()
    any_diff = reduce(lambda a, b: a | b, differs.values(), F.lit(False))
    status = (
        F.when(~in_source, MISSING_IN_SOURCE).when(~in_target, MISSING_IN_TARGET).when(any_diff, MISMATCH)
    )

    def detail(name: str, *values: Column) -> Column:
        labels = ("source_original_value", "target_original_value", "source_transformed_value", "target_transformed_value")
        return F.struct(F.lit(name).alias("column_name"), *[v.cast("string").alias(x) for x, v in zip(labels, values)])

    none, missing = F.lit(None), F.col("record_comparison_status")
    whole = detail(
        "record_status",
        F.when(in_target, none).otherwise(missing), F.when(in_source, none).otherwise(missing),
        F.when(in_target, none).otherwise(missing), F.when(in_source, none).otherwise(missing),
    )
    cells = F.array(
        *[
            F.when(d, detail(c, F.col(f"so_{c}"), F.col(f"to_{c}"), F.col(f"sc_{c}"), F.col(f"tc_{c}")))
            for c, d in differs.items()
        ]
    )
    details = F.when(in_source & in_target, F.filter(cells, lambda x: x.isNotNull())).otherwise(F.array(whole))
    report = (
        joined.withColumn("record_comparison_status", status)
        .filter(F.col("record_comparison_status").isNotNull())
        .select(
            *[F.coalesce(f"sk_{k}", f"tk_{k}").alias(k) for k in keys],
            "record_comparison_status",
            details.alias("differing_column_details"),
        )
    )
    return report, different


def diff_counts(report: DataFrame) -> DataFrame:
    """One row with the three counts of a report."""
    s = F.col("record_comparison_status")
    return report.agg(
        F.count_if(s == MISMATCH).alias("n_mismatch"),
        F.count_if(s == MISSING_IN_SOURCE).alias("n_missing_in_source"),
        F.count_if(s == MISSING_IN_TARGET).alias("n_missing_in_target"),
    )


def _pair_counts(different: DataFrame) -> DataFrame:
    """The counts of a report from the pairs that differ, without their rows."""
    left, right = F.col("l_here").isNotNull(), F.col("r_here").isNotNull()
    return different.agg(
        F.count_if(left & right).alias("n_mismatch"),
        F.count_if(~left).alias("n_missing_in_source"),
        F.count_if(~right).alias("n_missing_in_target"),
    )


def compare(source: DataFrame, target: DataFrame, keys: Sequence[str], **options) -> tuple[DataFrame, DataFrame]:
    """Report and counts; of large tables the counts come from the joined digests alone."""
    report, different = _row_diff(source, target, keys, **options)
    return report, diff_counts(report) if different is None else _pair_counts(different)


def schema_diff(source: DataFrame, target: DataFrame) -> list[tuple[str, str | None, str | None, str]]:
    """(column, source type, target type, discrepancy) for columns that differ."""
    s = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    t = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    out = []
    for c in [*s, *[x for x in t if x not in s]]:
        if c not in s:
            out.append((c, None, t[c], "COLUMN_MISSING_IN_SOURCE"))
        elif c not in t:
            out.append((c, s[c], None, "COLUMN_MISSING_IN_TARGET"))
        elif s[c] != t[c]:
            out.append((c, s[c], t[c], "DATA_TYPE_MISMATCH"))
    return out


def snapshot_delta(previous: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows between two snapshots, labelled insert, update or delete, with the newest values.

    Large snapshots are compared by digests first, as in ``row_diff``.
    """
    rest = [c for c in current.columns if c not in keys]
    if not _both_small(previous, current):
        previous, current = computed_once(previous, "delta-previous"), computed_once(current, "delta-current")
        pairs = [(k, k) for k in keys]
        different = materialize(differing_keys(previous, current, pairs, [(c, c) for c in rest]), "differing")
        previous, current = _only_differing(previous, current, pairs, different)
    p = previous.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.struct(*rest).alias("_old"))
    c = current.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.struct(*rest).alias("_new"))
    label = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    joined = full_join(p, c, [(f"_p_{k}", f"_c_{k}") for k in keys]).withColumn("change", label).filter("change is not null")
    newest = F.coalesce("_new", "_old")
    return joined.select(
        *[F.coalesce(f"_c_{k}", f"_p_{k}").alias(k) for k in keys], "change", *[newest[r].alias(r) for r in rest]
    )


def only_in(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], **constants: object) -> DataFrame:
    """Left rows without a partner on the right, with constant columns added, ready to be written back."""
    on = reduce(lambda a, b: a & b, [left[x] == right[y] for x, y in keys])
    return left.join(right, on, "left_anti").withColumns({k: F.lit(v) for k, v in constants.items()})


def reconcile(
    ours: DataFrame, theirs: DataFrame, key: str, amount: str, request: str, our_name: str, their_name: str
) -> DataFrame:
    """Two records of the same transfers: the first exception that applies, or 'N/A'."""
    a = ours.select(F.col(key).alias("_ak"), F.col(amount).alias("our_amount"), F.col(request).alias("our_request"))
    b = theirs.select(F.col(key).alias("_bk"), F.col(amount).alias("their_amount"), F.col(request).alias("their_request"))
    exception = (
        F.when(F.col("_bk").isNull(), F.lit(f"MISSING_AT_{their_name}"))
        .when(F.col("_ak").isNull(), F.lit(f"MISSING_AT_{our_name}"))
        .when(F.col("our_amount") != F.col("their_amount"), F.lit("AMOUNT_MISMATCH"))
        .when(F.col("our_request") != F.col("their_request"), F.lit("REQUEST_MISMATCH"))
        .otherwise(F.lit("N/A"))
    )
    return full_join(a, b, [("_ak", "_bk")]).select(
        F.coalesce("_ak", "_bk").alias(key), "our_amount", "their_amount", exception.alias("exception_type")
    )


def missing_events(
    issued: DataFrame, events: DataFrame, reported: DataFrame, key: str, event_key: str, reported_key: str
) -> DataFrame:
    """Issued keys with neither an event nor an earlier report."""
    return (
        issued.select(key).distinct()
        .join(events.select(F.col(event_key).alias("_e")), F.col(key) == F.col("_e"), "left_anti")
        .join(reported.select(F.col(reported_key).alias("_r")), F.col(key) == F.col("_r"), "left_anti")
    )


def copy_counts(source: DataFrame, copy: DataFrame, day: str, chunk: Column) -> DataFrame:
    """Row counts of source and copy per chunk of days: SUCCESS, FAILED, or ERROR without a copy."""
    counted = lambda df, n: df.groupBy(chunk.alias("chunk")).agg(F.count(F.lit(1)).alias(n))
    both = counted(source, "n_source").join(counted(copy, "n_copy"), "chunk", "full")
    a, b = F.coalesce("n_source", F.lit(0)), F.coalesce("n_copy", F.lit(0))
    status = F.when(F.col("n_copy").isNull(), "ERROR").when(a == b, "SUCCESS").otherwise("FAILED")
    return both.select("chunk", a.alias("n_source"), b.alias("n_copy"), status.alias("status"))
