"""Data-quality checks; each returns a DataFrame, gates raise on the driver."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import exact_amount, luhn_valid, strip, try_parse_date


def required_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row per required column: whether it exists (case-insensitive) and how many values it holds."""
    have = {c.lower(): c for c in df.columns}
    counts = [F.count(have[r.lower()]) if r.lower() in have else F.lit(0).cast("long") for r in required]
    one = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts)])
    rows = F.array(
        *[
            F.struct(F.lit(r).alias("column_name"), F.lit(r.lower() in have).alias("present"), F.col(f"_{i}").alias("n_values"))
            for i, r in enumerate(required)
        ]
    )
    return one.select(F.inline(rows))


def _is_empty(c: str) -> Column:
    return F.coalesce(strip(F.col(c).cast("string")) == "", F.lit(False))


def _named(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The table's own spelling of the column names (case-insensitive)."""
    have = {c.lower(): c for c in df.columns}
    return [have.get(c.lower(), c) for c in columns]


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def mandatory_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: all rows, rows with a NULL, with an empty, and with either in a mandatory column."""
    names = _named(df, columns)
    null, empty = _any([F.col(c).isNull() for c in names]), _any([_is_empty(c) for c in names])
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(null).alias("null_violations"),
        F.count_if(empty).alias("empty_violations"),
        F.count_if(null | empty).alias("total_violations"),
    ).withColumn("is_valid", F.col("total_violations") == 0)


def violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL or empty mandatory column; ``violation_type`` names NULL before empty."""
    names = _named(df, columns)
    null, empty = _any([F.col(c).isNull() for c in names]), _any([_is_empty(c) for c in names])
    kind = F.when(null, "NULL_VIOLATION").when(empty, "EMPTY_VIOLATION")
    return df.withColumn("violation_type", kind).filter(F.col("violation_type").isNotNull())


def date_int_problem(c: Column | str, low: int = 10000101, high: int = 99991231) -> Column:
    """Why a YYYYMMDD value is unusable: 'not a number', 'out of range' or 'not a date'.

    NULL when the value is a real date, and for a missing value, which is another check's matter.
    """
    raw = F.col(c) if isinstance(c, str) else c
    n = raw.cast("string").try_cast("long")
    real = try_parse_date(F.lpad(n.cast("string"), 8, "0"), "%Y%m%d").isNotNull()
    problem = F.when(n.isNull(), "not a number").when(~n.between(low, high), "out of range").when(~real, "not a date")
    return F.when(raw.isNotNull(), problem)


def date_int_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: values present, and how many of them are no date."""
    return df.filter(F.col(column).isNotNull()).agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(date_int_problem(column).isNotNull()).alias("invalid_format_count")
    )


def first_error(rules: Sequence[tuple[Column, str]]) -> Column:
    """Message of the first rule that fails (is not true); NULL when all hold."""
    first, *rest = [(~F.coalesce(ok, F.lit(False)), message) for ok, message in rules]
    out = F.when(first[0], F.lit(first[1]))
    for failed, message in rest:
        out = out.when(failed, F.lit(message))
    return out


def split_valid(df: DataFrame, rules: Sequence[tuple[Column, str]], name: str = "error") -> tuple[DataFrame, DataFrame]:
    """Valid rows, and invalid rows with the message of their first error."""
    checked = df.withColumn(name, first_error(rules))
    return checked.filter(F.col(name).isNull()).drop(name), checked.filter(F.col(name).isNotNull())


def trailer_counts(body: DataFrame, trailer: DataFrame, segment: str, expected: str) -> DataFrame:
    """Body rows per segment against the trailer's count.

    Match, Mismatch, Skipped for a count of zero, and Unreadable where the trailer has no number for a segment.
    """
    counted = body.groupBy(segment).agg(F.count(F.lit(1)).alias("n_rows"))
    given = F.col(expected).cast("string").try_cast("long")
    joined = trailer.select(segment, given.alias("n_expected")).join(counted, segment, "full")
    return joined.select(
        segment,
        "n_expected",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.when(F.col("n_expected").isNull() | (F.col("n_expected") < 0), "Unreadable")
        .when(F.col("n_expected") == 0, "Skipped")
        .when(F.col("n_expected") == F.coalesce("n_rows", F.lit(0)), "Match")
        .otherwise("Mismatch")
        .alias("status"),
    )


def totals_match(body: DataFrame, summary: DataFrame, amount: str, count_field: str, total_field: str) -> DataFrame:
    """Row count and amount total of a file against its one summary record; no row's amount is rounded."""
    total = F.coalesce(F.sum(exact_amount(body, amount)), F.lit(0))
    counted = body.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("total"))
    given = summary.agg(F.max(count_field).alias("_n"), F.max(exact_amount(summary, total_field)).alias("_t"))
    joined = counted.crossJoin(F.broadcast(given))
    ok = lambda a, b: F.when(F.col(a) == F.col(b), "Match").otherwise("Mismatch")
    both = (F.col("n_rows") == F.col("_n")) & (F.col("total") == F.col("_t"))
    return joined.select(
        "n_rows",
        F.col("total").cast("double").alias("total"),
        ok("n_rows", "_n").alias("count_status"),
        ok("total", "_t").alias("total_status"),
        F.when(both, "Match").otherwise("Mismatch").alias("validation_status"),
    )


def gate(df: DataFrame, limit: int) -> DataFrame:
    """One row: number of exceptions and what to do (skip, continue, fail)."""
    n = F.col("n_exceptions")
    return df.agg(F.count(F.lit(1)).alias("n_exceptions")).withColumn(
        "decision", F.when(n == 0, "skip").when(n > limit, "fail").otherwise("continue")
    )


def require_at_most(df: DataFrame, limit: int) -> int:
    """Raise when ``df`` has more than ``limit`` rows; reads no more than it needs to know that."""
    n = df.limit(limit + 1).count()
    if n > limit:
        raise ValueError(f"more than {limit} exceptions")
    return n


def not_older_than_loaded(incoming: DataFrame, loaded: DataFrame, column: str) -> DataFrame:
    """One row: newest loaded date, incoming date, and whether the file may be loaded (not older)."""
    a = incoming.agg(F.max(column).alias("incoming_date"))
    b = loaded.agg(F.max(column).alias("loaded_date"))
    ok = F.col("loaded_date").isNull() | (F.col("incoming_date") >= F.col("loaded_date"))
    return a.crossJoin(F.broadcast(b)).withColumn("accepted", F.coalesce(ok, F.lit(False)))


def mod10(c: Column | str, length: int | None = None) -> Column:
    """'Valid' or 'Invalid' by the mod-10 check and, when given, the number of digits."""
    ok = luhn_valid(c)
    if length is not None:
        ok = ok & (F.length(c) == length)
    return F.when(F.coalesce(ok, F.lit(False)), "Valid").otherwise("Invalid")


def csv_problems(columns: Sequence[str], file_name: str, required: Sequence[str]) -> Mapping[str, bool]:
    """File-level checks before any row is read."""
    have = {c.lower() for c in columns}
    return {
        "extension": file_name.lower().endswith(".csv"),
        "required": reduce(lambda a, b: a and b, [r.lower() in have for r in required], True),
    }
