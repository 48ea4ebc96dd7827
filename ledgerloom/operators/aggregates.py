"""Aggregation helpers; all of them combine map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize


def duplicates(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def latest_non_null(value: Column, *order: str) -> Column:
    """ARRAY_AGG(value IGNORE NULLS ORDER BY … DESC)[OFFSET(0)] without building the array."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def joined_distinct(df: DataFrame, keys: Sequence[str], column: str, name: str, separator: str = ",") -> DataFrame:
    """STRING_AGG of the distinct values in ascending order, reduced to distinct pairs first."""
    pairs = df.select(*keys, column).filter(F.col(column).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(column)), separator).alias(name))


def capped_grade(rate: Column, cap: float, step: float, top: int = 99) -> Column:
    """Rate to a grade from 1: ``top`` above the cap, 1 at or below zero, else rate/step rounded up."""
    return (
        F.when(rate > cap, F.lit(top)).when(rate <= 0, F.lit(1)).otherwise(F.ceil(rate / F.lit(step)))
    ).cast("long")


def latest_months(df: DataFrame, column: str, n: int) -> DataFrame:
    """One row: the newest month that has data, and the newest ``n`` months as text, newest first."""
    months = df.select(F.trunc(column, "MM").alias("m")).filter("m is not null").distinct().orderBy(F.desc("m")).limit(n)
    text = F.transform(F.sort_array(F.collect_list("m"), asc=False), lambda d: F.date_format(d, "yyyy-MM-dd"))
    return months.agg(F.max("m").alias("report_month"), text.alias("month_list"))


def sample_rows(df: DataFrame, order: Sequence[str], n: int, label: str) -> DataFrame:
    """First ``n`` rows written as a table of their own and read back."""
    return materialize(df.orderBy(*order).limit(n), label)
