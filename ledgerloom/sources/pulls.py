"""Database pulls: month and range chunks, partition predicates, bound queries, incremental windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_chunks(bounds: DataFrame, start: str, end: str, months: int) -> DataFrame:
    """(chunk_start, chunk_end) pairs: cut at every ``months``-th month start, ragged ends kept."""
    if not 1 <= months <= 12:
        raise ValueError("chunk size in months must lie between 1 and 12")
    s, e = F.col(start), F.col(end)
    first = F.when(F.dayofmonth(s) == 1, s).otherwise(F.add_months(F.trunc(s, "MM"), 1))
    steps = F.when(first <= e, F.sequence(first, e, F.expr(f"interval {int(months)} month"))).otherwise(
        F.array().cast("array<date>")
    )
    cuts = F.array_distinct(F.concat(F.array(s), steps, F.array(e)))
    pair = lambda i: F.struct(F.get("_cuts", i).alias("chunk_start"), F.get("_cuts", i + 1).alias("chunk_end"))
    with_cuts = bounds.withColumn("_cuts", cuts).filter(F.size("_cuts") > 1)
    numbers = F.sequence(F.lit(0), F.size("_cuts") - 2)
    return with_cuts.select(F.explode(F.transform(numbers, pair)).alias("p")).select("p.*")


def range_chunks(bounds: DataFrame, low: str, high: str, size: int) -> DataFrame:
    """(chunk_start, chunk_end) pairs of an id range; the last chunk is stretched to the upper bound.

    A range that fits into one chunk gives one pair.
    """
    if size <= 0:
        raise ValueError("chunk size must be positive")
    lo, hi = F.col(low).cast("long"), F.col(high).cast("long")
    whole = F.greatest(F.floor((hi - lo - 1) / size), F.lit(1)).cast("long")
    end = lambda i: F.when(i == whole - 1, hi).otherwise(lo + (i + 1) * size)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), whole - 1),
        lambda i: F.struct((lo + i * size).alias("chunk_start"), end(i).alias("chunk_end")),
    )
    return bounds.filter(lo < hi).select(F.explode(pairs).alias("p")).select("p.*")


def stride_predicates(column: str, lower: int, upper: int, partitions: int) -> list[str]:
    """Predicates that split a table on ``column``: the first takes NULLs, the outer two are open."""
    if lower >= upper:
        raise ValueError("lower bound must lie below the upper bound")
    n = max(1, min(partitions, upper - lower))
    if n == 1:
        return ["1 = 1"]
    cuts = [lower + (upper - lower) * i // n for i in range(1, n)]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *middle, f"{column} >= {cuts[-1]}"]


def day_predicates(column: str, chunks: Sequence[tuple[date, date]]) -> list[str]:
    """One half-open predicate per chunk."""
    return [f"{column} >= DATE '{a}' AND {column} < DATE '{b}'" for a, b in chunks]


def read_table(
    spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, partitions: int = 100,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parallel pull of a database table, one connection per predicate."""
    return spark.read.jdbc(
        url, table, predicates=stride_predicates(column, lower, upper, partitions), properties=dict(properties or {})
    )


def bound_query(text: str, bounds: Mapping[str, object]) -> str:
    """Fill ``{name}`` marks of a query with quoted literals; an unknown mark is an error."""
    def literal(v: object) -> str:
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    return text.format_map({k: literal(v) for k, v in bounds.items()})


def query_options(url: str, text: str, bounds: Mapping[str, object], fetch_size: int = 10000) -> dict[str, str]:
    """Reader options that pull a user query instead of a table."""
    return {"url": url, "dbtable": f"({bound_query(text, bounds)}) q", "fetchsize": str(fetch_size)}


def read_query(spark: SparkSession, url: str, text: str, bounds: Mapping[str, object], **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(url, text, bounds), **options).load()


def run_window(
    now: datetime, time_from: str = "00:00:00", time_to: str = "00:00:00", same_day: bool = False,
    override: tuple[datetime, datetime] | None = None,
) -> tuple[datetime, datetime]:
    """Window of an incremental run: yesterday's ``time_from`` (or today's) to today's ``time_to``."""
    if override:
        return override
    at = lambda d, t: datetime.combine(d, datetime.strptime(t, "%H:%M:%S").time())
    first = now.date() if same_day else now.date() - timedelta(days=1)
    return at(first, time_from), at(now.date(), time_to)


def incremental(df: DataFrame, column: str, window: tuple[datetime, datetime], control: DataFrame) -> DataFrame:
    """Rows in the half-open window; none when the control table's last window is this very one.

    ``control`` has ``load_from``, ``load_to`` and ``run_at``.
    """
    low, high = (F.lit(x).cast("timestamp_ntz") for x in window)
    last = control.agg(F.max_by(F.struct("load_from", "load_to"), "run_at").alias("_last"))
    seen = F.coalesce((F.col("_last.load_from") == low) & (F.col("_last.load_to") == high), F.lit(False))
    fresh = df.filter((F.col(column) >= low) & (F.col(column) < high))
    return fresh.crossJoin(F.broadcast(last)).filter(~seen).drop("_last")


def count_by_predicate(df: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Rows that each predicate selects, counted in one pass over ``df``."""
    hit: list[Column] = [F.count_if(F.expr(p)).alias(f"_{i}") for i, p in enumerate(predicates)]
    rows = F.array(
        *[F.struct(F.lit(i).cast("long").alias("chunk"), F.lit(p).alias("predicate"), F.col(f"_{i}").alias("n_rows"))
          for i, p in enumerate(predicates)]
    )
    return df.agg(*hit).select(F.inline(rows))
