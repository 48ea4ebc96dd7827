"""Ordered and grouped computations that stay balanced when one key owns much of the data.

Small inputs use the plain Spark window. On large inputs the keys with very many rows are found by one
pre-aggregated count; only their rows take the block path, in which a key is cut into runs of rows
that separate tasks handle, and a short per-run summary carries state from run to run.

``bounded=True`` states that a key has few rows by construction, such as one per calendar month after
an aggregation; the search for hot keys is then left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerloom.session import BLOCK_ROWS, HOT_KEY_ROWS, is_small, materialize, multiplies, setting, settled

_ROW_MASK = (1 << 33) - 1


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality over ``pairs`` of (left column, right column)."""
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def split_hot(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of keys above the hot-key limit (None when there are none).

    Without keys all rows form one group, which counts as hot.
    """
    if not keys:
        return df.filter(F.lit(False)), df
    limit = setting(df.sparkSession, "hotKeyRows", HOT_KEY_ROWS)
    if multiplies(df):
        df = materialize(df, "split-input")  # three readers below: count, ordinary and hot rows
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    hot_keys = materialize(counts.select(*[F.col(k).alias(f"_hot_{k}") for k in keys]), "hot-keys")
    if hot_keys.isEmpty():
        return df, None
    matches = same_keys(df, hot_keys, [(k, f"_hot_{k}") for k in keys])
    return df.join(hot_keys, matches, "left_anti"), df.join(hot_keys, matches, "left_semi")


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "pos", bounded: bool = False
) -> DataFrame:
    """Number the rows of each key from 1 in ``order`` (a total order); no keys: one global sequence."""
    if bounded or is_small(df):
        spec = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(spec).cast("long"))
    if not keys:
        return _positions_by_range(df, keys, order, name)
    cold, hot = split_hot(df, keys)
    spec = Window.partitionBy(*keys).orderBy(*order)
    numbered = cold.withColumn(name, F.row_number().over(spec).cast("long"))
    if hot is None:
        return numbered
    return numbered.unionByName(_positions_by_range(hot, keys, order, name))


def _positions_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """Row numbers from a range partitioning: position in the run plus the rows of earlier runs."""
    by = [F.col(k) for k in keys] + list(order)
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_run", F.shiftright("_id", 33))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit(_ROW_MASK)))
        .drop("_id")
    )
    placed = materialize(placed, "runs")
    runs = placed.groupBy(*keys, "_run").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_run").alias("_k_run"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
    )
    pairs = [(k, f"_k_{k}") for k in keys] + [("_run", "_k_run")]
    joined = placed.join(offsets, same_keys(placed, offsets, pairs))
    return joined.select(*[placed[c] for c in df.columns], (F.col("_row") + F.col("_shift")).alias(name))


def over_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    add: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    bounded: bool = False,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``add`` gets the ordered window and returns the new columns (lag, lead, ROWS frames).
    """
    plain = Window.partitionBy(*keys).orderBy(*order)
    if bounded or is_small(df):
        return df.withColumns(add(plain))
    cold, hot = split_hot(df, keys)
    done = cold.withColumns(add(plain))
    if hot is None:
        return done
    size = max(setting(df.sparkSession, "blockRows", BLOCK_ROWS), before + 1, after + 1)
    numbered = _positions_by_range(hot, keys, order, "_pos")
    block = F.floor((F.col("_pos") - 1) / size).cast("long")
    at = F.pmod(F.col("_pos") - 1, F.lit(size))
    own = F.struct(block.alias("block"), F.lit(True).alias("own"))
    to_next = F.when(at >= size - before, F.struct((block + 1).alias("block"), F.lit(False).alias("own")))
    to_previous = F.when(at < after, F.struct((block - 1).alias("block"), F.lit(False).alias("own")))
    copies = F.filter(F.array(own, to_next, to_previous), lambda x: x.isNotNull())
    spread = numbered.withColumn("_copy", F.explode(copies)).select(
        *df.columns, "_pos", F.col("_copy.block").alias("_block"), F.col("_copy.own").alias("_own")
    )
    local = Window.partitionBy(*keys, "_block").orderBy("_pos")
    filled = spread.withColumns(add(local)).filter("_own").drop("_pos", "_block", "_own")
    return done.unionByName(filled)


def _with_carry(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    local: Callable[[WindowSpec], dict[str, Column]],
    summary: dict[str, Column],
    carry: Callable[[WindowSpec], dict[str, Column]],
    combine: dict[str, Column],
    bounded: bool = False,
) -> DataFrame:
    """Cumulative columns: ``local`` inside a block, ``summary`` per block, ``carry`` over earlier blocks."""
    frame = lambda spec: spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = frame(Window.partitionBy(*keys).orderBy(*order))
    if bounded or is_small(df):
        return df.withColumns(local(plain))
    cold, hot = split_hot(df, keys)
    done = cold.withColumns(local(plain))
    if hot is None:
        return done
    size = setting(df.sparkSession, "blockRows", BLOCK_ROWS)
    numbered = materialize(
        _positions_by_range(hot, keys, order, "_pos").withColumn(
            "_block", F.floor((F.col("_pos") - 1) / size).cast("long")
        ),
        "blocks",
    )
    tails = numbered.groupBy(*keys, "_block").agg(*[c.alias(n) for n, c in summary.items()])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.withColumns(carry(earlier)).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_k_block"),
        *[F.col(n) for n in carry(earlier)],
    )
    inside = numbered.withColumns(local(frame(Window.partitionBy(*keys, "_block").orderBy("_pos"))))
    pairs = [(k, f"_k_{k}") for k in keys] + [("_block", "_k_block")]
    joined = inside.join(carried, same_keys(inside, carried, pairs)).withColumns(combine)
    return done.unionByName(joined.select(*done.columns))


def fill_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: dict[str, str]
) -> DataFrame:
    """Last non-null value so far, per key; ``columns`` maps source column to new column."""
    return _with_carry(
        df,
        keys,
        order,
        local=lambda w: {new: F.last(c, ignorenulls=True).over(w) for c, new in columns.items()},
        summary={f"_t_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_pos"))) for c in columns},
        carry=lambda w: {f"_c_{c}": F.last(f"_t_{c}", ignorenulls=True).over(w) for c in columns},
        combine={new: F.coalesce(new, f"_c_{c}") for c, new in columns.items()},
    )


def _plus(a: Column, b: Column) -> Column:
    """The sum of what is there: NULL only if both are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, bounded: bool = False
) -> DataFrame:
    """Cumulative sum per key, one row per (keys, order): ties share one total, as a RANGE frame gives.

    Before the first value that is not NULL the total is NULL.
    """
    sums = df.groupBy(*keys, *order).agg(F.sum(value).alias("_sum"))
    return _with_carry(
        sums,
        keys,
        [F.col(c) for c in order],
        local=lambda w: {name: F.sum("_sum").over(w)},
        summary={"_t": F.sum("_sum")},
        carry=lambda w: {"_c": F.sum("_t").over(w)},
        combine={name: _plus(F.col(name), F.col("_c"))},
        bounded=bounded,
    ).drop("_sum")


def attach_group(df: DataFrame, keys: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Add whole-group aggregates to every row (what an unordered window gives).

    The groups are aggregated map-side and joined back, so that no task buffers a whole group; a large
    result is written first, which lets adaptive execution split the rows of a hot key in the join.
    """
    totals = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        *[c.alias(n) for n, c in values.items()]
    )
    if not keys:
        return df.crossJoin(F.broadcast(totals))
    totals = settled(totals, "groups")
    joined = df.join(totals, same_keys(df, totals, [(k, f"_g_{k}") for k in keys]), "left")
    return joined.select(*[df[c] for c in df.columns], *values)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1
) -> DataFrame:
    """First ``n`` rows per key in ``order``; Spark keeps ``n`` rows per task before it shuffles."""
    spec = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(spec)).filter(F.col("_rn") <= n).drop("_rn")


def ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False, bounded: bool = False
) -> DataFrame:
    """RANK and DENSE_RANK of every distinct (keys, order) value, with its row count.

    Rows are counted per value before the shuffle; join back on (keys, order) for row-level ranks.
    ``bounded``: a key has few distinct order values, such as calendar days.
    """
    counts = df.groupBy(*keys, *order).agg(F.count(F.lit(1)).alias("n_rows"))
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    numbered = positions(counts, keys, by, "dense_rank", bounded)
    return _with_carry(
        numbered,
        keys,
        by,
        local=lambda w: {"_upto": F.sum("n_rows").over(w)},
        summary={"_t": F.sum("n_rows")},
        carry=lambda w: {"_c": F.sum("_t").over(w)},
        combine={"_upto": F.col("_upto") + F.coalesce(F.col("_c"), F.lit(0))},
        bounded=bounded,
    ).withColumn("rank", F.col("_upto") - F.col("n_rows") + 1).drop("_upto")


def attach_ranks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False, bounded: bool = False
) -> DataFrame:
    """Every row with its ``rank`` and ``dense_rank``; ranked per distinct value, then joined back."""
    ranked = settled(ranks(df, keys, order, descending, bounded), "ranks")
    renamed = ranked.select(*[F.col(c).alias(f"_g_{c}") for c in (*keys, *order)], "rank", "dense_rank")
    joined = df.join(renamed, same_keys(df, renamed, [(c, f"_g_{c}") for c in (*keys, *order)]))
    return joined.select(*[df[c] for c in df.columns], "rank", "dense_rank")
