"""Joins beyond the plain equi join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ledgerloom.operators.ordered import fill_forward, over_neighbours
from ledgerloom.session import materialize, may_broadcast, settled


def spread_nulls(df: DataFrame, keys: Sequence[str], spare: int = 1024) -> Column:
    """A further join column: 0, or for a row with a NULL key a number from its other columns.

    Such rows match nothing under ``=``; with it they do not all meet in one task of a full outer join.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (MapType, StructType, ArrayType))]
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(missing, F.pmod(F.xxhash64(*plain), F.lit(spare)) + 1).otherwise(F.lit(0).cast("long"))


def full_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Full outer join on equal keys; the two sides have no column name in common."""
    on = reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in pairs])
    a = left.withColumn("_l_spread", spread_nulls(left, [x for x, _ in pairs]))
    b = right.withColumn("_r_spread", spread_nulls(right, [y for _, y in pairs]))
    return a.join(b, on & (F.col("_l_spread") == F.col("_r_spread")), "full").drop("_l_spread", "_r_spread")


def full_add(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Full outer join on unique keys; measures missing on one side count as zero."""
    side = lambda df, p: df.select(*[F.col(c).alias(f"{p}{c}") for c in (*keys, *measures)])
    joined = full_join(side(left, "l__"), side(right, "r__"), [(f"l__{k}", f"r__{k}") for k in keys])
    return joined.select(
        *[F.coalesce(f"l__{k}", f"r__{k}").alias(k) for k in keys],
        *[
            (F.coalesce(f"l__{m}", F.lit(0)) + F.coalesce(f"r__{m}", F.lit(0))).alias(m)
            for m in measures
        ],
    )


def band_join(
    df: DataFrame, bands: DataFrame, value: str, low: str, high: str, columns: Sequence[str], cells: int = 1024
) -> DataFrame:
    """Left join on ``value BETWEEN low AND high``.

    A small band table is sent to every task. A larger one is cut at quantiles of its lower bounds, so that
    the match becomes an equi join on the cell with the exact range as residual; each cell holds about as
    many bands, whatever the bounds' scale, and an open-ended last band reaches over the cells after it alone.
    """
    ref = bands.select(F.col(low).alias("_lo"), F.col(high).alias("_hi"), *columns)
    in_band = F.col(value).between(F.col("_lo"), F.col("_hi"))
    if may_broadcast(ref):
        return df.join(F.broadcast(ref), in_band, "left").drop("_lo", "_hi")
    marks = [k / cells for k in range(1, cells)]
    cuts = ref.agg(F.array_sort(F.array_distinct(F.percentile_approx(F.col("_lo").cast("double"), marks, 10_000))).alias("c"))
    # at most ``cells`` numbers
    edges = cuts.first()["c"] or []
    spread = ref.withColumn("_cell", F.explode(F.sequence(cell_of(F.col("_lo"), edges), cell_of(F.col("_hi"), edges))))
    # a NULL never matches: such rows get spare negative cells, so that they do not all meet in one task
    spare = -spread_nulls(df, [value])
    probe = df.withColumn("_probe", F.coalesce(cell_of(F.col(value), edges), spare))
    joined = probe.join(spread, (F.col("_probe") == F.col("_cell")) & in_band, "left")
    return joined.drop("_probe", "_cell", "_lo", "_hi")


def cell_of(x: Column, edges: Sequence[float], block: int = 32) -> Column:
    """Number of sorted ``edges`` at or below ``x``, found block by block; NULL for NULL."""
    if not edges:
        return F.when(x.isNotNull(), F.lit(0)).cast("long")
    of = lambda values: F.array(*[F.lit(float(v)) for v in values]).cast("array<double>")
    upto = lambda values: F.size(F.filter(values, lambda e: e <= x.cast("double")))
    blocks = upto(of(edges[block - 1 :: block])) * block
    return F.when(x.isNotNull(), (blocks + upto(F.slice(of(edges), blocks + 1, F.lit(block)))).cast("long"))


def proximity_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Rows with equal keys whose times (in whole seconds) differ by at most ``seconds``.

    The time is part of the join key, in slots of four times the limit: a hot key is spread over its
    slots and only near pairs are formed. A right row close to an edge is offered to the next slot too,
    so join types that keep unmatched right rows are refused: such a row would come twice.
    """
    if how.replace("_", "").lower() not in {"inner", "left", "leftouter", "leftsemi", "semi", "leftanti", "anti"}:
        raise ValueError(f"proximity_join does not support {how!r}; swap the sides")
    width = max(4 * seconds, 1)
    second = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    slot = lambda c: F.floor(F.col(c) / width).cast("long")
    a = left.withColumn("_ls", second(left_time)).withColumn("_lslot", slot("_ls"))
    b = right.withColumn("_rs", second(right_time))
    into = F.pmod(F.col("_rs"), F.lit(width))
    slots = F.array(
        slot("_rs"), F.when(into < seconds, slot("_rs") - 1), F.when(width - into <= seconds, slot("_rs") + 1)
    )
    b = b.withColumn("_rslot", F.explode(F.filter(slots, lambda x: x.isNotNull())))
    matches = reduce(lambda x, y: x & y, [F.col(x) == F.col(y) for x, y in keys])
    matches = matches & (F.col("_lslot") == F.col("_rslot")) & (F.abs(F.col("_ls") - F.col("_rs")) <= seconds)
    return a.join(b, matches, how).drop("_ls", "_lslot", "_rs", "_rslot")


def asof_join(
    points: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    point_time: str,
    event_time: str,
    columns: Sequence[str],
    tie: Sequence[str],
    keep_unmatched: bool = False,
) -> DataFrame:
    """For each point the ``columns`` of the last event of its key with ``event_time <= point_time``.

    Both sides are merged in time order and the last event is carried forward: one shuffle, no pair of
    rows is formed. ``tie`` orders events of equal time. ``keys`` are common to both sides. As in SQL, a
    NULL key or time matches nothing.
    """
    if not tie:
        raise ValueError("an as-of join needs columns that order events of equal time")
    known = lambda time: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, time)])
    rest = [c for c in points.columns if c not in keys]
    carried = events.filter(known(event_time)).select(
        *keys,
        F.col(event_time).alias("_at"),
        F.lit(0).alias("_side"),
        F.struct(*tie).alias("_tie"),
        F.struct(*columns).alias("_event"),
    )
    asked = points.filter(known(point_time)).select(
        *keys, F.col(point_time).alias("_at"), F.lit(1).alias("_side"), F.struct(*rest).alias("_point")
    )
    merged = carried.unionByName(asked, allowMissingColumns=True)
    filled = fill_forward(
        merged, keys, [F.col("_at"), F.col("_side"), F.col("_tie"), F.xxhash64("_point")], {"_event": "_last"}
    )
    out = filled.filter("_side = 1")
    if not keep_unmatched:
        out = out.filter(F.col("_last").isNotNull())
    out = out.select(
        *[F.col(c) if c in keys else F.col(f"_point.{c}") for c in points.columns],
        *[F.col(f"_last.{c}").alias(c) for c in columns],
    )
    if keep_unmatched:
        unknown = points.filter(~known(point_time)).select(
            *points.columns, *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in columns]
        )
        out = out.unionByName(unknown)
    return out


def validity_intervals(df: DataFrame, keys: Sequence[str], start: str, order: Sequence[Column], end: str) -> DataFrame:
    """Versions to half-open intervals: ``end`` is the start of the next version, NULL when open."""
    return over_neighbours(df, keys, order, lambda w: {end: F.lead(start).over(w)}, after=1)


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left_key NOT IN (SELECT right_key …)`` with SQL's NULL rules.

    An empty list keeps every row; a NULL in the list keeps none; a NULL key is kept only for an empty
    list. Written as an anti join plus a one-row summary, because Spark's own null-aware anti join
    broadcasts the list whatever its size.
    """
    listed = right.select(F.col(right_key).alias("_listed"))
    summary = F.broadcast(
        listed.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_listed").isNull()).alias("_nulls"))
    )
    unmatched = left.join(listed.filter(F.col("_listed").isNotNull()), F.col(left_key) == F.col("_listed"), "left_anti")
    keep = (F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(left_key).isNotNull())
    return unmatched.crossJoin(summary).filter(keep).drop("_n", "_nulls")


def lookup_join(df: DataFrame, lookup: DataFrame, spec: Mapping) -> DataFrame:
    """Join described by a mapping.

    ``columns``: lookup columns to bring in (they replace columns of the same name), ``on``: pairs of
    (column, lookup column), ``how``: join type, ``filters``: SQL conditions on the lookup.
    """
    if not spec.get("on"):
        raise ValueError("a lookup join needs key pairs under 'on'")
    wanted = list(spec["columns"])
    ref = reduce(lambda d, c: d.filter(c), spec.get("filters", []), lookup)
    ref = ref.select(
        *[F.col(r).alias(f"_on_{i}") for i, (_, r) in enumerate(spec["on"])],
        *[F.col(c).alias(f"_new_{c}") for c in wanted],
    )
    matches = reduce(
        lambda a, b: a & b, [F.col(x) == F.col(f"_on_{i}") for i, (x, _) in enumerate(spec["on"])]
    )
    joined = df.join(ref, matches, spec.get("how", "inner"))
    return joined.select(
        *[F.col(f"_new_{c}").alias(c) for c in wanted], *[c for c in df.columns if c not in wanted]
    )


def unique_keys_only(lookup: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Lookup rows whose key occurs exactly once; counted map-side, no group is buffered."""
    counted = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in columns])
    return settled(counted.filter("_n = 1").drop("_n"), "unique")


def fallback_lookup(
    df: DataFrame,
    specific: DataFrame,
    general: DataFrame,
    specific_keys: Sequence[str],
    general_keys: Sequence[str],
    value: str,
) -> DataFrame:
    """Value by the specific key, else by the general key."""
    a = settled(specific.select(*specific_keys, F.col(value).alias("_a")))
    b = settled(general.select(*general_keys, F.col(value).alias("_b")))
    out = df.join(a, list(specific_keys), "left").join(b, list(general_keys), "left")
    return out.withColumn(value, F.coalesce("_a", "_b")).drop("_a", "_b")


def merge_chain(
    edges: DataFrame, survivor: str, victim: str, depth: int, carry: Sequence[str] = ()
) -> DataFrame:
    """All (survivor, victim, carried values, depth) reached by following merges up to ``depth`` steps.

    Paths of up to m steps are joined with those of exactly m: paths of up to 2m steps, so the rounds grow with the logarithm of the depth.
    Each round's paths are written once. What a deeper search would add is in ``open_chains``.
    """
    base = edges.select(F.col(survivor).alias("survivor"), F.col(victim).alias("victim"), *carry)
    found = materialize(base.withColumn("depth", F.lit(1)), "chain")
    steps = 1
    while steps < depth:
        longest = found.filter(F.col("depth") == steps).select(F.col("victim").alias("_from"), F.col("survivor").alias("_to"))
        if longest.isEmpty():
            break
        further = found.filter(F.col("depth") <= depth - steps).join(longest, F.col("survivor") == F.col("_from"))
        further = further.select(F.col("_to").alias("survivor"), "victim", *carry, (F.col("depth") + steps).alias("depth"))
        found = found.unionByName(materialize(further, "chain"))
        steps *= 2
    return found


def open_chains(chain: DataFrame, edges: DataFrame, survivor: str, victim: str, depth: int) -> DataFrame:
    """The rows of ``merge_chain`` at ``depth`` that a further step would continue."""
    further = edges.select(F.col(victim).alias("_from"))
    return chain.filter(F.col("depth") == depth).join(further, F.col("survivor") == F.col("_from"), "left_semi")
