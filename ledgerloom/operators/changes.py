"""Table changes (merge, update, delete, change capture) as DataFrame rewrites."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import key_hash
from ledgerloom.operators.ordered import attach_group, latest_per_key
from ledgerloom.operators.shaping import align_schema, rename_nested
from ledgerloom.session import computed_once, materialize, settled

#: Gets the target and the source column accessors, returns an expression.
Rule = Callable[[Callable[[str], Column], Callable[[str], Column]], Column]


def _has_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One source row per key, with the number of rows it stands for."""
    rest = [c for c in source.columns if c not in keys]
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Mapping[str, Rule] | None = None,
    when: Rule | None = None,
    insert: Mapping[str, Rule] | bool = False,
) -> DataFrame:
    """The target after MERGE … ON equal keys.

    ``update`` gives new values for matched rows (only those that meet ``when``); ``insert`` adds
    unmatched source rows, ``True`` meaning all columns by name. Rows with a NULL key never match. Several source
    rows for one key are an error if they would update a target row; unmatched, all of them are inserted.

    The target is joined to the source from the left, which lets Spark broadcast a small source and split a hot
    key of the target; what is to be inserted comes from an anti join to the target's keys. With both parts, each input is
    computed once: one that is more than a scan of files is written first.
    """
    update = update or {}
    if update and insert:
        target, source = computed_once(target, "merge-target"), computed_once(source, "merge-source")
    columns = target.columns
    t = lambda c: F.col(f"t__{c}")
    s = lambda c: F.col(f"s__{c}")
    t_rows = target.select(*[F.col(c).alias(f"t__{c}") for c in columns])
    merged = target
    if update:
        unique = settled(_per_key(source.filter(_has_keys(keys)), keys), "merge-source")
        s_rows = unique.select(*[F.col(c).alias(f"s__{c}") for c in source.columns], "_n")
        joined = t_rows.join(s_rows, reduce(lambda a, b: a & b, [t(k) == s(k) for k in keys]), "left")
        several = F.raise_error(F.lit("merge source has several rows for one key")).cast("boolean")
        changed = F.when(F.col("_n") > 1, several).otherwise(F.col("_n").isNotNull())
        if when is not None:
            changed = changed & F.coalesce(when(t, s), F.lit(False))

        def value(c: str) -> Column:
            kept = F.when(changed, update[c](t, s)).otherwise(t(c)) if c in update else t(c)
            return kept.cast(target.schema[c].dataType).alias(c)

        merged = joined.select(*[value(c) for c in columns])
    if not insert:
        return merged

    def inserted(c: str) -> Column:
        if insert is True:
            new = s(c) if c in source.columns else F.lit(None)
        else:
            new = insert[c](t, s) if c in insert else F.lit(None)
        return new.cast(target.schema[c].dataType).alias(c)

    known = target.select(*[F.col(k).alias(f"t__{k}") for k in keys])
    fresh = source.select(*[F.col(c).alias(f"s__{c}") for c in source.columns])
    fresh = fresh.join(known, reduce(lambda a, b: a & b, [t(k) == s(k) for k in keys]), "left_anti")
    return merged.unionByName(fresh.select(*[inserted(c) for c in columns]))


def insert_absent(target: DataFrame, source: DataFrame, identity: Callable[[DataFrame], Column]) -> DataFrame:
    """Add source rows whose ``identity`` (for example a row hash) the target lacks; NULL never matches."""
    known = target.select(identity(target).alias("_id"))
    fresh = source.withColumn("_own", identity(source)).join(known, F.col("_own") == F.col("_id"), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def cdc_hash_replace(
    target: DataFrame, source: DataFrame, keys: Sequence[str], separator: str | None = None
) -> DataFrame:
    """Drop target rows whose key hash occurs in the source, then add every source row with its hash.

    ``target`` has a ``cdc_hash`` column. A NULL key gives a NULL hash, which replaces nothing.
    """
    hashed = source.withColumn("cdc_hash", key_hash(keys, separator))
    incoming = hashed.select(F.col("cdc_hash").alias("_incoming"))
    kept = target.join(incoming, F.col("cdc_hash") == F.col("_incoming"), "left_anti")
    return kept.unionByName(hashed.select(*target.columns))


def _flagged(df: DataFrame, listed: DataFrame, key: str, listed_key: str) -> DataFrame:
    """``df`` with ``_hit``: whether the key is in the list. One left join to the distinct keys: ``df`` is read once."""
    keys = listed.select(F.col(listed_key).alias("_listed")).filter(F.col("_listed").isNotNull()).distinct()
    joined = df.join(settled(keys, "listed"), F.col(key) == F.col("_listed"), "left")
    return joined.withColumn("_hit", F.col("_listed").isNotNull()).drop("_listed")


def _absent(flagged: DataFrame, listed: DataFrame, key: str, listed_key: str) -> tuple[DataFrame, Column]:
    """``flagged`` with a summary of the list, and the condition ``key NOT IN (list)`` with SQL's NULL rules."""
    summary = F.broadcast(
        listed.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(listed_key).isNull()).alias("_nulls"))
    )
    hit = (F.col("_n") == 0) | (~F.col("_hit") & F.col(key).isNotNull() & (F.col("_nulls") == 0))
    return flagged.crossJoin(summary), hit


def update_where_in(
    df: DataFrame, listed: DataFrame, key: str, listed_key: str, values: Mapping[str, Column], also: Column | None = None
) -> DataFrame:
    """UPDATE … SET values WHERE key IN (list) [AND also]."""
    hit = F.col("_hit") if also is None else F.col("_hit") & F.coalesce(also, F.lit(False))
    flagged = _flagged(df, listed, key, listed_key)
    return flagged.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def update_where_not_in(
    df: DataFrame, listed: DataFrame, key: str, listed_key: str, values: Mapping[str, Column]
) -> DataFrame:
    """UPDATE … SET values WHERE key NOT IN (list): a NULL in the list updates nothing."""
    flagged, hit = _absent(_flagged(df, listed, key, listed_key), listed, key, listed_key)
    return flagged.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE WHERE: rows for which the condition is false or NULL stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_in_chain(
    child: DataFrame, links: Sequence[tuple[DataFrame, str, str]], listed: DataFrame, listed_key: str
) -> DataFrame:
    """Delete children whose ancestor is listed.

    ``links`` lead from the list to the child: each (relation, own key, parent key); the last one's own
    key is matched to the child column of the same position's name pair ``(None, child column, _)``.
    """
    doomed = listed.select(F.col(listed_key).alias("_k"))
    *steps, (_, child_key, _) = links
    for relation, own, parent in steps:
        doomed = relation.join(doomed, F.col(parent) == F.col("_k"), "left_semi").select(F.col(own).alias("_k"))
    return child.join(doomed, F.col(child_key) == F.col("_k"), "left_anti")


def roll_current(
    current: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Current and history after new rows arrive: the newest row per key stays current.

    ``order`` must identify a row within its key. Both outputs read one pre-aggregated maximum, no group
    is sorted as a whole.
    """
    both = current.unionByName(new)
    marked = attach_group(both, keys, {"_newest": F.max(F.struct(*order))})
    # written once: both outputs read it
    marked = materialize(marked.withColumn("_newest", F.struct(*order) == F.col("_newest")), "rolled")
    return marked.filter("_newest").drop("_newest"), marked.filter("not _newest").drop("_newest")


def one_current(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """The first row per key in ``order``, and the keys that had several with their count."""
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
    return latest_per_key(df, keys, order), several


def cdc_latest_state(
    changes: DataFrame, keys: Sequence[str], order: Sequence[Column], optype: str = "optype", hide: Sequence[str] = ()
) -> DataFrame:
    """Newest change per key, without the capture columns ``hide``.

    Keys whose newest change is a delete (or has no type) are gone.
    """
    return latest_per_key(changes, keys, order).filter(F.col(optype) != "D").drop(*hide)


def flag_missing(
    stored: DataFrame, snapshot: DataFrame, key: str, snapshot_key: str, status: str, closed: str, reopened: str,
    inactive: Sequence[str],
) -> DataFrame:
    """Status after a full snapshot: rows NOT IN it become ``closed``, returning inactive rows ``reopened``.

    A NULL key in the snapshot closes nothing, and a NULL key is closed by an empty snapshot only.
    """
    flagged, absent = _absent(_flagged(stored, snapshot, key, snapshot_key), snapshot, key, snapshot_key)
    is_inactive = F.coalesce(F.col(status).isin(*inactive), F.lit(False))
    new = (
        F.when(absent & ~is_inactive, closed)
        .when(F.col("_hit") & is_inactive, reopened)
        .otherwise(F.col(status))
    )
    return flagged.withColumn(status, new).drop("_hit", "_n", "_nulls")


def evolve(
    old: DataFrame, new: DataFrame, types: Mapping[str, str] | T.StructType, names: Mapping[str, str] = {}
) -> DataFrame:
    """Old and new layouts in one table: rename, add missing columns as NULL, cast to ``types``.

    ``names`` may be paths to nested fields. With a whole type as ``types`` both layouts are brought to it at every level.
    """
    if isinstance(types, T.StructType) or any("." in n for n in names):
        old = rename_nested(old, names)
        if isinstance(types, T.StructType):
            return align_schema(old, types).unionByName(align_schema(new, types))
        names = {}
    both = old.withColumnsRenamed(dict(names)).unionByName(new, allowMissingColumns=True)
    return both.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in both.columns])
