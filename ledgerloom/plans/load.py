"""Config-driven loads: the transformation chain in its two orders, and the load of a segment file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import lookup_join
from ledgerloom.operators.ordered import latest_per_key
from ledgerloom.operators.quality import trailer_counts
from ledgerloom.operators.shaping import add_drop_columns, filter_all, local_times, sync_schema
from ledgerloom.session import materialize
from ledgerloom.sources.fixed_width import Field, UnknownSegments, read_segments
from ledgerloom.sources.tables import (
    RUN,
    append_run,
    full_refresh,
    read_table,
    replace_partitions,
    schema_preserving,
    table_exists,
)

#: The two orders in which a load applies its steps.
TABLE_LOAD = ("join", "columns", "rows", "times")
FILE_LOAD = ("columns", "join", "times", "dedup", "sync")


def _join(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame]) -> DataFrame:
    for spec in config.get("join", []):
        df = lookup_join(df, lookups[spec["table"]], spec)
    return df


def _columns(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame]) -> DataFrame:
    return add_drop_columns(df, config.get("add", ()), config.get("drop", ()))


def _rows(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame]) -> DataFrame:
    return filter_all(df, config.get("filters"))


def _times(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame]) -> DataFrame:
    return local_times(df, config.get("zone", "America/Toronto"), config.get("time_columns"))


def _dedup(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame]) -> DataFrame:
    keys = config.get("dedup")
    if not keys:
        return df
    order: list[Column] = [
        F.expr(e[:-5]).desc() if e.lower().endswith(" desc") else F.expr(e) for e in config.get("dedup_order", [])
    ]
    rest = [c for c in df.columns if c not in keys]
    return latest_per_key(df, keys, order or [F.xxhash64(*rest) if rest else F.lit(0)])


def _sync(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame]) -> DataFrame:
    return sync_schema(df, config["target"]) if "target" in config else df


_STEPS = {"join": _join, "columns": _columns, "rows": _rows, "times": _times, "dedup": _dedup, "sync": _sync}


def run_chain(df: DataFrame, config: Mapping, lookups: Mapping[str, DataFrame], order=TABLE_LOAD) -> DataFrame:
    """Apply the configured steps in ``order``.

    ``join``: list of lookup specs with ``table``; ``add`` / ``drop``: columns; ``filters``: SQL
    conditions; ``zone`` and ``time_columns``: local times; ``dedup`` and ``dedup_order``: key and
    preference; ``target``: final column list. Nothing runs before the result is written.
    """
    for step in order:
        df = _STEPS[step](df, config, lookups)
    return df


class LoadRefused(ValueError):
    """The file may not be loaded; nothing was written."""


@dataclass(frozen=True)
class Segment:
    """One segment of an inbound file: its layout, load config, target table and write mode.

    ``count_column`` names the trailer field that holds the number of records; ``redefines`` marks a segment that
    describes other records anew, whose count is not checked. ``mode`` is ``append``,
    ``refresh``, ``schema`` (refresh that keeps columns and types) or ``partitions`` (replace the ones that occur).
    """

    layout: Sequence[Field]
    target: str
    config: Mapping = field(default_factory=dict)
    count_column: str | None = None
    mode: str = "append"
    partition_by: Sequence[str] = ()
    redefines: bool = False


def _write(df: DataFrame, segment: Segment, run_id: str) -> None:
    """Write a segment's rows; writing them again for the same run changes nothing."""
    if segment.mode == "append":
        append_run(df, segment.target, run_id, segment.partition_by)
    elif segment.mode == "refresh":
        full_refresh(df, segment.target, segment.partition_by)
    elif segment.mode == "schema":
        schema_preserving(df, segment.target)
    elif segment.mode == "partitions":
        replace_partitions(df, segment.target, segment.partition_by)
    else:
        raise ValueError(f"unknown write mode {segment.mode!r}")


def load_segment_file(
    spark: SparkSession,
    path: str,
    segments: Mapping[str, Segment],
    trailer_id: str,
    trailer: Segment,
    trailer_keys: Sequence[str],
    control: str,
    run_id: str,
    loaded_at: datetime,
    lookups: Mapping[str, DataFrame] | None = None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Load one file of several segments; returns the control rows of this run.

    The file must have exactly one trailer, new by ``trailer_keys``, with a readable count equal to the rows of each
    counted segment, and no record of an unknown segment (but those in ``ignore``); else ``LoadRefused`` is raised before
    anything is written. Every segment passes its steps in the file order and is completed beside its target first; then
    the targets are written, each marked in the control table, and the trailer is kept last. Each of these writes is done
    once per run, whatever step a failure interrupts (``append_run``): a run that is repeated leaves every row once.
    Targets, control and trailers are read with ``read_table``.
    """
    layouts = {s: x.layout for s, x in segments.items()} | {trailer_id: trailer.layout}
    try:
        parts = read_segments(spark, path, layouts, ignore=ignore)
    except UnknownSegments as e:
        raise LoadRefused(str(e)) from e
    found = parts[trailer_id]
    trailers = found.limit(2).count()
    if trailers != 1:
        raise LoadRefused(f"{path} has {'no trailer' if not trailers else 'several trailers'}")
    if table_exists(spark, trailer.target):
        seen = read_table(spark, trailer.target)
        if not found.join(seen, list(trailer_keys), "left_semi").isEmpty():
            raise LoadRefused("this file was loaded before")
    counted = [s for s, x in segments.items() if x.count_column and not x.redefines]
    body = reduce(DataFrame.unionByName, [parts[s].select(F.lit(s).alias("segment")) for s in segments])
    if counted:
        expected = found.select(
            F.explode(F.array(*[F.struct(F.lit(s).alias("segment"), F.col(segments[s].count_column).alias("n")) for s in counted])).alias("x")
        ).select("x.segment", "x.n")
        checked = trailer_counts(body.filter(F.col("segment").isin(*counted)), expected, "segment", "n")
        # one short row per segment
        wrong = [tuple(r) for r in checked.filter("status in ('Mismatch', 'Unreadable')").take(len(counted))]
        if wrong:
            raise LoadRefused(f"counts differ from the trailer (segment, expected, found, status): {wrong}")
    done = set()
    if table_exists(spark, control):
        marks = read_table(spark, control).filter((F.col("run_id") == run_id) & (F.col("status") == "C"))
        done = {r.segment for r in marks.select("segment").distinct().limit(len(segments)).collect()}
    open_ = [s for s in segments if s not in done]
    ready = {s: materialize(run_chain(parts[s], segments[s].config, lookups or {}, FILE_LOAD), "load") for s in open_}
    for s in open_:
        _write(ready[s], segments[s], run_id)
        rows = parts[s].agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(s).alias("segment"),
            "n_rows",
            F.lit(run_id).alias("run_id"),
            F.lit(loaded_at).cast("timestamp_ntz").alias("rec_load_timestamp"),
            F.lit("C").alias("status"),
        )
        append_run(rows, control, f"{run_id}.{s}")
    append_run(found, trailer.target, run_id)
    return read_table(spark, control).filter(F.col("run_id") == run_id).drop(RUN)
