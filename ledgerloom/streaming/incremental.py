"""Structured Streaming forms of the incremental table behaviours."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.ordered import latest_per_key
from ledgerloom.sources.sinks import publish
from ledgerloom.sources.tables import _fs, remove_path


def file_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """New files below ``path`` (a folder or a glob), each read once."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run_available(stream: DataFrame, checkpoint: str, sink: str | Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Process everything that has arrived, then stop; ``sink`` is a Parquet path or a batch function."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if callable(sink):
        query = writer.foreachBatch(sink).start()
    else:
        query = writer.format("parquet").option("path", sink).start()
    query.awaitTermination()


#: Parts of one level that are merged into one part of the next.
FANOUT = 16


def _part_names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _add_batch(
    batch: DataFrame, number: int, path: str, keys: Sequence[str], by: Sequence[Column], fanout: int, writer: str
) -> None:
    """Keep a batch's newest rows as a part of their own; stored parts stay as they are until a level is full.

    A full level is merged into one part of the next, so a row is rewritten once per level and the cost of a batch follows its
    size. A part that occurs twice after a failure changes nothing: readers take the newest row of a key. ``writer`` names the query that
    counts the batches: one with a new checkpoint counts from 0 again, and must not replace what another has stored. Its rows are
    newer than those of the queries before, as ``_epoch`` says: the number of queries that had written when it began.
    """
    spark = batch.sparkSession
    epoch = _epoch(spark, path, writer)
    rows = latest_per_key(
        batch.withColumns({"_epoch": F.lit(epoch).cast("long"), "_batch": F.lit(number).cast("long")}), keys, by
    )
    folder = lambda level: f"{path}/l{level}"
    rows.write.mode("overwrite").parquet(f"{folder(0)}/{writer}-{number}")
    level = 0
    while len(parts := _part_names(spark, folder(level))) >= fanout:
        folders = [f"{folder(level)}/{p}" for p in parts]
        merged = latest_per_key(spark.read.schema(rows.schema).parquet(*folders), keys, by)
        merged.write.parquet(f"{folder(level + 1)}/{uuid.uuid4().hex}")
        for f in folders:
            remove_path(spark, f)
        level += 1


def _epoch(spark: SparkSession, path: str, writer: str) -> int:
    """The place of a query among those that have written to the state; it is noted when the query writes first."""
    noted = {}
    for name in _part_names(spark, f"{path}/_writers"):
        number, _, who = name.partition("-")
        noted[who] = int(number)
    if writer not in noted:
        noted[writer] = len(noted)
        fs, p = _fs(spark, f"{path}/_writers/{noted[writer]:06d}-{writer}")
        fs.create(p, True).close()
    return noted[writer]


def _query_id(batch: DataFrame) -> str:
    """The id of the streaming query that made the batch, which its checkpoint keeps; one name for batches of no query."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return (found or "batches").replace("-", "")


def read_state(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The newest row of each key in a state table, by ``order``, then by query and batch."""
    levels = [f"{path}/{n}" for n in _part_names(spark, path) if n.startswith("l")]
    parts = [f"{level}/{n}" for level in levels for n in _part_names(spark, level)]
    rows = spark.read.parquet(*parts)
    newest = [*[F.col(c).desc() for c in order], F.desc("_epoch"), F.desc("_batch")]
    return latest_per_key(rows, keys, newest).drop("_epoch", "_batch")


def keep_latest(
    path: str, keys: Sequence[str], order: Sequence[str], fanout: int = FANOUT
) -> Callable[[DataFrame, int], None]:
    """Batch function that keeps the newest change per key in the state table at ``path`` (see ``read_state``).

    Deletes stay in the table as rows, so that an older change that arrives late cannot revive a key.
    Applying a batch twice gives the same state.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            newest = [*[F.col(c).desc() for c in order], F.desc("_epoch"), F.desc("_batch")]
            _add_batch(batch, number, path, keys, newest, fanout, _query_id(batch))

    return apply


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One event per key; the state of a key is dropped once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, time: str, width: str, delay: str, by: Sequence[str] = (), total: Column | None = None) -> DataFrame:
    """Counts (and a total) per time bucket."""
    values = [F.count(F.lit(1)).alias("n")] + ([total.alias("total")] if total is not None else [])
    return (
        stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *by).agg(*values)
        .select(F.col("w.start").alias("bucket"), *by, "n", *(["total"] if total is not None else []))
    )


def replace_by_key(path: str, keys: Sequence[str], fanout: int = FANOUT) -> Callable[[DataFrame, int], None]:
    """Batch function for update mode: the newest batch's values of a key count (see ``read_state``)."""

    def apply(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            _add_batch(batch, number, path, keys, [F.desc("_epoch"), F.desc("_batch")], fanout, _query_id(batch))

    return apply


def missing_events(
    expected: DataFrame, events: DataFrame, key: str, expected_time: str, event_key: str, event_time: str, tolerance: str, delay: str
) -> DataFrame:
    """Expected rows for which no event came within ``tolerance``, known once the watermark has passed.

    The time slot is part of the join key, so that the state of a hot key is spread over many tasks and
    a row meets only events near it: an event is offered to its own slot and to the one before.
    """
    width = F.unix_micros(F.expr(f"timestamp_micros(0) + interval {tolerance}"))
    slot = lambda c: F.floor(F.unix_micros(c) / width).cast("long")
    left = expected.withWatermark(expected_time, delay).withColumn("_slot", slot(expected_time))
    right = events.withWatermark(event_time, delay).withColumn(
        "_event_slot", F.explode(F.array(slot(event_time), slot(event_time) - 1))
    )
    on = (
        (F.col(key) == F.col(event_key))
        & (F.col("_slot") == F.col("_event_slot"))
        & (F.col(event_time) >= F.col(expected_time))
        & (F.col(event_time) <= F.col(expected_time) + F.expr(f"interval {tolerance}"))
    )
    return left.join(right, on, "left_outer").filter(F.col(event_key).isNull()).select(*expected.columns)


def publish_each(target: str, servers: str | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function that sends keyed messages; an empty batch sends nothing.

    Files of a batch go to a folder of its own and are replaced when the batch is repeated.
    """

    def apply(batch: DataFrame, number: int) -> None:
        publish(batch, target if servers else f"{target}/batch={number}", servers, mode="overwrite")

    return apply
