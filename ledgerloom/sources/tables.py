"""Write modes for path-based Parquet tables, and bucketed catalog tables.

A table that is replaced as a whole has versions: each is a folder ``v=<number>-<mark>`` of its own, and a small file in ``_versions`` names it.
Writing that file is the one step that switches readers, who find the newest version by ``read_table``; data is never
moved. The version before stays for readers that have begun, older ones are removed. Appends of a run go to the run's own folder and count once its
mark is written; a run that is repeated replaces what it had left, or finds its mark and adds nothing. A change of single partitions is complete
beside the table before it is made, and finished by the next change if its job is lost.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.changes import Rule, merge
from ledgerloom.session import materialize

#: Folders of the version files and of the marks of finished runs; Spark's readers skip names with an underscore.
_VERSIONS, _RUNS = "_versions", "_runs"
#: Folder of a change of partitions that is not finished.
_PENDING = "_pending"
#: Column (and folder) that tells the runs of an appended table apart.
RUN = "load_run"
#: Versions that stay: the newest, and the one that a reader may still use.
KEPT = 2
#: Partitions whose values a change lists one by one; more are found by a join.
LISTED = 2000


class ConcurrentChange(RuntimeError):
    """Another writer replaced the table meanwhile; nothing was changed."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        raise ConcurrentChange(f"{path} exists")
    try:
        out = fs.create(p, False)
    except Exception as e:
        raise ConcurrentChange(f"{path} could not be written first") from e
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _get(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    size = fs.getFileStatus(p).getLen()
    source = fs.open(p)
    try:
        return bytes(source.readNBytes(int(size))).decode()
    finally:
        source.close()


# ---- versions


def versions(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """(number, entry) of the table's versions, oldest first; a file that is not complete yet does not count."""
    out = []
    for name in _names(spark, f"{path}/{_VERSIONS}"):
        if re.fullmatch(r"\d{12}", name) and (text := _get(spark, f"{path}/{_VERSIONS}/{name}")).endswith("\n"):
            out.append((int(name), json.loads(text)))
    return out


def data_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of the table now; the table's own if it has no versions."""
    found = versions(spark, path)
    return f"{path}/{found[-1][1]['folder']}" if found else path


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a table: a version, or files of an unversioned one."""
    return bool(versions(spark, path)) or any(not n.startswith(("_", ".", "v=")) for n in _names(spark, path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version, or of the plain folder; of appended runs only finished ones."""
    folder = data_folder(spark, path)
    rows = spark.read.parquet(folder)
    if RUN not in rows.columns or not any(n.startswith(f"{RUN}=") for n in _names(spark, folder)):
        return rows
    # without any mark there is no finished run yet
    return rows.filter(F.col(RUN).isin(_names(spark, f"{folder}/{_RUNS}")))


def _switch(spark: SparkSession, path: str, number: int, entry: Mapping) -> None:
    _put_new(spark, f"{path}/{_VERSIONS}/{number:012d}", json.dumps(dict(entry)) + "\n")


def _tidy(spark: SparkSession, path: str) -> None:
    """Remove versions that no reader uses, folders of lost jobs that are older than the newest version, and unversioned files."""
    found = versions(spark, path)
    stay = {e["folder"] for _, e in found[-KEPT:]}
    for number, _ in found[:-KEPT]:
        remove_path(spark, f"{path}/{_VERSIONS}/{number:012d}")
    for name in _names(spark, path):
        begun = re.fullmatch(r"v=(\d+)-\w+", name)
        if name not in stay and (int(begun[1]) <= found[-1][0] if begun else not name.startswith("_")):
            remove_path(spark, f"{path}/{name}")


def swap_in(df: DataFrame, path: str, partition_by: Sequence[str] = (), entry: Mapping | None = None) -> None:
    """Replace the table at ``path`` by ``df``, which may read that very table.

    The new files are complete before one small file names them, so at any moment a reader gets the old or the new rows.
    Two writers at once: the first to write that file wins, the other gets ``ConcurrentChange``.
    """
    spark = df.sparkSession
    found = versions(spark, path)
    number = found[-1][0] + 1 if found else 1
    folder = f"v={number}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
    _switch(spark, path, number, {"folder": folder, "partition_by": list(partition_by), **(entry or {})})
    _tidy(spark, path)


def full_refresh(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> None:
    """Replace the whole table, laid out by partition and sorted by the cluster columns.

    The version's file names the cluster columns, so that ``recluster`` can tell what is done already.
    """
    laid_out = balanced(df, partition_by)
    if cluster_by:
        by = [*partition_by, *cluster_by]
        laid_out = df.repartitionByRange(*by).sortWithinPartitions(*by)
    swap_in(laid_out, path, partition_by, {"cluster_by": list(cluster_by)})


def recluster(spark: SparkSession, path: str, cluster_by: Sequence[str]) -> bool:
    """Lay the table out by ``cluster_by``; False, without touching anything, if that is how it lies already."""
    found = versions(spark, path)
    entry = found[-1][1] if found else {}
    if entry.get("cluster_by") == list(cluster_by):
        return False
    full_refresh(read_table(spark, path), path, entry.get("partition_by", ()), cluster_by)
    return True


def file_ranges(df: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """Least and greatest value of ``column`` in each file that ``df`` reads, per partition ``within``."""
    file = F.col("_metadata.file_path").alias("file")
    return df.groupBy(*within, file).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def overlapping_files(df: DataFrame, column: str, within: Sequence[str] = ()) -> DataFrame:
    """Files whose range of ``column`` reaches below the greatest value of a file before; none if the table is clustered.

    Neighbouring files may share the one value at which they were cut. The window runs over one row per file.
    """
    order = Window.partitionBy(*within).orderBy("low", "high", "file").rowsBetween(Window.unboundedPreceding, -1)
    return file_ranges(df, column, within).withColumn("_before", F.max("high").over(order)).filter("low < _before").drop("_before")


def schema_preserving(df: DataFrame, path: str) -> None:
    """Existing table: replace the rows and keep its columns, order and types; absent table: create it."""
    spark = df.sparkSession
    if table_exists(spark, path):
        kept = read_table(spark, path).schema
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kept.fields])
    swap_in(df, path)


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Backup or restore: an independent copy of the rows."""
    swap_in(read_table(spark, source), target)


# ---- appends


def _fitted(df: DataFrame, path: str) -> DataFrame:
    """``df`` in the order and the types of the stored table, which must have the same columns."""
    spark = df.sparkSession
    if not table_exists(spark, path):
        return df
    stored = [f for f in spark.read.parquet(data_folder(spark, path)).schema if f.name != RUN]
    if {f.name for f in stored} != set(df.columns):
        raise ValueError(f"columns {df.columns} do not fit the table {path} with {[f.name for f in stored]}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored])


def append_only(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create the table from the query's shape when absent, then add the rows.

    An existing table must have the same columns; they are put in its order and cast to its types. Calling this again adds
    the rows again: a job that may be repeated uses ``append_run``.
    """
    df = _fitted(df, path)
    folder = data_folder(df.sparkSession, path)
    balanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(folder)


def run_finished(spark: SparkSession, path: str, run_id: str) -> bool:
    """Whether a run's rows are in the table."""
    return path_exists(spark, f"{data_folder(spark, path)}/{_RUNS}/{_run_name(run_id)}")


def _run_name(run_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9][\w.:-]*", run_id):
        raise ValueError(f"run id {run_id!r} cannot be part of a path")
    # the prefix keeps partition discovery from reading the id as a number or a date
    return "run-" + run_id.replace(":", "-")


def append_run(df: DataFrame, path: str, run_id: str, partition_by: Sequence[str] = ()) -> bool:
    """Add the rows of a run once, however often this is called; False if they are in the table already.

    The rows lie in the run's own partition of the column ``load_run``, which a repeated call replaces, and are the table's from the moment
    the run's mark is written: ``read_table`` reads marked runs only. A run without rows is marked, too.
    """
    spark = df.sparkSession
    name = _run_name(run_id)
    if run_finished(spark, path, run_id):
        return False
    folder = data_folder(spark, path)
    remove_path(spark, f"{folder}/{RUN}={name}")
    rows = balanced(_fitted(df, path), partition_by)
    rows.write.partitionBy(*partition_by).parquet(f"{folder}/{RUN}={name}")
    _put_new(spark, f"{folder}/{_RUNS}/{name}", run_id + "\n")
    return True


# ---- partitions


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    folder = data_folder(df.sparkSession, path)
    balanced(df, by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)


def replace_run_date(df: DataFrame, path: str, run_date: date) -> None:
    """Write the rows of one run; running again replaces them and never duplicates."""
    replace_partitions(df.withColumn("run_date", F.lit(run_date)), path, ["run_date"])


def _equal(values: Mapping) -> Column:
    out = F.lit(True)
    for name, value in values.items():
        out = out & F.col(name).eqNullSafe(F.lit(value))
    return out


def _only(rows: DataFrame, touched: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of the ``touched`` partitions: a filter on the partition columns, which skips the others' files.

    Spark itself lists a table's partitions on the driver; a list of up to ``LISTED`` of them becomes the filter, a longer one a join.
    """
    listed = touched.limit(LISTED + 1).collect()
    if len(listed) > LISTED:
        pairs = touched.select(*[F.col(c).alias(f"_p_{c}") for c in by])
        met = F.lit(True)
        for c in by:
            met = met & rows[c].eqNullSafe(pairs[f"_p_{c}"])
        return rows.join(F.broadcast(pairs), met, "left_semi")
    chosen = F.lit(False)
    for row in listed:
        chosen = chosen | _equal(row.asDict())
    return rows.filter(chosen)


def _rewrite(
    spark: SparkSession, path: str, by: Sequence[str], touched: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Replace the rows of the ``touched`` partitions by ``change`` of them; returns the partitions that were written or emptied.

    The files of all other partitions stay as they are. The new rows are complete beside the table before a small file with what is to be
    done makes the change binding. If the job is lost after that, the next change begins by doing it again (``recover``), which gives the same.
    """
    folder = data_folder(spark, path)
    stored = read_table(spark, path)
    touched = materialize(touched.select(*by).distinct(), "touched")
    change(_only(stored, touched, by)).select(*stored.columns).write.mode("overwrite").parquet(f"{folder}/{_PENDING}/rows")
    changed = spark.read.schema(stored.schema).parquet(f"{folder}/{_PENDING}/rows")
    filled = materialize(changed.select(*by).distinct(), "filled")
    met = F.lit(True)
    for c in by:
        met = met & touched[c].eqNullSafe(filled[c])
    # partitions are folders, of which the driver keeps a list anyway
    emptied = touched.join(filled, met, "left_anti").collect()
    names = ["/".join(f"{c}={_folder_value(spark, row[c])}" for c in by) for row in emptied]
    plan = {"by": list(by), "emptied": names, "schema": stored.schema.jsonValue()}
    _put_new(spark, f"{folder}/{_PENDING}/plan", json.dumps(plan) + "\n")
    recover(spark, path)
    return touched.union(filled).distinct()


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a change of partitions that a lost job had made binding, or drop one that it had not; whether there was one to finish."""
    folder = data_folder(spark, path)
    pending = f"{folder}/{_PENDING}"
    if not path_exists(spark, pending):
        return False
    text = _get(spark, f"{pending}/plan") if path_exists(spark, f"{pending}/plan") else ""
    if text.endswith("\n"):
        plan = json.loads(text)
        rows = spark.read.schema(T.StructType.fromJson(plan["schema"])).parquet(f"{pending}/rows")
        if not rows.isEmpty():
            replace_partitions(rows, path, plan["by"])
        for name in plan["emptied"]:
            remove_path(spark, f"{folder}/{name}")
    # the plan goes first: rows without one are dropped
    remove_path(spark, f"{pending}/plan")
    remove_path(spark, pending)
    return bool(text)


def _folder_value(spark: SparkSession, value: object) -> str:
    """A partition value as Spark writes it into a folder's name."""
    if value is None:
        return "__HIVE_DEFAULT_PARTITION__"
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    update: Mapping[str, Rule] | None = None,
    when: Rule | None = None,
    insert: Mapping[str, Rule] | bool = False,
) -> DataFrame:
    """MERGE into a stored table partitioned ``by``; rewrites only the partitions that it touches, and returns these.

    Touched are the partitions of stored rows whose key the source has (found by a semi join that reads keys and partition
    columns only), and those that get changed or new rows. A new row whose key lies in a partition not read would be matched there, so it
    is touched as well. An absent table is created if ``insert`` is true.
    """
    source = materialize(source, "merge-source")
    recover(spark, path)
    if not table_exists(spark, path):
        if insert is not True:
            raise ValueError(f"there is no table {path}")
        replace_partitions(source, path, by)
        return source.select(*by).distinct()
    stored = read_table(spark, path)
    known = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    met = F.lit(True)
    for k in keys:
        met = met & (F.col(k) == F.col(f"_s_{k}"))
    hit = stored.select(*dict.fromkeys([*keys, *by])).join(known, met, "left_semi").select(*by)
    if insert:
        # rows to insert go to partitions whose other rows must be kept: those are read and written, too
        nothing = _only(stored, hit.filter(F.lit(False)), by)
        fresh = source.join(stored.select(*[F.col(k).alias(f"_t_{k}") for k in keys]), _keys_met(keys), "left_anti")
        hit = hit.unionByName(merge(nothing, fresh, keys, insert=insert).select(*by))
    updated = update or {}
    if any(c in updated for c in by):
        # a changed partition value moves the row: its new partition is kept as well
        moved = merge(stored.join(known, met, "left_semi"), source, keys, update, when).select(*by)
        hit = hit.unionByName(moved)
    return _rewrite(spark, path, by, hit, lambda rows: merge(rows, source, keys, update, when, insert))


def _keys_met(keys: Sequence[str]) -> Column:
    met = F.lit(True)
    for k in keys:
        met = met & (F.col(k) == F.col(f"_t_{k}"))
    return met


def update_rows(
    spark: SparkSession, path: str, by: Sequence[str], condition: Column, values: Mapping[str, Column]
) -> DataFrame:
    """UPDATE … SET values WHERE condition on a stored table; only partitions with such rows are rewritten."""
    if any(c in values for c in by):
        raise ValueError("a partition column cannot be updated in place; use merge_into")
    recover(spark, path)
    hit = read_table(spark, path).filter(condition).select(*by)
    new = {c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()}

    def change(rows: DataFrame) -> DataFrame:
        return rows.select(*[new[c].cast(rows.schema[c].dataType).alias(c) if c in new else F.col(c) for c in rows.columns])

    return _rewrite(spark, path, by, hit, change)


def delete_rows(spark: SparkSession, path: str, by: Sequence[str], condition: Column) -> DataFrame:
    """DELETE WHERE condition on a stored table; only partitions with such rows are rewritten, emptied ones are removed."""
    recover(spark, path)
    hit = read_table(spark, path).filter(condition).select(*by)
    return _rewrite(spark, path, by, hit, lambda rows: rows.filter(~F.coalesce(condition, F.lit(False))))


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, splitting partitions that are too large for one task."""
    return df.hint("rebalance", *by) if by else df


def int_range_bucket(df: DataFrame, column: str, low: int, high: int, step: int, name: str = "bucket") -> DataFrame:
    """Start of the integer range a row belongs to; NULL outside [low, high)."""
    c = F.col(column)
    start = F.floor((c - low) / step) * step + low
    return df.withColumn(name, F.when((c >= low) & (c < high), start.cast("long")))


# ---- catalog tables


def write_bucketed(
    df: DataFrame, name: str, buckets: int, by: Sequence[str], path: str | None = None, sort_by: Sequence[str] = ()
) -> None:
    """Replace the catalog table ``name``, whose rows are dealt to ``buckets`` by the hash of ``by`` and sorted there.

    Tables with equal buckets are joined and grouped by these columns without a shuffle. The rows are dealt first, so that each bucket
    is one file and not one of every task. ``path`` puts the files outside the warehouse.
    """
    writer = df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by)
    writer = writer.sortBy(*(sort_by or by))
    (writer.option("path", path) if path else writer).saveAsTable(name)
