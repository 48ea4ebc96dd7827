"""Session building, scratch space and plan-time size checks."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Inputs whose estimated size is below this many bytes may be handled by one task.
SMALL_INPUT_BYTES = 256 * 1024 * 1024
#: A key with more rows than this is split over several tasks.
HOT_KEY_ROWS = 4_000_000
#: Rows of one key that one task handles at a time once the key is split.
BLOCK_ROWS = 1_000_000
#: Largest relation that an operator asks Spark to broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024

_local_scratch: dict[str, str] = {}
#: Whether executors share a folder with the driver, by application and folder.
_tried: dict[tuple[str, str], bool] = {}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # stream state on local disk instead of the heap, with small incremental checkpoints
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def setting(spark: SparkSession, name: str, default: int) -> int:
    """Integer session setting ``spark.ledgerloom.<name>``."""
    return int(spark.conf.get(f"spark.ledgerloom.{name}", str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can read and write.

    The cluster names it in ``spark.checkpoint.dir`` or with ``setCheckpointDir``; without either it is the warehouse. A local master
    may do without. What looks like a folder of one machine is taken only if ``spark.ledgerloom.sharedMount`` says that it is a
    network mount, or if a trial finds that driver and executors share it.
    """
    context = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", "") or context.getConf().get("spark.checkpoint.dir", "")
    ) or _checkpoint_dir(spark)
    if configured:
        if not context.master.startswith("local"):
            _refuse_unshared(spark, configured, "spark.checkpoint.dir")
        return configured.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        warehouse = spark.conf.get("spark.sql.warehouse.dir", "")
        if not warehouse:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _refuse_unshared(spark, warehouse, "no spark.checkpoint.dir is set, and spark.sql.warehouse.dir")
        return warehouse.rstrip("/")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="ledgerloom-")
        atexit.register(shutil.rmtree, _local_scratch[app], ignore_errors=True)
    return _local_scratch[app]


def _checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``SparkContext.setCheckpointDir``; empty if none is set."""
    found = getattr(spark.sparkContext, "getCheckpointDir", lambda: None)()
    return found or ""


def _refuse_unshared(spark: SparkSession, folder: str, name: str) -> None:
    """Raise an error if ``folder`` looks like one of a single machine and a trial does not find it shared."""
    local = folder.startswith("file:") or ("://" not in folder and not _shared_by_default(spark))
    if not local or spark.conf.get("spark.ledgerloom.sharedMount", "false") == "true":
        return
    try:
        shared, cause = _found_shared(spark, folder.rstrip("/")), None
    except Exception as e:  # executors may not be able to make the folder at all
        shared, cause = False, e
    if not shared:
        raise ValueError(
            f"{name} {folder} looks like a folder of one machine; "
            "set spark.ledgerloom.sharedMount=true if it is a network mount"
        ) from cause


def _found_shared(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds all files that tasks on the executors write below ``folder``, and tasks read them.

    Some tasks for each core write one row each. An executor that cannot reach the folder leaves its rows on its own disk, where
    the driver does not commit them. Tried once per application and folder.
    """
    app = spark.sparkContext.applicationId
    if (app, folder) not in _tried:
        n, path = 4 * spark.sparkContext.defaultParallelism, f"{folder}/ledgerloom-{app}/shared-{uuid.uuid4().hex}"
        try:
            spark.range(0, n, 1, n).write.parquet(path)
            _tried[app, folder] = spark.read.schema("id long").parquet(path).agg(F.count_distinct("id")).first()[0] == n
        finally:
            _delete(spark, path)
    return _tried[app, folder]


def _shared_by_default(spark: SparkSession) -> bool:
    return not spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")


def _app_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ledgerloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below this application's (or the current job's) part of the shared folder."""
    job = spark.conf.get("spark.ledgerloom.job", "")
    return f"{_app_dir(spark)}/{job + '/' if job else ''}{label}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what a job wrote to the shared folder when it ends; store its results elsewhere inside the block."""
    before, job = spark.conf.get("spark.ledgerloom.job", ""), f"job-{uuid.uuid4().hex}"
    spark.conf.set("spark.ledgerloom.job", job)
    try:
        yield
    finally:
        spark.conf.set("spark.ledgerloom.job", before)
        _delete(spark, f"{_app_dir(spark)}/{job}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; call it when all results are stored."""
    _delete(spark, _app_dir(spark))


def materialize(df: DataFrame, label: str = "step", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and fixes values that a recomputation could change
    (range boundaries, row order). ``compression`` names a codec other than the session's, such as zstd for long texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


#: Plan nodes that can give more rows than they read; Catalyst's estimate does not follow them.
_MULTIPLIES = re.compile(
    r"^[\s:|+-]*(?:Generate|Expand|Join (?!LeftSemi|LeftAnti|ExistenceJoin)|Map|FlatMap|CoGroup|Recursive|UnionLoop)", re.M
)
#: Bytes of a value of a fixed width, at most, and of a row besides its values.
_FIXED_BYTES, _ROW_BYTES = 16, 16
#: Files whose footers the driver reads; the rows of more files are counted by a job.
_FOOTERS = 64
_VARIABLE = (T.StringType, T.BinaryType, T.VarcharType, T.CharType)
#: Rows of the files seen before, by path, length and time of change.
_file_rows: dict[tuple[str, int, int], int] = {}


def _footer_rows(spark: SparkSession, files: list[str]) -> int:
    """Rows of Parquet files, from their footers."""
    parquet = spark.sparkContext._jvm.org.apache.parquet.hadoop
    conf, total = spark._jsparkSession.sessionState().newHadoopConf(), 0
    for file in files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        status = path.getFileSystem(conf).getFileStatus(path)
        key = (file, status.getLen(), status.getModificationTime())
        if key not in _file_rows:
            reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromStatus(status, conf))
            try:
                _file_rows[key] = reader.getRecordCount()
            finally:
                reader.close()
        total += _file_rows[key]
    return total


def _leaf_rows(spark: SparkSession, leaf, limit: int) -> int | None:
    """Rows of a leaf of a plan, read from the data's own counts; None if it has none or its files exceed ``limit`` bytes."""
    kind = leaf.getClass().getSimpleName()
    if kind == "LocalRelation":
        return leaf.data().size()
    if kind == "OneRowRelation":
        return 1
    if kind == "Range":
        return int(str(leaf.numElements()))
    if kind != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    relation = leaf.relation()
    if relation.fileFormat().toString() != "Parquet" or relation.sizeInBytes() > limit:
        return None
    files = list(relation.location().inputFiles())
    if len(files) > _FOOTERS:
        # a count without columns reads footers only
        return spark.read.schema(T.StructType()).parquet(*files).count()
    return _footer_rows(spark, files)


def bounded_bytes(df: DataFrame, limit: int, measure: bool = True) -> int | None:
    """A proven bound of the size of ``df`` in memory; None if there is none, or if it passes ``limit``.

    Rows: the sum of those of the Parquet files read, by their footers, as long as no operator in between multiplies rows.
    Bytes of a row: fixed by the types; for text and binary columns the lengths are summed by a job over ``df``, which only starts if
    the rows alone are within the limit (``measure``; else such columns give None). Nested columns, and sources without counts, give None.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().optimizedPlan()
    if _MULTIPLIES.search(plan.toString()):
        return None
    variable = [f.name for f in df.schema if isinstance(f.dataType, _VARIABLE)]
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema):
        return None
    if variable and not measure:
        return None
    leaves, rows = plan.collectLeaves(), 0
    width = _ROW_BYTES + _FIXED_BYTES * len(df.columns)
    for i in range(leaves.size()):
        found = _leaf_rows(spark, leaves.apply(i), limit)
        if found is None:
            return None
        rows += found
        if rows * width > limit:
            return None
    size = rows * width
    if variable and rows:
        lengths = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`")).cast("long")), F.lit(0)) for c in variable]
        size += sum(df.agg(*[x.alias(f"_{i}") for i, x in enumerate(lengths)]).first())
    return size if size <= limit else None


def is_small(df: DataFrame, measure: bool = True) -> bool:
    """Whether the whole input is proven to be small enough for a single task.

    The operators give the same rows either way; an input of unknown size takes the split way.
    """
    return bounded_bytes(df, setting(df.sparkSession, "smallInputBytes", SMALL_INPUT_BYTES), measure) is not None


def may_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is proven small enough to be sent to every executor."""
    return bounded_bytes(df, setting(df.sparkSession, "broadcastBytes", BROADCAST_BYTES)) is not None


def multiplies(df: DataFrame) -> bool:
    """Whether an operator of the plan can give more rows than it reads, so that reading it again is costly."""
    return bool(_MULTIPLIES.search(df._jdf.queryExecution().optimizedPlan().toString()))


def settled(df: DataFrame, label: str = "lookup") -> DataFrame:
    """``df``, written first when it is large.

    Adaptive execution splits a hot key only where both join inputs come straight from a shuffle; an
    aggregate that feeds the join directly hides its side. Reading it from files restores that.
    """
    return df if is_small(df, measure=False) else materialize(df, label)


#: Plan nodes that only read, choose and compute columns: reading such an input again costs a scan of the wanted columns.
_READS = re.compile(r"^[\s:|+-]*(?:Project|Filter|SubqueryAlias|Relation|LocalRelation|Range|OneRowRelation|LogicalRelation|Union)\b")


def computed_once(df: DataFrame, label: str = "input") -> DataFrame:
    """``df`` for several readers: as it is if it only reads files and always gives the same rows, else written first."""
    plan = df._jdf.queryExecution().optimizedPlan()
    lines = [x for x in plan.toString().splitlines() if x.strip()]
    return df if plan.deterministic() and all(map(_READS.match, lines)) else materialize(df, label)
