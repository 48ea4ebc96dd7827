"""Files of records of one length, without any separator between them.

Read: Hadoop's fixed-length input splits a file at whole records, so one large file is read by many tasks, inside the JVM. Written: a Spark data
source whose tasks put the bytes of their partition out as they lie in the Arrow batches; a commit step publishes the
files under the numbers of their partitions. Paths are those that pyarrow's file systems know (local or mounted, HDFS, object stores).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ledgerloom.sources.fixed_width import Field, from_ebcdic, parse_records, to_ebcdic
from ledgerloom.sources.tables import _fs

# the writer travels to the workers with its code, so workers need not find this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FORMAT = "fixed_length_records"


@dataclass
class _Written(WriterCommitMessage):
    partition: int
    file: str | None


class _RecordWriter(DataSourceArrowWriter):
    def __init__(self, path: str, length: int, overwrite: bool):
        self.path, self.length, self.overwrite = path, length, overwrite
        self.staged = f"_staged-{uuid.uuid4().hex}"

    def _store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        """The records of one partition, in their order, as one file of the job's own folder."""
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        store, folder = self._store()
        number = TaskContext.get().partitionId()
        name = f"{folder}/{self.staged}/{number}-{TaskContext.get().taskAttemptId()}"
        out = None
        for batch in iterator:
            column = batch.column(0).cast(pa.large_binary())
            if not len(column):
                continue
            if out is None:
                store.create_dir(f"{folder}/{self.staged}", recursive=True)
                out = store.open_output_stream(name)
            ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            if column.null_count or (np.diff(ends) != self.length).any():
                out.close()
                raise ValueError(f"a record does not have {self.length} bytes")
            out.write(column.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])))
        if out is None:
            return _Written(number, None)
        out.close()
        return _Written(number, name)

    def commit(self, messages: list) -> None:
        """Publish the files: only now do their names say that they belong to the table."""
        from pyarrow import fs

        store, folder = self._store()
        store.create_dir(folder, recursive=True)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(folder)):
                if old.is_file:
                    store.delete_file(old.path)
        for done in sorted((m for m in messages if m and m.file), key=lambda m: m.partition):
            store.move(done.file, f"{folder}/part-{done.partition:05d}.bin")
        self._drop(store, folder)
        with store.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list) -> None:
        self._drop(*self._store())

    def _drop(self, store, folder: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{folder}/{self.staged}").type != fs.FileType.NotFound:
            store.delete_dir(f"{folder}/{self.staged}")


class _RecordSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return _FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if [f.dataType.typeName() for f in schema] != ["binary"]:
            raise ValueError("records are written from one binary column")
        return _RecordWriter(self.options["path"], int(self.options["length"]), overwrite)


def write_records(df: DataFrame, path: str, record: str | Column, length: int, order: Sequence[str] = ()) -> None:
    """Binary records of ``length`` bytes as files whose bytes, in the order of their names, are the deliverable.

    With ``order`` the rows are sorted by ranges, every task one stretch. A record of another length (or NULL) is an error, and nothing is published.
    """
    df.sparkSession.dataSource.register(_RecordSource)
    ordered = df.orderBy(*order) if order else df
    raw = F.col(record) if isinstance(record, str) else record
    writer = ordered.select(raw.alias("record")).write.format(_FORMAT).mode("overwrite")
    writer.option("path", path).option("length", length).save()


def read_records(spark: SparkSession, path: str, length: int, split_bytes: int | None = None) -> DataFrame:
    """The records of a file, or of all files of a folder, as the binary column ``record``.

    A file whose size is no multiple of ``length`` is refused. ``split_bytes`` bounds what one task reads (by default
    a block of the store).
    """
    fs, p = _fs(spark, path)
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")) and status.isFile() and status.getLen() % length:
            raise ValueError(f"{status.getPath()} has {status.getLen()} bytes, which are not records of {length}")
    jvm, session = spark.sparkContext._jvm, spark._jsparkSession
    conf = session.sessionState().newHadoopConf()
    if split_bytes:
        conf.set("mapreduce.input.fileinputformat.split.maxsize", str(max(split_bytes, length)))
    records = session.sparkContext().binaryRecords(path, length, conf)
    rows = DataFrame(session.createDataset(records, jvm.org.apache.spark.sql.Encoders.BINARY()).toDF(), spark)
    return rows.withColumnRenamed("value", "record")


def write_ebcdic_records(
    df: DataFrame, path: str, order: Sequence[str], line: str, length: int, charset: str = "cp037"
) -> None:
    """Lines as EBCDIC records of ``length`` bytes in ``order``, with nothing between them."""
    write_records(df, path, to_ebcdic(line, length, charset), length, order)


def read_ebcdic_records(
    spark: SparkSession, path: str, length: int, layout: Sequence[Field], charset: str = "cp037", split_bytes: int | None = None
) -> DataFrame:
    """Fields of EBCDIC records of one length, cut by a copybook layout."""
    records = read_records(spark, path, length, split_bytes)
    return parse_records(records.select(from_ebcdic("record", charset).alias("value")), layout)
