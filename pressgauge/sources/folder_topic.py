"""A topic without broker: an append-only log of segments in a shared folder, as a Spark data source.

Tasks write Parquet files under ``data``; a commit lists them in one new manifest under ``log``, named by
its number, writer and batch. Manifests are the topic's offsets: a reader sees whole segments only, a
stream goes on at the offset in its checkpoint, and a batch that was committed before is not added again.
One writer commits at a time. Any file system that pyarrow reaches may hold the folder.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pressgauge.sinks.topics import stream_writer

# The processes that plan reads and commits on the driver have no files that were sent to the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "folder_topic"
SCHEMA = "key string, value string, timestamp timestamp, segment long"


class Log:
    """The manifests of one topic."""

    def __init__(self, path: str) -> None:
        self.fs, self.root = arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)

    def manifests(self) -> list[str]:
        """Paths of all manifests by number."""
        found = self.fs.get_file_info(arrow_fs.FileSelector(f"{self.root}/log", allow_not_found=True))
        return sorted(f.path for f in found if f.base_name.endswith(".json"))

    def files(self, start: int, end: int) -> list[tuple[int, str]]:
        """(segment, file) of the segments from ``start`` up to ``end``."""
        out = []
        for number, manifest in enumerate(self.manifests()[start:end], start):
            with self.fs.open_input_stream(manifest) as source:
                out += [(number, f"{self.root}/data/{name}") for name in json.loads(source.read())["files"]]
        return out

    def write(self, batches: Iterator[pa.RecordBatch]) -> str | None:
        """One new data file; none for no rows."""
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return None
        table = pa.Table.from_batches(rows)
        texts = [table.column(c).cast(pa.string()) for c in ("key", "value")]
        name = f"{uuid.uuid4().hex}.parquet"
        self.fs.create_dir(f"{self.root}/data", recursive=True)
        pq.write_table(pa.table(texts, names=["key", "value"]), f"{self.root}/data/{name}", filesystem=self.fs)
        return name

    def commit(self, names: Sequence[str], mark: str, at: int) -> None:
        """Make the files visible as the next segment, unless a segment of the same ``mark`` is there."""
        known = self.manifests()
        if not names or any(path.endswith(f"-{mark}.json") for path in known):
            return
        self.fs.create_dir(f"{self.root}/log", recursive=True)
        staged = f"{self.root}/log/_{uuid.uuid4().hex}"
        with self.fs.open_output_stream(staged) as out:
            out.write(json.dumps({"files": list(names), "timestamp": at}).encode())
        self.fs.move(staged, f"{self.root}/log/{len(known):020d}-{mark}.json")

    def read(self, segment: int, file: str) -> Iterator[pa.RecordBatch]:
        """The rows of one file, with its segment and the time it was written."""
        at = self.fs.get_file_info(file).mtime
        for batch in pq.ParquetFile(file, filesystem=self.fs).iter_batches():
            n = batch.num_rows
            more = [pa.array([at] * n, pa.timestamp("us", "UTC")), pa.array([segment] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], ["key", "value", "timestamp", "segment"])

    def discard(self, names: Sequence[str]) -> None:
        """Remove the files of an attempt that was not committed."""
        for name in names:
            self.fs.delete_file(f"{self.root}/data/{name}")


@dataclass
class Segment(InputPartition):
    """One file to read."""

    number: int
    file: str


@dataclass
class Written(WriterCommitMessage):
    """One file that a task wrote."""

    name: str | None


def _names(messages: Sequence[Written | None]) -> list[str]:
    return sorted(m.name for m in messages if m is not None and m.name)


class Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[Segment]:
        log = Log(self.path)
        return [Segment(*f) for f in log.files(0, len(log.manifests()))]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return Log(self.path).read(partition.number, partition.file)


class StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, start: str) -> None:
        self.path, self.start = path, start

    def initialOffset(self) -> dict:
        return {"segment": len(Log(self.path).manifests()) if self.start == "latest" else 0}

    def latestOffset(self) -> dict:
        return {"segment": len(Log(self.path).manifests())}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        return [Segment(*f) for f in Log(self.path).files(start["segment"], end["segment"])]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return Log(self.path).read(partition.number, partition.file)


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, mark: str) -> None:
        self.path, self.mark = path, mark

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(Log(self.path).write(iterator))

    def commit(self, messages: list[Written | None]) -> None:
        Log(self.path).commit(_names(messages), self.mark, 0)

    def abort(self, messages: list[Written | None]) -> None:
        Log(self.path).discard(_names(messages))


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str, writer: str) -> None:
        self.path, self.writer = path, writer

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return Written(Log(self.path).write(iterator))

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        Log(self.path).commit(_names(messages), f"{self.writer}.{batchId}", batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        Log(self.path).discard(_names(messages))


class FolderTopic(DataSource):
    """Options: ``path``; ``startingOffsets`` (``earliest`` or ``latest``) of a stream; ``writer``, a name per writing job."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"])

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(self.options["path"], self.options.get("startingOffsets", "earliest"))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"], self.options.get("mark") or uuid.uuid4().hex)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(self.options["path"], self.options.get("writer", "main"))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and to the active and the default one, in which writers look formats up."""
    before = SparkSession.getActiveSession() or spark
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    for session in (before, SparkSession.builder.getOrCreate(), spark):
        # Whether a name is taken is asked of the active session.
        sessions.setActiveSession(session._jsparkSession)
        try:
            session.dataSource.register(FolderTopic)
        except AnalysisException as error:
            if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
                raise
        finally:
            sessions.setActiveSession(before._jsparkSession)


def publish(messages: DataFrame, path: str, mark: str | None = None) -> None:
    """Append (key, value) rows as one segment; a ``mark`` given before is not published again."""
    register(messages.sparkSession)
    writer = messages.select("key", "value").write.format(FORMAT).mode("append").option("path", path)
    (writer.option("mark", mark) if mark else writer).save()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All messages there are."""
    register(spark)
    return spark.read.format(FORMAT).option("path", path).load()


def read_stream(spark: SparkSession, path: str, starting_offsets: str = "earliest") -> DataFrame:
    """The messages as a stream; the checkpoint holds the offset."""
    register(spark)
    return spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting_offsets).load()


def publish_stream(messages: DataFrame, path: str, checkpoint: str, mode: str = "append", writer: str = "main", **how) -> StreamingQuery:
    """Start a stream of (key, value) rows to a topic, one segment per micro-batch."""
    register(messages.sparkSession)
    rows = messages.select("key", "value")
    if mode == "update":
        # Data sources take no updates; a segment of changed rows is published by batch.
        def write(batch: DataFrame, batch_id: int) -> None:
            publish(batch, path, f"{writer}.{batch_id}")

        return stream_writer(rows, checkpoint, mode, **how).foreachBatch(write).start()
    return stream_writer(rows, checkpoint, mode, **how).format(FORMAT).option("path", path).option("writer", writer).start()
