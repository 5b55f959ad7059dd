"""The outbox as a data source: ``df.write.format("outbox")``, ``writeStream`` and ``spark.read``.

Tasks write Parquet files of one topic each and report them in their commit messages; a batch is
there once the driver has written its list of files (``_batches/<n>.json``), in one step.
A batch that is written again (a stream that replays it, a job that is repeated under the same
``batch``) finds its list and leaves its own files out, so each batch is there once. The
reader plans one partition per file and takes filters on topic_id and batch_id: files that they
rule out are not planned.

``path`` is a folder of a file system that pyarrow knows (``file:``, ``hdfs:``, ``s3:`` ...).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamWriter,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from logfreight.model import OUTBOX

FORMAT = "outbox"
BATCHES = "_batches"
# Payload bytes that a task holds before it writes the largest topic out.
HELD_BYTES = 16 << 20
SCHEMA = T.StructType([*OUTBOX.fields, T.StructField("batch_id", T.LongType())])
_STORED = pa.schema(
    [
        ("package_id", pa.string()), ("compress_type", pa.string()), ("raw_bytes", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("topic_id", pa.string()),
    ]
)
_TESTS = {
    EqualTo: lambda a, b: a == b, EqualNullSafe: lambda a, b: a == b, In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b,
}


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: name, topic and rows of each."""

    files: list[dict]


@dataclass
class OutboxFile(InputPartition):
    name: str
    batch_id: int


class _Writer:
    """What batch and stream writers share."""

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator[Row]) -> Written:
        system, folder = _opened(self.path)
        task, held, sizes, files = uuid.uuid4().hex, {}, {}, []
        system.create_dir(f"{folder}/data", recursive=True)

        def flush(topic: str) -> None:
            name = f"data/{task}-{len(files)}.parquet"
            columns = list(zip(*held.pop(topic)))
            table = pa.table([pa.array(c, f.type) for c, f in zip(columns, _STORED)], schema=_STORED)
            sizes.pop(topic)
            pq.write_table(table, f"{folder}/{name}", filesystem=system)
            files.append({"name": name, "topic_id": topic, "rows": table.num_rows})

        for row in rows:
            values = [row[f.name] for f in _STORED]
            topic = values[-1] = values[-1] or ""
            held.setdefault(topic, []).append(values)
            sizes[topic] = sizes.get(topic, 0) + len(values[4] or b"") + 200
            if sum(sizes.values()) > HELD_BYTES:
                flush(max(sizes, key=sizes.get))
        for topic in list(held):
            flush(topic)
        return Written(files)

    def publish(self, messages: Iterable[Written | None], batch_id: int) -> None:
        """Make the batch visible, or drop the files if it is there already."""
        system, folder = _opened(self.path)
        files = [file for message in messages if message for file in message.files]
        target = f"{folder}/{BATCHES}/{batch_id}.json"
        if system.get_file_info(target).type != pafs.FileType.NotFound:
            self.discard(messages)
            return
        system.create_dir(f"{folder}/{BATCHES}", recursive=True)
        ready = f"{folder}/{BATCHES}/.{uuid.uuid4().hex}"
        with system.open_output_stream(ready) as out:
            out.write(json.dumps({"batch_id": batch_id, "files": files}).encode())
        system.move(ready, target)

    def discard(self, messages: Iterable[Written | None]) -> None:
        system, folder = _opened(self.path)
        for message in messages:
            for file in message.files if message else ():
                system.delete_file(f"{folder}/{file['name']}")


class OutboxWriter(DataSourceWriter):
    def __init__(self, path: str, batch_id: int):
        self.shared, self.batch_id = _Writer(path), batch_id

    def write(self, iterator: Iterator[Row]) -> Written:
        return self.shared.write(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.shared.publish(messages, self.batch_id)

    def abort(self, messages: list[Written | None]) -> None:
        self.shared.discard(messages)


class OutboxStreamWriter(DataSourceStreamWriter):
    def __init__(self, path: str):
        self.shared = _Writer(path)

    def write(self, iterator: Iterator[Row]) -> Written:
        return self.shared.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.shared.publish(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.shared.discard(messages)


class OutboxReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.tests = path, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for given in filters:
            name = getattr(given, "attribute", ("",))
            if type(given) in _TESTS and name in (("topic_id",), ("batch_id",)):
                self.tests.append((name[0], type(given), given.value))
            else:
                yield given

    def partitions(self) -> list[InputPartition]:
        system, folder = _opened(self.path)
        told = pafs.FileSelector(f"{folder}/{BATCHES}", allow_not_found=True)
        out = []
        for info in system.get_file_info(told):
            if info.base_name.startswith("."):
                continue
            with system.open_input_stream(info.path) as stream:
                batch = json.loads(stream.read())
            for file in batch["files"]:
                row = {"topic_id": file["topic_id"], "batch_id": batch["batch_id"]}
                if all(_TESTS[test](row[name], value) for name, test, value in self.tests):
                    out.append(OutboxFile(file["name"], batch["batch_id"]))
        return sorted(out, key=lambda f: (f.batch_id, f.name))

    def read(self, partition: OutboxFile | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # nothing is left to read
            return
        system, folder = _opened(self.path)
        with pq.ParquetFile(f"{folder}/{partition.name}", filesystem=system) as file:
            for batch in file.iter_batches(1000):
                ids = pa.array([partition.batch_id] * batch.num_rows, type=pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "batch_id"])


class OutboxSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> OutboxReader:
        return OutboxReader(self.options["path"])

    def writer(self, schema: T.StructType, overwrite: bool) -> OutboxWriter:
        if overwrite:
            raise ValueError("an outbox is appended to; a batch that is there stays")
        return OutboxWriter(self.options["path"], int(self.options["batch"]))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> OutboxStreamWriter:
        return OutboxStreamWriter(self.options["path"])


def register_outbox(spark: SparkSession) -> None:
    """Make the format known to a session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(OutboxSource)
