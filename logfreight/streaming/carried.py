"""Streaming packing of topics too busy for the state of one task.

Each micro-batch is packed by the distributed batch packer together with the rows that
the batch before left open. A batch is one write of ``path/batch_id=<n>`` split by
``is_open``; it depends on its own rows and on the open rows of batch ``n - 1``, so a
replayed batch replaces itself with the same rows.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from logfreight.functions.ids import name_in_id, package_id
from logfreight.model import LOGS, PACKED, PackOptions
from logfreight.operators.pack import SEQUENCE, assign_packages, attach, sized_logs
from logfreight.session import written_table


def _opener_id(opts: PackOptions, path: str) -> Column:
    """Packages are named after their first log, which no later batch changes.

    Without a run of its own a stream has one that follows from its path, as a replayed batch
    must give the same ids.
    """
    run = zlib.crc32(path.encode()) if opts.run_secs is None else opts.run_secs
    name = name_in_id(F.col("opener.arrival_ms"), F.col("opener.seq"))
    return package_id(F.col("producer"), F.col("topic_id"), name, run)


def _pack_with_carry(batch: DataFrame, batch_id: int, path: str, opts: PackOptions) -> DataFrame:
    names = LOGS.fieldNames()
    rows = batch.select(*names)
    if batch_id > 0:
        rows = rows.unionByName(_open_rows(batch.sparkSession, path, batch_id - 1).select(*names))
    labels = assign_packages(sized_logs(rows), opts).drop("package_id")
    newest = rows.agg(F.max("arrival_ms")).first()[0] or 0
    expired = F.col("create_ms") + opts.linger_ms <= newest
    still_open = (F.col("close_reason") == "flush") & ~expired
    packages = labels.groupBy(*SEQUENCE, "package_seq").agg(
        F.min(F.struct("arrival_ms", "seq")).alias("opener")
    )
    named = labels.join(packages, [*SEQUENCE, "package_seq"]).withColumns(
        {
            "package_id": _opener_id(opts, path),
            "is_open": still_open,
            "close_ms": F.when(F.col("close_reason") != "flush", F.col("close_ms")).otherwise(
                F.when(expired, F.col("create_ms") + opts.linger_ms).otherwise(F.col("close_ms"))
            ),
            "close_reason": F.when(
                (F.col("close_reason") == "flush") & expired, "linger"
            ).otherwise(F.col("close_reason")),
        }
    )
    return attach(rows, named.drop("package_seq", "opener"))


def _read(spark: SparkSession, path: str, folder: str = "") -> DataFrame:
    schema = T.StructType(
        [
            *PACKED.fields,
            T.StructField("batch_id", T.LongType()),
            T.StructField("is_open", T.BooleanType()),
        ]
    )
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{folder}")


def _open_rows(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    # Only the folder of that batch is listed, however many there are.
    return _read(spark, path, f"batch_id={batch_id}").filter("is_open")


def pack_stream_carried(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    opts: PackOptions = PackOptions(),
    available_now: bool = False,
) -> StreamingQuery:
    """Pack a stream into ``path``, carrying open packages from batch to batch.

    No row is dropped for being late: it counts by its arrival time among the rows that
    are still open. Read the result with ``read_packed``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        packed = _pack_with_carry(written_table(batch), batch_id, path, opts).select(*PACKED.fieldNames(), "is_open")
        target = f"{path}/batch_id={batch_id}"
        packed.write.mode("overwrite").partitionBy("is_open").parquet(target)

    linger = {"processingTime": f"{opts.linger_ms} milliseconds"}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if available_now else linger))
        .start()
    )


def read_packed(spark: SparkSession, path: str, ended: bool = False) -> DataFrame:
    """Logs of closed packages; with ``ended``, also those open in the last batch."""
    written = _read(spark, path)
    wanted = ~F.col("is_open")
    if ended:
        last = written.agg(F.max("batch_id")).first()[0]
        wanted = wanted | (F.col("batch_id") == last)
    return written.filter(wanted).drop("is_open", "batch_id")
