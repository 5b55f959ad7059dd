"""Streaming packing and delivery, one micro-batch at a time."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logfreight.functions import codecs
from logfreight.functions.ids import name_in_id, package_id
from logfreight.model import PackOptions
from logfreight.operators.assemble import encode_packages
from logfreight.operators.pack import pack_logs
from logfreight.operators.validate import reject_incomplete, reject_oversize
from logfreight.session import written_table
from logfreight.sources.outbox import write_outbox


def _trigger(opts: PackOptions, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": f"{opts.linger_ms} milliseconds"}


def _pack_batch(batch: DataFrame, batch_id: int, path: str, opts: PackOptions) -> DataFrame:
    """Packed rows of a batch; only the ids tell the batch, and a replayed one has the same."""
    run = zlib.crc32(path.encode()) if opts.run_secs is None else opts.run_secs
    name = name_in_id(F.lit(batch_id), F.col("package_seq"))
    identity = package_id(F.col("producer"), F.col("topic_id"), name, run)
    return pack_logs(batch, opts).withColumn("package_id", identity)


def pack_stream_microbatch(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    opts: PackOptions = PackOptions(),
    available_now: bool = False,
) -> StreamingQuery:
    """Pack every micro-batch by itself, the trigger interval being the linger time.

    What is open at the end of a batch is closed. Packed logs go to
    ``path/batch_id=<n>``, which a replayed batch replaces.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        packed = _pack_batch(written_table(batch), batch_id, path, opts)
        packed.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(opts, available_now))
        .start()
    )


def outbox_stream(
    stream: DataFrame,
    path: str,
    rejected_path: str,
    checkpoint: str,
    opts: PackOptions = PackOptions(),
    compress_type: str = codecs.LZ4,
    available_now: bool = False,
) -> StreamingQuery:
    """Validate, pack, encode and write each micro-batch to an outbox."""

    def write(batch: DataFrame, batch_id: int) -> None:
        complete, incomplete = reject_incomplete(written_table(batch))
        accepted, oversize = reject_oversize(complete)
        rejected = incomplete.unionByName(oversize)
        rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
        packed = _pack_batch(accepted, batch_id, path, opts)
        write_outbox(encode_packages(packed, compress_type, opts), path, batch_id)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(opts, available_now))
        .start()
    )

