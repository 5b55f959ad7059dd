"""Token ids in ORC: stripes of run-length encoded integers, row indexes, Bloom filters on ids.

Documents are range-partitioned and sorted by doc_id, so stripe and row-group statistics are
narrow and a lookup by doc_id skips nearly all stripes; the Bloom filters answer the rest.
Ids are a list column, which ORC writes with its integer run-length encoding. Every stripe can
be read on its own. A document's place among all ids is its place in its part plus the sum of
the parts before, so no task sees more than its own part.

Null text is an empty text (only the end id). Null doc_id sorts first. Rows with the same
doc_id are kept, ordered by text. An empty table gives an empty table. Other columns of the
input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logfreight.llm.bytelevel import ByteLevelTexts
from logfreight.llm.texts import (
    batches_of_bytes,
    for_worker,
    id_lists,
    library_tokenizer,
    partitions_of,
    with_end,
)

SCHEMA = "part int, doc_id bigint, part_start bigint, n_tokens bigint, token_ids array<int>"


def _byte_level(path: str) -> ByteLevelTexts:
    def make() -> ByteLevelTexts:
        tokenizer = library_tokenizer(path)
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

        def encode_many(texts: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        return ByteLevelTexts(encode_many, added, vocabulary=tokenizer.get_vocab(with_added_tokens=False))

    return for_worker(("token_files", path), make)


def encode_in_order(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, partitions: int | None = None
) -> DataFrame:
    """Ids of every document (with the end id) in ascending doc_id order within ranges."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        texts, part, start = _byte_level(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches_of_bytes(batches, 1):
            ids, sizes = with_end(*texts.ids(batch.column(1)), end_id)
            starts = start + np.cumsum(sizes) - sizes
            start += int(sizes.sum())
            columns = [
                pa.array(np.full(len(sizes), part, np.int32)), batch.column(0),
                pa.array(starts), pa.array(sizes), id_lists(ids, sizes),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["part", "doc_id", "part_start", "n_tokens", "token_ids"]
            )

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    ranges = narrow.repartitionByRange(partitions_of(docs.sparkSession, partitions), "doc_id")
    return ranges.sortWithinPartitions("doc_id", "text").mapInArrow(encode, SCHEMA)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 0,
    partitions: int | None = None,
    stripe_bytes: int = 64 << 20,
    index_rows: int = 1000,
    bloom_fpp: float = 0.01,
) -> None:
    """Encode documents and write them as ORC files, one or more per range of doc_id."""
    (
        encode_in_order(docs, tokenizer_path, end_id, partitions)
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", index_rows)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", bloom_fpp)
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and token_ids of the documents in such files.

    A filter on doc_id reaches the ORC reader. ``start`` needs the totals of all parts, which
    are summed from two narrow columns; the running sum sees one row per part.
    """
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("base"))
    # One row of two integers per part.
    joined = rows.join(F.broadcast(base), "part")
    start = (F.col("base") + F.col("part_start")).alias("start")
    return joined.select("doc_id", start, "n_tokens", "token_ids")


def with_crc32(df: DataFrame, ids: str = "token_ids", name: str = "ids_crc32") -> DataFrame:
    """Replace a list of ids by the crc32 of its little-endian unsigned 32-bit integers."""
    others = [c for c in df.columns if c != ids]
    schema = df.select(*others).withColumn(name, F.lit(0).cast("bigint")).schema

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sums, type=pa.int64())], names=[*others, name]
            )

    return df.select(*others, ids).mapInArrow(digest, schema)
