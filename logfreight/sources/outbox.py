"""The outbox: a table of encoded packages waiting to be delivered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logfreight.model import OUTBOX


def write_outbox(encoded: DataFrame, path: str, batch_id: int) -> None:
    """Write encoded packages as batch ``batch_id``, replacing an earlier try of it.

    Files are laid out by topic. The rebalance hint lets Spark split a topic that is much
    larger than the others over several files and put small ones together.
    """
    names = [field.name for field in OUTBOX.fields]
    (
        encoded.select(*names)
        .hint("rebalance", "topic_id")
        .write.mode("overwrite")
        .partitionBy("topic_id")
        .parquet(f"{path}/batch_id={batch_id}")
    )


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """All batches of an outbox; filters on ``topic_id`` and ``batch_id`` prune folders."""
    schema = T.StructType([*OUTBOX.fields, T.StructField("batch_id", T.LongType())])
    table = spark.read.schema(schema).parquet(path)
    # An empty topic is stored as the null partition.
    return table.withColumn("topic_id", F.coalesce("topic_id", F.lit("")))
