"""Log tables, requests and attempts derived from general-purpose tables.

These give the library something to run on: ``events``, ``documents``, ``pages`` and
``conversations`` seen as logs, and delivery attempts that follow from event ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logfreight.model import LOG
from logfreight.sources.logs import arrival_ms, logs_from_columns

LIST_TURNS = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_event_logs(events: DataFrame) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    return logs_from_columns(
        events, "event_type", seconds, ["user_id", "props"], arrival_ms("ts"), "event_id"
    )


def event_logs(spark: SparkSession, folder: str) -> DataFrame:
    return as_event_logs(table(spark, folder, "events"))


def document_logs(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return logs_from_columns(
        documents, "lang", "doc_id", ["text", "source"], F.col("doc_id") * 100, "doc_id"
    )


def unsent_document_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Document logs in packages of their own, which no attempt has been made for."""
    name = F.concat(F.lit("doc-"), F.col("seq").cast("string"))
    return document_logs(spark, folder).withColumn("package_id", name)


def page_logs(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return logs_from_columns(
        pages, F.lit("pages"), "page_id", ["url", "html"], F.col("page_id") * 100, "page_id"
    )


def conversation_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Lists of up to ``LIST_TURNS`` turns of a conversation, in three topics."""
    turns = table(spark, folder, "conversations")
    part = F.col("conv_id") * 1000 + F.expr(f"turn div {LIST_TURNS}")
    logs = logs_from_columns(turns, F.lit(""), "turn", ["role", "text"], part, "conv_id")
    lists = logs.groupBy("seq", "arrival_ms").agg(
        F.array_sort(F.collect_list(F.struct(*[f.name for f in LOG.fields]))).alias("logs")
    )
    return lists.select(
        F.concat(F.lit("chat"), (F.col("seq") % 3).cast("string")).alias("topic_id"),
        F.lit("main").alias("producer"),
        F.col("arrival_ms").alias("seq"),
        "arrival_ms",
        "logs",
    )


def request_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Document logs dealt into requests of up to five groups."""
    return document_logs(spark, folder).withColumns(
        {
            "request_no": F.expr("seq div 50"),
            "group_no": F.expr("(seq div 10) % 5"),
        }
    )


def event_attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Up to twelve attempts per event, ending with the first final answer."""
    events = table(spark, folder, "events")
    codes = F.array(*[F.lit(c) for c in (200, 429, 500, 401, 404, 413, 400, 403, -1, 302)])
    bodies = F.array(
        F.lit('{"errorcode": "Denied", "errormessage": "not allowed"}'),
        F.lit('{"errorcode": "Partial"}'),
        F.lit("oops"),
    )

    def code_of(k):
        return F.element_at(codes, ((F.col("event_id") * 7 + k) % 10).cast("int") + 1)

    last = (F.col("event_id") % 12 + 1).cast("int")
    numbers = F.sequence(F.lit(1), last)
    ends = F.filter(numbers, lambda k: code_of(k).isin(200, 401, 404, 413))
    kept = F.slice(numbers, F.lit(1), F.coalesce(F.try_element_at(ends, F.lit(1)), last))
    return events.select(
        F.col("event_id").cast("string").alias("package_id"),
        F.col("event_type").alias("topic_id"),
        arrival_ms("ts").alias("_first_ms"),
        "event_id",
        F.element_at(bodies, (F.col("event_id") % 3).cast("int") + 1).alias("body"),
        F.explode(kept).alias("attempt_no"),
    ).select(
        "package_id",
        "topic_id",
        "attempt_no",
        code_of(F.col("attempt_no")).alias("http_code"),
        F.concat_ws("-", F.lit("req"), "package_id", F.col("attempt_no").cast("string")).alias(
            "request_id"
        ),
        "body",
        (F.col("_first_ms") + F.col("attempt_no") * 1000).alias("ts_ms"),
    )
