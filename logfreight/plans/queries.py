"""One query per operator over the given tables, returning plain columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logfreight.functions import codecs, ids, sizes
from logfreight.model import ATTEMPTS, OUTBOX, PAIRS, DeliveryOptions, PackOptions
from logfreight.operators import assemble, contents, delivery, pack, send, validate
from logfreight.plans import sample_tables as sample
from logfreight.session import prepare, scratch, written_table
from logfreight.sources import logs as log_sources
from logfreight.sources import outbox as outboxes
from logfreight.sources import payloads
from logfreight.sources.outbox_source import register_outbox
from logfreight.streaming import carried, microbatch, retries, stateful

HOUR_MS = 3_600_000
# Limits low enough for every close reason to occur on the sample tables.
EVENT_PACKS = PackOptions(max_bytes=250, cap_bytes=257, max_logs=7, linger_ms=3 * HOUR_MS, run_secs=0)
DOCUMENT_PACKS = PackOptions(
    max_bytes=30_000, cap_bytes=32_000, max_logs=12, linger_ms=10_000, source="10.0.0.1", run_secs=0
)
LIST_PACKS = PackOptions(max_bytes=3_500, cap_bytes=4_200, max_logs=7, linger_ms=6_000)
RETRIES = DeliveryOptions(retries=2, backoff_ms=100, max_backoff_ms=350, total_bytes=2_000)
STREAM_BATCHES = 4
STREAM_FILES = 4
MAX_VALUE_BYTES = 4_000
MAX_REQUEST_BYTES = 120_000
MAX_GROUP_LOGS = 9
NOW_MS = 1_705_000_000_000
TAGS = {"region": "north", "": "é"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        return run(prepare(spark), folder)

    QUERIES[run.__name__] = prepared
    return run


# Sources, sinks, formats


@_query
def logs_from_columns(spark, folder):
    logs = sample.event_logs(spark, folder)
    return logs.select(
        "topic_id",
        "producer",
        "seq",
        "arrival_ms",
        "time",
        F.size("contents").alias("n_contents"),
        F.col("contents")[0]["key"].alias("first_key"),
        F.col("contents")[0]["value"].alias("first_value"),
        F.col("contents")[1]["value"].alias("second_value"),
    )


@_query
def logs_from_map(spark, folder):
    documents = sample.table(spark, folder, "documents")
    fields = F.create_map(
        F.lit("source"), "source", F.lit("lang"), "lang", F.lit("chars"), F.col("n_chars").cast("string")
    )
    logs = log_sources.logs_from_map(documents, fields, "lang", "doc_id", "doc_id", "doc_id")
    return contents.contents_long(logs).select("topic_id", "seq", "position", "key", "value")


@_query
def read_payloads(spark, folder):
    where = scratch(spark)
    packed = pack.pack_logs(sample.document_logs(spark, folder), DOCUMENT_PACKS)
    outboxes.write_outbox(assemble.encode_packages(packed, "zstd", DOCUMENT_PACKS), where, 0)
    return _plain_logs(payloads.read_payloads(spark, where))


def _plain_logs(logs):
    wide = contents.contents_wide(logs, ["text", "source"], "log_")
    return wide.select(
        F.col("time").alias("doc_id"),
        F.md5("log_text").alias("text_md5"),
        F.col("log_source").alias("source"),
        F.coalesce("collect_time", F.lit(-1)).alias("collect_time"),
        F.coalesce("_corrupt", F.lit("")).alias("_corrupt"),
        F.col("payload_id").alias("package_id"),
    )


@_query
def without_resent(spark, folder):
    """An outbox that was delivered twice, received as a stream: each log once."""
    where = scratch(spark)
    encoded = written_table(_encoded(spark, folder, "zstd"))
    for delivery_no in range(2):
        outboxes.write_outbox(encoded, f"{where}/in", delivery_no)
    files = spark.readStream.schema(OUTBOX).option("maxFilesPerTrigger", 4)
    received = files.parquet(f"{where}/in").withColumn("received_at", F.current_timestamp())
    once = payloads.without_resent(received).withColumnRenamed("package_id", "payload_id")
    _drain(once.select("payload_id", "compress_type", "payload"), where)
    return _plain_logs(payloads.decode_payloads(spark.read.parquet(f"{where}/out")))


@_query
def contents_long(spark, folder):
    long = contents.contents_long(sample.event_logs(spark, folder))
    return long.select("topic_id", "seq", "position", "key", "value")


@_query
def contents_wide(spark, folder):
    wide = contents.contents_wide(sample.event_logs(spark, folder), ["props", "user_id", "absent"])
    absent = F.coalesce("absent", F.lit("none")).alias("absent")
    return wide.select("topic_id", "seq", "props", "user_id", absent)


def _encoded(spark, folder, compress_type):
    packed = pack.pack_logs(sample.document_logs(spark, folder), DOCUMENT_PACKS)
    return assemble.encode_packages(packed, compress_type, DOCUMENT_PACKS)


def _read_back(outbox, *more):
    """Packages with the md5 of the texts that their payloads expand to, in order."""
    logs = payloads.decode_payloads(outbox.withColumnRenamed("package_id", "payload_id"))
    text = F.md5(F.coalesce(F.col("contents")[0]["value"], F.lit("")))
    ordered = F.array_sort(F.collect_list(F.struct("group_no", "log_no", text.alias("md5"))))
    read = logs.groupBy("payload_id").agg(
        F.md5(F.array_join(F.transform(ordered, lambda log: log["md5"]), ",")).alias("texts_md5")
    )
    joined = outbox.join(read, F.col("package_id") == F.col("payload_id"))
    return joined.select("package_id", "topic_id", "compress_type", "raw_bytes", "texts_md5", *more)


@_query
def encode_packages(spark, folder):
    packed = pack.pack_logs(sample.document_logs(spark, folder), DOCUMENT_PACKS)
    encoded = written_table(assemble.encode_variants(packed, list(codecs.CODECS), DOCUMENT_PACKS))
    kinds = [_read_back(encoded.filter(F.col("compress_type") == c)) for c in codecs.CODECS]
    return functools.reduce(DataFrame.unionByName, kinds)


@_query
def outbox_source(spark, folder):
    """Written twice under one number through the data source, read back with a filter."""
    where = scratch(spark)
    register_outbox(spark)
    encoded = written_table(_encoded(spark, folder, "deflate"))
    for _ in range(2):
        encoded.write.format("outbox").mode("append").option("batch", 7).save(where)
    read = spark.read.format("outbox").load(where).filter("batch_id >= 7")
    return _read_back(read, "batch_id")


@_query
def write_outbox(spark, folder):
    where = scratch(spark)
    encoded = _encoded(spark, folder, "deflate")
    outboxes.write_outbox(encoded, where, 7)
    outboxes.write_outbox(encoded, where, 7)
    return _read_back(outboxes.read_outbox(spark, where), "batch_id")


def _answer(topic_id: str, payload: bytes, compress_type: str) -> tuple[int, str, str]:
    if topic_id == "es":
        raise TimeoutError("no answer")
    code = (200, 429, 413)[len(payload) % 3]
    return code, f"r{len(payload)}", "" if code == 200 else '{"errorcode": "E", "errormessage": "m"}'


@_query
def deliver(spark, folder):
    where = scratch(spark)
    outboxes.write_outbox(_encoded(spark, folder, "none"), where, 0)
    outbox = outboxes.read_outbox(spark, where)
    sent = send.deliver(outbox, _answer, scratch(spark), 0, DeliveryOptions(workers=4))
    return sent.select("package_id", "topic_id", "attempt_no", "http_code", "request_id", "body")


@_query
def payload_stats(spark, folder):
    packed = pack.pack_logs(sample.document_logs(spark, folder), DOCUMENT_PACKS)
    stats = assemble.payload_stats(assemble.encode_variants(packed, ["zstd", "none"], DOCUMENT_PACKS))
    smaller = (F.col("ratio") > 1.0).alias("smaller")
    return stats.select("topic_id", "compress_type", "packages", "raw_bytes", smaller)


# Sizes and other column functions


@_query
def log_size(spark, folder):
    logs = sample.document_logs(spark, folder)
    return logs.select("seq", F.expr(sizes.log_size()).alias("size_bytes"))


@_query
def varint_size(spark, folder):
    events = sample.table(spark, folder, "events").select("event_id", F.col("event_id").cast("decimal(20,0)").alias("n"))
    # Beyond event 3,036,995 the product has more than 63 bits.
    numbers = events.selectExpr("event_id", "n * n * 1000003 * (1 - 2 * (n % 2)) AS number")
    return numbers.selectExpr("event_id", f"{sizes.varint_size('number', bits=126)} AS n_bytes")


@_query
def content_wire_size(spark, folder):
    long = contents.contents_long(sample.page_logs(spark, folder))
    pairs = long.select("seq", "position", F.struct("key", "value").alias("pair"))
    return pairs.selectExpr("seq", "position", f"{sizes.content_wire_size('pair')} AS wire_bytes")


@_query
def tag_wire_size(spark, folder):
    documents = sample.table(spark, folder, "documents")
    tags = documents.selectExpr("doc_id", "named_struct('key', lang, 'value', source) AS tag")
    return tags.selectExpr("doc_id", f"{sizes.tag_wire_size('tag')} AS wire_bytes")


@_query
def log_wire_size(spark, folder):
    collected = F.when(F.col("seq") % 3 == 0, F.col("arrival_ms"))
    logs = sample.document_logs(spark, folder).withColumn("collect_time", collected)
    return logs.selectExpr("seq", f"{sizes.log_wire_size()} AS wire_bytes")


@_query
def group_wire_size(spark, folder):
    packed = pack.pack_logs(sample.document_logs(spark, folder), DOCUMENT_PACKS)
    stamped = assemble.stamp_group(packed, source="10.0.0.1", hostname="", filename="a.log", tags=TAGS)
    groups = assemble.group_sizes(assemble.assemble_groups(stamped, DOCUMENT_PACKS))
    return groups.select("package_id", "topic_id", "wire_bytes")


@_query
def request_wire_size(spark, folder):
    packed = pack.assign_packages(
        pack.sized_logs(sample.document_logs(spark, folder)), DOCUMENT_PACKS
    )
    packages = pack.package_summary(packed, DOCUMENT_PACKS)
    requests = packages.withColumn("request_no", F.expr("package_seq div 4"))
    return assemble.request_sizes(requests, ["topic_id", "request_no"])


@_query
def with_defaults(spark, folder):
    logs = sample.event_logs(spark, folder)
    odd = F.col("seq") % 2 == 1
    gaps = logs.withColumn("contents", F.when(odd, F.col("contents"))).withColumn(
        "source", F.when(odd, F.col("topic_id"))
    )
    filled = log_sources.with_defaults(gaps)
    return filled.select(
        "seq", "collect_time", "source", F.size("contents").alias("n_contents")
    )


@_query
def ns_to_ms(spark, folder):
    events = sample.table(spark, folder, "events")
    return events.selectExpr("event_id", f"{sizes.ns_to_ms('(event_id - 500) * 1500001')} AS ms")


@_query
def stamp_group(spark, folder):
    logs = sample.page_logs(spark, folder)
    queued = assemble.stamp_group(logs, source="10.0.0.1", tags=TAGS).withColumn("mode", F.lit("queued"))
    direct = assemble.stamp_group(logs, source=None, hostname="web-1", direct=True)
    both = queued.unionByName(direct.withColumn("mode", F.lit("direct")))
    return both.select("mode", "seq", "source", "hostname", "filename", F.size("tags").alias("n_tags"))


@_query
def package_id(spark, folder):
    events = sample.table(spark, folder, "events")
    identity = ids.package_id(F.lit("main"), F.col("event_type"), ids.number_in_id(F.col("event_id") + 1), 1_700_000_000)
    return events.select("event_id", identity.alias("package_id"))


@_query
def reject_oversize(spark, folder):
    parts = validate.reject_oversize(sample.document_logs(spark, folder), MAX_VALUE_BYTES)
    return parts[0].select("seq", F.lit(None).cast("string").alias("reason")).unionByName(
        parts[1].select("seq", "reason")
    )


@_query
def reject_incomplete(spark, folder):
    logs = sample.event_logs(spark, folder)
    kind = F.col("seq") % 7
    broken = logs.withColumn("time", F.when(kind != 1, F.col("time"))).withColumn(
        "contents",
        F.when(
            kind.isin(2, 3),
            F.array(
                F.struct(
                    F.when(kind == 3, "k").alias("key"), F.when(kind == 2, "v").alias("value")
                )
            ).cast(PAIRS),
        )
        .when(kind == 4, F.lit(None).cast(PAIRS))
        .otherwise(F.col("contents")),
    )
    accepted, rejected = validate.reject_incomplete(broken)
    return accepted.select("seq", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("seq", "reason")
    )


@_query
def classify_response(spark, folder):
    classified = delivery.classify_response(sample.event_attempts(spark, folder))
    return classified.select(
        "package_id", "attempt_no", "outcome", "success", "error_code", "error_message", "request_id"
    )


@_query
def parse_error_body(spark, folder):
    parsed = delivery.parse_error_body(sample.event_attempts(spark, folder))
    return parsed.select("package_id", "attempt_no", "body_code", "body_message")


# Aggregations


@_query
def log_list_size(spark, folder):
    return validate.log_list_size(sample.request_logs(spark, folder), ["request_no"])


@_query
def check_requests(spark, folder):
    logs = sample.request_logs(spark, folder)
    return validate.check_requests(
        logs, ["topic_id", "request_no"], MAX_REQUEST_BYTES // 2, 20, 40_000
    )


@_query
def assemble_groups(spark, folder):
    packed = pack.pack_logs(sample.event_logs(spark, folder), EVENT_PACKS)
    groups = assemble.assemble_groups(packed, EVENT_PACKS)
    return groups.select(
        "package_id",
        "topic_id",
        F.size("logs").cast("long").alias("n_logs"),
        F.array_join(F.transform("logs", lambda log: log["time"].cast("string")), ",").alias("times"),
        "source",
        "context_flow",
    )


def _request_groups(spark, folder):
    groups = sample.request_logs(spark, folder).groupBy("request_no", "group_no").agg(
        F.array_sort(F.collect_list(F.struct("time", "contents", "collect_time"))).alias("logs")
    )
    stamped = assemble.stamp_group(groups, source="10.0.0.1", direct=True)
    return stamped.withColumn("context_flow", F.lit(None).cast("string"))


@_query
def send_requests(spark, folder):
    groups = _request_groups(spark, folder)
    sent, rejected = send.send_requests(
        groups, ["request_no"], "group_no", _answer, scratch(spark),
        compress_type="none", max_bytes=MAX_REQUEST_BYTES, opts=DeliveryOptions(workers=4),
    )
    reason = F.lit(None).cast("string").alias("reason")
    name = F.col("package_id").cast("long").alias("request_no")
    answered = sent.select(name, F.lit(1).alias("sends"), "http_code", reason)
    return answered.union(rejected.select("request_no", F.lit(0), F.lit(0), "reason"))


@_query
def assemble_requests(spark, folder):
    groups = _request_groups(spark, folder)
    requests, rejected = assemble.assemble_requests(
        groups, ["request_no"], "group_no", MAX_REQUEST_BYTES
    )
    encoded = assemble.encode_requests(requests, ["request_no"], "none")
    kept = requests.join(encoded, "request_no").select(
        "request_no", F.size("groups").cast("long").alias("n_groups"), "raw_bytes"
    )
    over = rejected.select("request_no", "n_groups", F.lit(-1).cast("long").alias("raw_bytes"))
    return kept.unionByName(over)


@_query
def package_summary(spark, folder):
    assigned = pack.assign_packages(pack.sized_logs(sample.event_logs(spark, folder)), EVENT_PACKS)
    return pack.package_summary(assigned, EVENT_PACKS)


@_query
def attempt_history(spark, folder):
    attempts = sample.event_attempts(spark, folder)
    kept = [
        delivery.attempt_history(attempts, 3, keep).select(
            F.lit(keep).alias("kept"), "package_id", F.explode("attempts").alias("a")
        )
        for keep in ("first", "last")
    ]
    both = kept[0].unionByName(kept[1])
    return both.select("kept", "package_id", "a.attempt_no", "a.success", "a.error_code", "a.ts_ms")


@_query
def delivery_result(spark, folder):
    packages = sample.table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("package_id")
    )
    unsent = sample.unsent_document_logs(spark, folder).select("package_id")
    attempts = sample.event_attempts(spark, folder)
    return delivery.delivery_result(attempts, RETRIES, packages.union(unsent))


@_query
def merge_tallies(spark, folder):
    """``delivery_result`` from tallies of three passes, each of which sees its own attempts."""
    attempts, known = sample.event_attempts(spark, folder), None
    for first, last in ((1, 1), (2, 4), (5, 99)):
        new = delivery.tallies(attempts.filter(F.col("attempt_no").between(first, last)))
        known = written_table(new if known is None else delivery.merge_tallies(known, new))
    return delivery.results_of(known, RETRIES)


# Windows


@_query
def check_request_groups(spark, folder):
    logs = sample.request_logs(spark, folder)
    checked = validate.check_request_groups(
        logs, ["request_no"], "group_no", MAX_REQUEST_BYTES, MAX_GROUP_LOGS + 1, 40_000
    )
    return checked.fillna(-1, ["first_bad"])


@_query
def split_segments(spark, folder):
    segments = pack.split_segments(sample.event_logs(spark, folder), HOUR_MS)
    filled = segments.fillna(-1, ["previous_ms"])
    return filled.select("topic_id", "seq", "arrival_ms", "previous_ms", "segment")


def _event_packages(spark, folder):
    """A package per event: closes when the event arrives, one second before attempt 1."""
    logs = sample.event_logs(spark, folder)
    return logs.select(
        F.col("seq").cast("string").alias("package_id"),
        "topic_id",
        F.col("arrival_ms").alias("close_ms"),
        F.expr(sizes.log_size()).alias("size_bytes"),
    )


@_query
def in_flight_bytes(spark, folder):
    return delivery.in_flight_bytes(
        _event_packages(spark, folder), sample.event_attempts(spark, folder), opts=RETRIES
    )


# Packing


@_query
def pack_logs(spark, folder):
    packed = pack.pack_logs(sample.event_logs(spark, folder), EVENT_PACKS)
    return packed.select(
        "topic_id",
        "seq",
        "package_seq",
        "package_id",
        "create_ms",
        "close_ms",
        "close_reason",
        F.col("contents")[0]["value"].alias("first_value"),
    )


@_query
def pack_log_lists(spark, folder):
    packed = pack.pack_log_lists(sample.conversation_lists(spark, folder), LIST_PACKS)
    return packed.select(
        "topic_id", "seq", "position", "package_seq", "create_ms", "close_ms", "close_reason", "size_bytes"
    )


@_query
def pack_logs_grid(spark, folder):
    cells = pack.pack_logs_grid(sample.event_logs(spark, folder), EVENT_PACKS)
    return cells.select("topic_id", "seq", "bucket", "by_bytes", "by_count", "package_id")


# Joins, sorts, limits


@_query
def log_status(spark, folder):
    results = delivery.delivery_result(sample.event_attempts(spark, folder), RETRIES)
    packed = sample.event_logs(spark, folder).withColumn("package_id", F.col("seq").cast("string"))
    packed = packed.unionByName(sample.unsent_document_logs(spark, folder))
    status = delivery.log_status(packed, results)
    return status.select("seq", "topic_id", "status", "error_code", "error_message", "ts_ms")


@_query
def unsent(spark, folder):
    results = delivery.delivery_result(sample.event_attempts(spark, folder), RETRIES)
    return delivery.unsent(_event_packages(spark, folder), results)


@_query
def retry_schedule(spark, folder):
    return delivery.retry_schedule(sample.event_attempts(spark, folder), RETRIES)


@_query
def retry_due(spark, folder):
    schedule = delivery.retry_schedule(sample.event_attempts(spark, folder), RETRIES)
    due = delivery.retry_due(schedule, NOW_MS).withColumn("closing", F.lit(False))
    every = delivery.retry_due(schedule, NOW_MS, closing=True).withColumn("closing", F.lit(True))
    return due.unionByName(every).select("closing", "package_id", "next_retry_ms")


@_query
def dead_letters(spark, folder):
    return delivery.dead_letters(sample.event_attempts(spark, folder), RETRIES)


# Streaming


def _event_stream(spark, folder):
    schema = sample.table(spark, folder, "events").schema
    return sample.as_event_logs(
        spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet")
    )


def _event_batches(spark, folder, where):
    """The events as a stream of several micro-batches, in order of time.

    Each is ``files`` files, written by as many tasks and read together.
    """
    events = sample.table(spark, folder, "events")
    shares = [i / STREAM_BATCHES for i in range(1, STREAM_BATCHES)]
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    bounds = events.agg(F.percentile_approx(micros, F.lit(shares), F.lit(1000))).first()[0]
    files = STREAM_FILES if events.count() >= STREAM_FILES * 100 else 1
    # Files are read in the order they were written in.
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = events if low is None else events.filter(micros > low)
        part = part if high is None else part.filter(micros <= high)
        part.repartition(files).write.mode("append").parquet(f"{where}/in")
    batches = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
    return sample.as_event_logs(batches.parquet(f"{where}/in"))


@_query
def pack_stream_microbatch(spark, folder):
    where = scratch(spark)
    query = microbatch.pack_stream_microbatch(
        _event_stream(spark, folder), f"{where}/out", f"{where}/state", EVENT_PACKS, available_now=True
    )
    query.awaitTermination()
    packed = spark.read.parquet(f"{where}/out")
    return packed.select(
        "topic_id", "seq", "package_seq", "create_ms", "close_ms", "close_reason"
    )


def _drain(stream: DataFrame, where: str) -> DataFrame:
    """Run a stream over all its input and return what it wrote."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{where}/out")
        .option("checkpointLocation", f"{where}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{where}/out")


def _drained_stream(spark, folder):
    """What a stream over the events closed, and what its state has open."""
    where = scratch(spark)
    stream = _event_batches(spark, folder, where)
    # The SQL knows no clock: the last package of a topic ends with the input, so the watermark
    # may close none before. Tests of the stream let it.
    closed = _drain(stateful.pack_stream(stream, EVENT_PACKS, delay_ms=10_000 * HOUR_MS), where)
    return closed, stateful.open_packages(spark, f"{where}/state", EVENT_PACKS)


@_query
def pack_stream(spark, folder):
    closed, still_open = _drained_stream(spark, folder)
    return closed.unionByName(still_open).select(
        "topic_id", "seq", "package_seq", "package_id", "create_ms", "close_ms", "close_reason"
    )


@_query
def pack_stream_carried(spark, folder):
    where = scratch(spark)
    query = carried.pack_stream_carried(
        _event_stream(spark, folder), f"{where}/out", f"{where}/state", EVENT_PACKS, available_now=True
    )
    query.awaitTermination()
    packed = carried.read_packed(spark, f"{where}/out", ended=True)
    return packed.select("topic_id", "seq", "package_id", "create_ms")


@_query
def flush_open(spark, folder):
    _, flushed = _drained_stream(spark, folder)
    return flushed.groupBy("topic_id", "package_seq").agg(
        F.count("*").alias("n_logs"), F.max("close_ms").alias("close_ms")
    )


@_query
def retry_stream(spark, folder):
    """The schedule as a stream makes it: answers in four batches, then the clock moves on."""
    where = scratch(spark)
    attempts = sample.event_attempts(spark, folder)
    for first, last in ((1, 1), (2, 2), (3, 4), (5, 99)):
        batch = retries.answers_of(attempts.filter(F.col("attempt_no").between(first, last)))
        batch.repartition(STREAM_FILES).write.mode("append").parquet(f"{where}/in")
    news = spark.readStream.schema(retries.NEWS).option("maxFilesPerTrigger", STREAM_FILES).parquet(f"{where}/in")
    # No timer fires before the clock is moved, beyond every retry time.
    due = retries.retry_stream(news, RETRIES, delay_ms=10_000 * HOUR_MS)
    _drain(due, where)
    newest = attempts.agg(F.max("ts_ms")).first()[0] or 0
    retries.clock_rows(spark, newest + 20_000 * HOUR_MS).write.mode("append").parquet(f"{where}/in")
    return _drain(due, where).select("package_id", "attempt_no", "failures", "ts_ms", "wait_ms", "next_retry_ms")


@_query
def pending_retries(spark, folder):
    """The schedule as it stands in the state of a stopped stream."""
    where = scratch(spark)
    retries.answers_of(sample.event_attempts(spark, folder)).write.parquet(f"{where}/in")
    news = spark.readStream.schema(retries.NEWS).parquet(f"{where}/in")
    _drain(retries.retry_stream(news, RETRIES, delay_ms=10_000 * HOUR_MS), where)
    return retries.pending_retries(spark, f"{where}/state", RETRIES)


@_query
def retry_pass(spark, folder):
    where = scratch(spark)
    outboxes.write_outbox(_encoded(spark, folder, "none"), f"{where}/outbox", 0)
    outbox = outboxes.read_outbox(spark, f"{where}/outbox")
    workers = DeliveryOptions(workers=4)
    attempts = spark.createDataFrame([], ATTEMPTS)
    for pass_id in range(3):
        attempts = send.retry_pass(
            outbox, attempts, _answer, f"{where}/attempts", pass_id, NOW_MS * 2, opts=workers
        )
    return attempts.select("package_id", "topic_id", "attempt_no", "http_code")
