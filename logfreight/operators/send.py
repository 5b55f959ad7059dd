"""Delivering packages with a send function supplied by the user.

How work is cut does not depend on how much is sent at a time. Packages are dealt into parts of
about ``task_bytes`` of payload, so a lost task resends a small part of everything. No more
than ``workers`` parts are sent at once: where executors take resource profiles, every task of
one job asks for so many cores that no more than that many run (``send_slots``); elsewhere
parts are sent in waves of ``workers``, a job each.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass

import pandas as pd
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logfreight.functions import codecs
from logfreight.model import ATTEMPTS, MAX_REQUEST_BYTES, MAX_REQUEST_LOGS, DeliveryOptions
from logfreight.operators.assemble import assemble_requests, encode_requests
from logfreight.operators.delivery import (
    NO_REQUEST_ID,
    NO_RESPONSE,
    delivery_result,
    merge_tallies,
    results_of,
    retry_wait,
    tallies,
    unsent,
)
from logfreight.session import remove_folder, scratch, written_table

# send(topic_id, payload, compress_type) -> (http_code, request_id, body)
Send = Callable[[str, bytes, str], tuple[int, str, str]]


@dataclass(frozen=True)
class PerTask:
    """A send function that every task opens for itself: ``open()`` gives a context manager
    around it, which holds what a client has to keep and close."""

    open: Callable[[], AbstractContextManager[Send]]


def _now_ms() -> int:
    return time.time_ns() // 1_000_000


def _sender(send: Send | PerTask, clock: Callable[[], int]):
    names = [field.name for field in ATTEMPTS.fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with send.open() if isinstance(send, PerTask) else nullcontext(send) as client:
            for frame in frames:
                answers = []
                for row in frame.itertuples(index=False):
                    try:
                        code, request_id, body = client(row.topic_id, row.payload, row.compress_type)
                    except OSError as error:  # connections and time-outs; others are mistakes
                        code, request_id, body = NO_RESPONSE, NO_REQUEST_ID, str(error)
                    answers.append(
                        (row.package_id, row.topic_id, row.attempt_no, code, request_id, body, clock())
                    )
                yield pd.DataFrame(answers, columns=names)

    return run


def send_slots(spark: SparkSession, workers: int) -> ResourceProfile | None:
    """A profile under which at most ``workers`` tasks of a job run at a time.

    Each task asks for ``ceil(cores / workers)`` cores. There is none where it cannot bound
    them: in local mode, which has no profiles, with fewer workers than executors, or without
    an end to dynamic allocation.
    """
    context = spark.sparkContext
    conf = context.getConf()
    cluster = re.match(r"local-cluster\[\s*(\d+)\s*,\s*(\d+)", context.master)
    if context.master.startswith("local") and not cluster:
        return None
    each = int(cluster[2]) if cluster else int(conf.get("spark.executor.cores", "1"))
    cores = int(cluster[1]) * each if cluster else context.defaultParallelism
    if conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        most = conf.get("spark.dynamicAllocation.maxExecutors", "")
        if not most.isdigit():
            return None
        cores = int(most) * each
    share = -(-cores // workers)
    # An executor runs whole tasks, so its share of the workers must be one at least.
    if share > each or cores // each * (each // share) > workers:
        return None
    return ResourceProfileBuilder().require(TaskResourceRequests().cpus(share)).build


def _parts_of(due: DataFrame, opts: DeliveryOptions) -> int:
    """How many parts of about ``task_bytes`` there are; one per worker where that is more."""
    size = "payload_bytes" if "payload_bytes" in due.columns else "octet_length(payload)"
    total = due.agg(F.sum(F.expr(size))).first()[0] or 0
    return max(opts.workers, -(-int(total) // opts.task_bytes))


def _send_parts(rows: DataFrame, parts: int, run, target: str, profile: ResourceProfile | None = None) -> None:
    """Send rows (with ``_part``, below ``parts``) by one task per part and write the answers."""
    spread = rows.repartitionById(parts, F.col("_part"))
    spread = spread.sortWithinPartitions(F.col("next_retry_ms").asc_nulls_first(), "package_id")
    sent = spread.drop("_part", "next_retry_ms").mapInPandas(run, ATTEMPTS, profile=profile)
    sent.write.mode("overwrite").parquet(target)


def deliver(
    due: DataFrame,
    send: Send | PerTask,
    path: str,
    pass_id: int,
    opts: DeliveryOptions = DeliveryOptions(),
    clock: Callable[[], int] = _now_ms,
) -> DataFrame:
    """Send each due package once and return the recorded answers.

    ``due`` holds outbox columns and the ``attempt_no`` to record (1 if there is none); with
    ``next_retry_ms``, each task sends the earliest first. An ``OSError`` of the send function
    (connection, time-out) is recorded as no response; any other error ends the job.
    No more than ``workers`` tasks send at a time, however many parts there are. Answers are
    written to ``path/pass_id=<pass_id>`` before anything reads them, so reading again does not
    send again. ``due`` is evaluated for its sizes and then for its payloads, so let it come
    from a table. A lost task is run again and its packages are resent: delivery is at least
    once, and the package id lets the receiver tell. Keep speculative execution off.
    """
    spark = due.sparkSession
    for name, value in (("attempt_no", F.lit(1)), ("next_retry_ms", F.lit(None).cast("long"))):
        due = due if name in due.columns else due.withColumn(name, value)
    parts, run = _parts_of(due, opts), _sender(send, clock)
    names = ["package_id", "topic_id", "compress_type", "payload", "attempt_no", "next_retry_ms"]
    part = F.pmod(F.xxhash64("package_id"), F.lit(parts)).cast("int")
    rows = due.select(*names, part.alias("_part"))
    target = f"{path}/pass_id={pass_id}"
    remove_folder(spark, target)  # an earlier try of this pass may have had more waves
    profile = send_slots(spark, opts.workers) if parts > opts.workers else None
    if profile or parts <= opts.workers:
        _send_parts(rows, parts, run, f"{target}/wave=0", profile)
    else:
        # Each wave reads its own folder: payloads are written once and shuffled once.
        staged, wave = scratch(spark, "due"), F.expr(f"_part div {opts.workers}").cast("int")
        rows.withColumn("_wave", wave).write.partitionBy("_wave").parquet(staged)
        kind = T.StructType([*rows.schema.fields, T.StructField("_wave", T.IntegerType())])
        for number in range(-(-parts // opts.workers)):
            mine = spark.read.schema(kind).parquet(staged).filter(F.col("_wave") == number).drop("_wave")
            first = number * opts.workers
            here = mine.withColumn("_part", F.col("_part") - first)
            _send_parts(here, min(opts.workers, parts - first), run, f"{target}/wave={number}")
    answers = [f"{target}/wave={n}" for n in range(1 if profile else -(-parts // opts.workers))]
    return spark.read.schema(ATTEMPTS).parquet(*answers)


def due_packages(
    outbox: DataFrame,
    attempts: DataFrame,
    now_ms: int,
    closing: bool = False,
    opts: DeliveryOptions = DeliveryOptions(),
) -> DataFrame:
    """Outbox rows to send now, never tried or due again, with their ``attempt_no``.

    What is due is decided on ids, which are written once; payloads are joined to them. ``next_retry_ms`` is null for packages that were never tried.
    """
    return due_by(outbox, delivery_result(attempts, opts), now_ms, closing, opts)


def due_by(
    outbox: DataFrame, results: DataFrame, now_ms: int, closing: bool = False, opts: DeliveryOptions = DeliveryOptions()
) -> DataFrame:
    """``due_packages`` from results."""
    results = results.select("package_id", "state", "failures", "ts_ms")
    known = outbox.select("package_id").join(results, "package_id", "left")
    next_ms = F.col("ts_ms") + retry_wait(opts)
    again = F.col("state") == "retrying"
    again = again if closing else again & (next_ms < now_ms)
    due = known.filter(F.col("state").isNull() | again).select(
        "package_id",
        (F.coalesce("failures", F.lit(0)) + 1).cast("int").alias("attempt_no"),
        next_ms.alias("next_retry_ms"),
    )
    return outbox.join(written_table(due), "package_id")


def send_requests(
    groups: DataFrame,
    by: Sequence[str],
    order: str,
    send: Send | PerTask,
    path: str,
    topic: Column | None = None,
    pass_id: int = 0,
    compress_type: str = codecs.LZ4,
    max_bytes: int = MAX_REQUEST_BYTES,
    max_logs: int = MAX_REQUEST_LOGS,
    opts: DeliveryOptions = DeliveryOptions(),
) -> tuple[DataFrame, DataFrame]:
    """(attempts, rejected): check requests of groups and send each accepted one once.

    The direct way without outbox and retries. ``groups`` are stamped rows as
    ``assemble_requests`` takes them; a request is named after its ``by`` columns.
    """
    requests, rejected = assemble_requests(groups, by, order, max_bytes, max_logs)
    name = F.concat_ws("/", *[F.col(c).cast("string") for c in by])
    topic_id = (F.lit("") if topic is None else topic).alias("topic_id")
    encoded = encode_requests(requests, by, compress_type)
    due = encoded.select(name.alias("package_id"), topic_id, "compress_type", "payload")
    return deliver(due, send, path, pass_id, opts), rejected


def retry_pass(
    outbox: DataFrame,
    attempts: DataFrame,
    send: Send | PerTask,
    path: str,
    pass_id: int,
    now_ms: int,
    closing: bool = False,
    opts: DeliveryOptions = DeliveryOptions(),
    clock: Callable[[], int] = _now_ms,
) -> DataFrame:
    """One pass over the outbox; returns all attempts so far, the new ones included."""
    due = due_packages(outbox, attempts, now_ms, closing, opts)
    sent = deliver(due, send, path, pass_id, opts, clock)
    return attempts.select(*sent.columns).unionByName(sent)


def tallied_pass(
    outbox: DataFrame,
    send: Send | PerTask,
    path: str,
    tally_path: str,
    pass_id: int,
    now_ms: int,
    closing: bool = False,
    opts: DeliveryOptions = DeliveryOptions(),
    clock: Callable[[], int] = _now_ms,
) -> DataFrame:
    """``retry_pass`` that reads no earlier attempts: results of all passes so far.

    It reads the tallies that pass ``pass_id - 1`` left (none for pass 0), one row per package,
    and leaves its own, so a pass costs its own attempts and the number of packages.
    """
    spark = outbox.sparkSession
    if pass_id:
        known = spark.read.parquet(f"{tally_path}/pass_id={pass_id - 1}")
    else:
        known = tallies(spark.createDataFrame([], ATTEMPTS))
    due = due_by(outbox, results_of(known, opts), now_ms, closing, opts)
    sent = deliver(due, send, path, pass_id, opts, clock)
    target = f"{tally_path}/pass_id={pass_id}"
    merge_tallies(known, tallies(sent)).write.mode("overwrite").parquet(target)
    return results_of(spark.read.parquet(target), opts)


def read_attempts(spark: SparkSession, path: str) -> DataFrame:
    """The attempts recorded by all passes under ``path``."""
    return spark.read.schema(ATTEMPTS).parquet(path)


def drain(
    outbox: DataFrame,
    attempts: DataFrame,
    send: Send | PerTask,
    path: str,
    first_pass: int,
    deadline_ms: int,
    opts: DeliveryOptions = DeliveryOptions(),
    clock: Callable[[], int] = _now_ms,
) -> tuple[DataFrame, DataFrame]:
    """Close: repeat passes without waiting for retry times until all is settled or time is over.

    Returns all attempts and what is left unsent. A pass that has begun is finished.
    """
    pass_id = first_pass
    while True:
        left = unsent(outbox, delivery_result(attempts, opts))
        if left.limit(1).count() == 0 or clock() >= deadline_ms:
            return attempts, left
        attempts = retry_pass(outbox, attempts, send, path, pass_id, clock(), True, opts, clock)
        pass_id += 1
