"""Retries as a stream, against the schedule that follows from all attempts."""

import time

import pytest
from pyspark.sql import functions as F

from logfreight.model import ATTEMPTS, OUTBOX, DeliveryOptions
from logfreight.operators import delivery
from logfreight.operators.send import read_attempts
from logfreight.plans.sample_tables import event_attempts
from logfreight.sources.outbox import write_outbox
from logfreight.streaming import retries

HOUR_MS = 3_600_000
OPTS = DeliveryOptions(retries=2, backoff_ms=100, max_backoff_ms=350)


def attempt(package, number, code, ts):
    return (package, "t", number, code, "r", "{}", ts)


class Stream:
    """A retry stream over what is written to a folder, run over all of it when asked."""

    def __init__(self, spark, where, **how):
        self.spark, self.where = spark, where
        retries.answers_of(spark.createDataFrame([], ATTEMPTS)).write.parquet(f"{where}/in")
        files = spark.readStream.schema(retries.NEWS).option("maxFilesPerTrigger", 1)
        self.due = retries.retry_stream(files.parquet(f"{where}/in"), **{"opts": OPTS, **how})
        self.seen = 0

    def give(self, *frames):
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(f"{self.where}/in")
        query = (
            self.due.writeStream.format("parquet").option("path", f"{self.where}/out")
            .option("checkpointLocation", f"{self.where}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination(240)
        assert query.exception() is None
        rows = self.spark.read.schema(self.due.schema).parquet(f"{self.where}/out").collect()
        rows.sort(key=lambda r: (r.package_id, r.attempt_no))
        self.seen, new = len(rows), len(rows) - self.seen
        return rows, new

    def answers(self, *rows):
        return retries.answers_of(self.spark.createDataFrame(rows, ATTEMPTS))

    def known(self, *packages, at=0):
        boxes = self.spark.createDataFrame([(p, "none", 1, 1, b"x", "t") for p in packages], OUTBOX)
        return retries.packages_of(boxes, str(at))


def test_timers_and_answers(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    rows, _ = stream.give(stream.known("a", "b", "c", "d"))
    assert [(r.package_id, r.attempt_no, r.failures, r.wait_ms) for r in rows] == [(p, 1, 0, 0) for p in "abcd"]
    # a fails, b is answered, c is refused for good, d fails twice; nothing is due yet.
    first = [attempt("a", 1, 500, 1000), attempt("b", 1, 200, 1000), attempt("c", 1, 404, 1000), attempt("d", 1, 429, 950)]
    _, new = stream.give(stream.answers(*first))
    assert new == 0
    _, new = stream.give(stream.answers(attempt("d", 2, -1, 1050)))
    assert new == 0  # d waits for 1250 now
    rows, new = stream.give(retries.clock_rows(spark, 1101))
    assert new == 1
    assert [(r.attempt_no, r.failures, r.ts_ms, r.wait_ms, r.next_retry_ms) for r in rows if r.package_id == "a"][1:] == [
        (2, 1, 1000, 100, 1100)
    ]
    # The outbox batch is written again: nothing is sent twice. A late answer is not dropped.
    rows, new = stream.give(stream.known("a", "b", "c", "d", at=5), stream.answers(attempt("a", 2, 500, 500)))
    assert new == 1 and [r.next_retry_ms for r in rows if r.package_id == "a"] == [0, 1100, 700]
    rows, new = stream.give(retries.clock_rows(spark, 9000))
    assert [(r.attempt_no, r.next_retry_ms) for r in rows if r.package_id == "d"] == [(1, 0), (3, 1250)]
    # More failures than retries: given up, and forgotten a day later.
    _, new = stream.give(stream.answers(attempt("a", 3, 500, 9100), attempt("d", 3, 200, 9100)), retries.clock_rows(spark, 99_000))
    assert new == 0
    state = spark.read.format("statestore").option("stateVarName", "told")
    assert state.load(f"{tmp_path}/state").count() == 4
    stream.give(retries.clock_rows(spark, 10 * retries.DAY_MS))
    assert state.load(f"{tmp_path}/state").count() == 0


@pytest.mark.parametrize("delay_ms", [0, 10_000 * HOUR_MS])
def test_last_word_equals_schedule(spark, folder, tmp_path, delay_ms):
    # Batches by attempt: with no delay timers fire between them, and the last one to fire counts.
    attempts = event_attempts(spark, folder)
    stream = Stream(spark, tmp_path, delay_ms=delay_ms)
    for first, last in ((1, 1), (2, 2), (3, 99)):
        stream.give(retries.answers_of(attempts.filter(F.col("attempt_no").between(first, last))))
    wanted = delivery.retry_schedule(attempts, OPTS)
    if delay_ms:
        assert stream.seen == 0
        pending = retries.pending_retries(spark, f"{tmp_path}/state", OPTS)
        assert sorted(pending.select(wanted.columns).collect()) == sorted(wanted.collect())
    newest = attempts.agg(F.max("ts_ms")).first()[0]
    rows, _ = stream.give(retries.clock_rows(spark, newest + 20_000 * HOUR_MS))
    last = {r.package_id: r for r in rows}
    settled = {r.package_id for r in delivery.delivery_result(attempts, OPTS).filter("state <> 'retrying'").collect()}
    got = sorted((r.package_id, r.failures, r.ts_ms, r.wait_ms, r.next_retry_ms) for r in last.values() if r.package_id not in settled)
    assert got == sorted(tuple(r) for r in wanted.collect())
    assert retries.pending_retries(spark, f"{tmp_path}/state", OPTS).count() == 0


def test_waits_equal_the_schedule(spark):
    opts = DeliveryOptions(retries=5000, backoff_ms=100, max_backoff_ms=50_000)
    frame = spark.range(1, 12).selectExpr("CAST(id AS string) AS package_id", "id AS failures")
    by_spark = {int(r.package_id): r.w for r in frame.select("package_id", delivery.retry_wait(opts).alias("w")).collect()}
    processor = retries._Retries(opts, 0)
    assert {n: processor._wait(n) for n in range(1, 12)} == by_spark
    assert processor._wait(4000) == 50_000


def test_packages_of_a_slot_keep_their_own_times(spark, tmp_path):
    stream = Stream(spark, tmp_path, slots=1)
    rows, _ = stream.give(stream.known("a", "b", "c", "d"))
    assert [r.package_id for r in rows] == ["a", "b", "c", "d"]
    told = [attempt(p, 1, code, ts) for p, code, ts in (("a", 500, 1000), ("b", 429, 1020), ("c", 500, 1060), ("d", 200, 1060))]
    _, new = stream.give(stream.answers(*told))
    assert new == 0
    rows, new = stream.give(retries.clock_rows(spark, 1130))
    assert new == 2 and [(r.package_id, r.next_retry_ms) for r in rows if r.attempt_no == 2] == [("a", 1100), ("b", 1120)]
    state = spark.read.format("statestore").option("stateVarName", "told").load(f"{tmp_path}/state")
    assert state.count() == 4 and state.select("key").distinct().count() == 1
    # An earlier time replaces the timer of the slot; a later one of another package stays.
    rows, new = stream.give(stream.answers(attempt("a", 2, 500, 940)), retries.clock_rows(spark, 1145))
    assert new == 1 and [(r.attempt_no, r.next_retry_ms) for r in rows if r.package_id == "a"][-1] == (3, 1140)
    rows, new = stream.give(retries.clock_rows(spark, 1161))
    assert new == 1 and [r.next_retry_ms for r in rows if r.package_id == "c"] == [0, 1160]


def by_first_byte(topic_id, payload, compress_type):
    if payload[0] == 5:
        raise ConnectionError("unreachable")
    return [200, 500, 404, 429, 400][payload[0]], "id", "{}"


def test_delivery_as_one_stream(spark, tmp_path):
    box = spark.createDataFrame([(str(p), "none", 1, 1, bytes([p]), f"t{p % 2}") for p in range(6)], OUTBOX)
    write_outbox(box.filter("package_id < '3'"), f"{tmp_path}/outbox", 0)
    opts = DeliveryOptions(retries=1, backoff_ms=200, workers=2)
    query = retries.deliver_stream(spark, f"{tmp_path}/outbox", f"{tmp_path}/attempts", by_first_byte, f"{tmp_path}/state", opts)
    wanted = {"0": [1], "1": [1, 2], "2": [1], "3": [1, 2], "4": [1, 2], "5": [1, 2]}
    end, tries, more = time.monotonic() + 240, {}, False
    try:
        while tries != wanted and time.monotonic() < end and query.isActive:
            time.sleep(2)
            tries = {}
            try:
                for r in read_attempts(spark, f"{tmp_path}/attempts").collect():
                    tries.setdefault(r.package_id, []).append(r.attempt_no)
            except Exception:  # a pass is just being written
                continue
            tries = {p: sorted(n) for p, n in tries.items()}
            if not more and len(tries) == 3:
                write_outbox(box.filter("package_id >= '3'"), f"{tmp_path}/outbox", 1)
                more = True
        time.sleep(3)  # nothing more is sent
        assert query.exception() is None
    finally:
        query.stop()
    attempts = read_attempts(spark, f"{tmp_path}/attempts").select(*ATTEMPTS.fieldNames())
    assert attempts.count() == 10
    found = {r.package_id: r for r in delivery.delivery_result(attempts, opts).collect()}
    assert {p: r.state for p, r in found.items()} == {"0": "success", **{p: "failed" for p in "12345"}}
    first = {(r.package_id, r.attempt_no): r.ts_ms for r in attempts.collect()}
    assert all(first[p, 2] - first[p, 1] >= 200 for p in "1345")
