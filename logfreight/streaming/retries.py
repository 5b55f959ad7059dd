"""Retries as a stream: packages and answers go in, packages that are due come out.

The state of a package is a few numbers: its last attempt, how often it failed, and the time
of its next try. A package that becomes known is due at once; an answer that asks
for a retry sets that time, a later answer replaces it, and when it has passed the
package is given out with the number of the attempt to make. So a pass reads what is new and what
it remembers of the packages beside it, however many attempts there are. State and times are the
same as what ``delivery_result`` and ``retry_schedule`` derive from all attempts.

Packages are dealt over ``slots`` by a hash of their id. A slot is one key of the state: its
packages are a list, read and written at once, and one timer stands for the earliest of their
times. A call of the state per package would cost more than all else.

Time is that of the answers (event time, by the watermark; narrow ticks carry it, so no late answer
is dropped) or that of the clock. A package that is settled is remembered for ``keep_ms``, so that
an outbox batch which is written again does not send it again, and then forgotten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from logfreight.model import ATTEMPTS, OUTBOX, DeliveryOptions
from logfreight.operators.delivery import classify_response
from logfreight.operators.send import PerTask, Send, deliver
from logfreight.session import written_table
from logfreight.sources.outbox import read_outbox
from logfreight.streaming.stateful import EVENT_TIME, PROCESSING_TIME, use_state_store

NEW = "new"
DAY_MS = 86_400_000
# Outbox batches that are named one by one when payloads are fetched.
NAMED_BATCHES = 1000
NEWS = "package_id string, batch_id bigint, attempt_no int, outcome string, ts_ms bigint"
_COLUMNS = ["package_id", "batch_id", "attempt_no", "outcome", "ts_ms"]
# Packages are dealt over so many keys of the state.
SLOTS = 4096
_STATE = (
    "package_id string, batch_id long, attempt_no int, failures long, ts_ms long, success boolean, "
    "terminal boolean, timer_ms long"
)
_DUE = (
    "package_id string, batch_id long, attempt_no int, failures long, ts_ms long, wait_ms long, next_retry_ms long"
)


class _Retries(StatefulProcessor):
    def __init__(self, opts: DeliveryOptions, keep_ms: int, time_mode: str = EVENT_TIME) -> None:
        self.opts, self.keep_ms = opts, keep_ms
        self.by_clock = time_mode == PROCESSING_TIME

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.told = handle.getListState("told", _STATE)
        self.alarm = handle.getValueState("alarm", "timer_ms long")

    def _wait(self, failures: int) -> int:
        # 2.0 ** 1023 is the largest power that a double holds.
        doubled = 2.0 ** min(failures - 1, 1023) * self.opts.backoff_ms
        return int(min(doubled, float(self.opts.max_backoff_ms)))

    def _due(self, package: str, told: tuple, wait: int) -> tuple:
        batch, attempt, failures, ts, *_ = told
        return package, batch, attempt + 1, failures, ts, wait, ts + wait

    def _settled(self, told: tuple) -> bool:
        _, _, failures, _, success, terminal, _ = told
        return success or terminal or failures > self.opts.retries

    def _load(self) -> dict[str, tuple]:
        return {package: told for package, *told in self.told.get()}

    def _store(self, all_told: dict[str, tuple], fired: bool = False) -> None:
        """Write the slot back, with a timer for the earliest time in it."""
        if all_told:
            self.told.put([(package, *told) for package, told in all_told.items()])
        else:
            self.told.clear()
        before = self.alarm.get()[0] if self.alarm.exists() else -1
        after = min((told[-1] for told in all_told.values() if told[-1] >= 0), default=-1)
        if before == after and not fired:
            return
        if before >= 0 and not fired:
            self.handle.deleteTimer(before)
        if after >= 0:
            self.handle.registerTimer(after)
            self.alarm.update((after,))
        elif before >= 0:
            self.alarm.clear()

    def _learn(self, news: list[tuple], known: tuple | None) -> tuple[tuple, bool]:
        """What is told of a package after ``news`` of it in order, and whether it is due at once."""
        batch, attempt, failures, ts, success, terminal, timer = known or (None, 0, 0, 0, False, False, -1)
        answered = False
        for batch_id, attempt_no, outcome, ts_ms in news:
            if not pd.isna(batch_id):
                batch = int(batch_id)
            if outcome == NEW:
                ts = ts if known else int(ts_ms)
                continue
            answered = True
            if attempt_no >= attempt:
                attempt, ts, success = int(attempt_no), int(ts_ms), outcome == "success"
            failures += outcome != "success"
            terminal = terminal or outcome == "terminal"
        if answered:
            settled = self._settled((batch, attempt, failures, ts, success, terminal, timer))
            timer = ts + (self.keep_ms if settled else self._wait(failures))
        # The same package again changes nothing but its place.
        return (batch, attempt, failures, ts, success, terminal, timer), not (known or answered)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        news = pd.concat(list(rows))
        news = news[news["package_id"].notna()].sort_values(["attempt_no", "ts_ms"], kind="stable")
        if not len(news):  # a tick without a time
            return
        by_package: dict[str, list[tuple]] = {}
        columns = [news[name].tolist() for name in _COLUMNS]
        for package, *row in zip(*columns):
            by_package.setdefault(package, []).append(row)
        all_told, due = self._load(), []
        for package, of_package in by_package.items():
            told, at_once = self._learn(of_package, all_told.get(package))
            all_told[package] = told
            if at_once:
                due.append(self._due(package, told, 0))
        self._store(all_told)
        yield from _frames(due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        expired = expiredTimerInfo.getExpiryTimeInMs()
        if not self.alarm.exists() or self.alarm.get()[0] != expired:
            return
        # One timer fires for all whose time has passed.
        now = max(expired, self._now(timerValues) - 1)
        all_told, due = self._load(), []
        for package, told in list(all_told.items()):
            if not 0 <= told[-1] <= now:
                continue
            if self._settled(told):
                del all_told[package]
                continue
            all_told[package] = (*told[:-1], -1)
            due.append(self._due(package, told, self._wait(told[2])))
        self._store(all_told, fired=True)
        yield from _frames(due)

    def _now(self, timerValues) -> int:
        if self.by_clock:
            return timerValues.getCurrentProcessingTimeInMs()
        return timerValues.getCurrentWatermarkInMs()

    def close(self) -> None:
        pass


def _frames(due: list[tuple]) -> Iterator[pd.DataFrame]:
    if due:
        yield pd.DataFrame(due, columns=[f.split()[0] for f in _DUE.split(", ")]).astype({"batch_id": "Int64"})


def answers_of(attempts: DataFrame) -> DataFrame:
    """Attempts (a table or a stream) as what ``retry_stream`` takes."""
    told = classify_response(attempts)
    columns = ["package_id", "CAST(NULL AS bigint) AS batch_id", "CAST(attempt_no AS int) AS attempt_no", "outcome", "ts_ms"]
    return told.selectExpr(*columns)


def packages_of(outbox: DataFrame, since_ms: str = "unix_millis(current_timestamp())") -> DataFrame:
    """Outbox rows (a table or a stream) as what ``retry_stream`` takes; ``since_ms`` is when."""
    batch = "batch_id" if "batch_id" in outbox.columns else "CAST(NULL AS bigint)"
    return outbox.selectExpr(
        "package_id", f"CAST({batch} AS bigint) AS batch_id", "0 AS attempt_no", f"'{NEW}' AS outcome", f"{since_ms} AS ts_ms"
    )


def clock_rows(spark: SparkSession, now_ms: int) -> DataFrame:
    """A row that only moves the time of an event-time ``retry_stream`` on."""
    return spark.createDataFrame([(None, None, None, None, now_ms)], NEWS)


def retry_stream(
    news: DataFrame,
    opts: DeliveryOptions = DeliveryOptions(),
    time_mode: str = EVENT_TIME,
    delay_ms: int = 0,
    keep_ms: int = DAY_MS,
    slots: int = SLOTS,
) -> DataFrame:
    """Packages to send now: package_id, batch_id, attempt_no, failures, ts_ms, wait_ms, next_retry_ms.

    ``news`` is a stream of ``packages_of`` and ``answers_of`` rows. A package is given out
    once when it becomes known and once whenever its retry time has passed without another answer.
    With event time the time is that of the newest row less ``delay_ms``. A batch reads and writes the
    ``slots`` that it has rows for, so let them grow with the packages that are waited for
    (a few thousand in each) and stay the same for a checkpoint.
    """
    use_state_store(news.sparkSession)
    rows = news.select(*_COLUMNS)
    if time_mode == EVENT_TIME:
        none = [F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in NEWS.split(", ")]
        tick = F.struct(*none, F.timestamp_millis("ts_ms").alias("event_ts"))
        news_row = F.struct(*_COLUMNS, F.lit(None).cast("timestamp").alias("event_ts"))
        both = F.when(F.col("package_id").isNull(), F.array(tick)).otherwise(F.array(news_row, tick))
        rows = rows.select(F.explode(both).alias("_row")).select("_row.*")
        # Ticks have done their part once the watermark has seen them.
        rows = rows.withWatermark("event_ts", f"{delay_ms} milliseconds").filter("event_ts IS NULL")
    else:
        rows = rows.filter("package_id IS NOT NULL")
    slot = F.pmod(F.xxhash64("package_id"), F.lit(slots)).alias("slot")
    return rows.select(slot, "*").groupBy("slot").transformWithStateInPandas(
        statefulProcessor=_Retries(opts, keep_ms, time_mode),
        outputStructType=_DUE,
        outputMode="append",
        timeMode=time_mode,
    )


def pending_retries(spark: SparkSession, checkpoint: str, opts: DeliveryOptions = DeliveryOptions()) -> DataFrame:
    """What a stopped ``retry_stream`` still waits for, from its state: columns of ``retry_schedule``."""
    use_state_store(spark)
    told = spark.read.format("statestore").option("stateVarName", "told").load(checkpoint)
    told = told.select("list_element.*")
    waiting = told.filter(f"attempt_no > 0 AND NOT success AND NOT terminal AND failures <= {opts.retries} AND timer_ms >= 0")
    return waiting.selectExpr("package_id", "failures", "ts_ms", "timer_ms - ts_ms AS wait_ms", "timer_ms AS next_retry_ms")


def deliver_stream(
    spark: SparkSession,
    outbox_path: str,
    attempts_path: str,
    send: Send | PerTask,
    checkpoint: str,
    opts: DeliveryOptions = DeliveryOptions(),
    clock: Callable[[], int] | None = None,
    every_ms: int | None = None,
) -> StreamingQuery:
    """Send what is in an outbox and what comes into it, with retries, until stopped.

    One query reads new outbox files and the answers that its own sends have recorded, keeps the
    retry state by the clock, and in every batch sends what is due with ``deliver``, whose
    pass is the batch. Payloads are read for due packages only, from the outbox batches that
    hold them. A batch that is repeated after a failure resends its packages (at least once).
    """
    spark.createDataFrame([], ATTEMPTS).write.mode("append").parquet(f"{attempts_path}/pass_id=-1/wave=0")
    outbox = spark.readStream.schema(T.StructType([*OUTBOX.fields, T.StructField("batch_id", T.LongType())])).parquet(outbox_path)
    folders = [T.StructField("pass_id", T.LongType()), T.StructField("wave", T.IntegerType())]
    answers = spark.readStream.schema(T.StructType([*ATTEMPTS.fields, *folders])).parquet(attempts_path)
    news = packages_of(outbox).unionByName(answers_of(answers))
    due = retry_stream(news, opts, PROCESSING_TIME)
    more = {} if clock is None else {"clock": clock}

    def run(batch: DataFrame, batch_id: int) -> None:
        wanted = written_table(batch)
        batches = [r[0] for r in wanted.select("batch_id").distinct().limit(NAMED_BATCHES + 1).collect()]
        if not batches:
            return
        held = read_outbox(spark, outbox_path)
        if len(batches) <= NAMED_BATCHES and None not in batches:
            held = held.filter(F.col("batch_id").isin(batches))  # prunes folders
        # A batch of the outbox may have been written twice, so a package is found once only.
        found = held.join(wanted.select("package_id", "attempt_no", "next_retry_ms"), "package_id")
        deliver(found.dropDuplicates(["package_id"]), send, attempts_path, batch_id, opts, **more)

    trigger = f"{opts.backoff_ms if every_ms is None else every_ms} milliseconds"
    return due.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(processingTime=trigger).start()
