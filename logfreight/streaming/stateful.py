"""Streaming packing with packages that stay open across micro-batches.

The state of a (producer, topic) is the rows of its open package and a counter, so it is
bounded by the limits of a package. A package closes when a later row closes it, when its
linger time has passed (by the watermark in event time, by the clock in processing time), or
when a mark for its (producer, topic) is read.

In event time Spark drops rows behind the watermark. Here none may be lost, so log rows carry no
event time at all; beside each goes a tick, a narrow row with the time and nothing else, which
moves the watermark and may be dropped. A log that comes late is packed as arriving with the
one before it.

What a stopped stream has open can be read from its state (``open_packages``), without marks
and without another run.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from logfreight.functions.ids import number_in_id, package_id, run_number
from logfreight.functions.sizes import field_size, log_size, log_wire_size, opening_metadata_size
from logfreight.model import LOGS, PAIRS, PackOptions
from logfreight.plans import greedy

EVENT_TIME = "eventTime"
PROCESSING_TIME = "processingTime"
TICK_TOPIC = "\u0001tick"
# Ticks are dealt over so many groups, which hold no state.
TICK_GROUPS = 64
# Number of a row that closes what its (producer, topic) has open.
FLUSH_SEQ = -(1 << 63)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_HELD = [
    ("seq", "long"),
    ("arrival_ms", "long"),
    ("time", "long"),
    ("pairs", "string"),
    ("collect_time", "long"),
    ("size_bytes", "long"),
    ("logs_wire_bytes", "long"),
]
_HELD_NAMES = [name for name, _ in _HELD]
_HELD_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in _HELD)
_OUT_SCHEMA = (
    f"topic_id string, producer string, {_HELD_SCHEMA}, n_logs long, package_seq long, "
    "create_ms long, close_ms long, close_reason string, run long"
)
QUERY_ID = "sql.streaming.queryId"


def _run_of(query_id: str) -> int:
    """The run that goes into ids: a query keeps its id, and so its run, over all its restarts."""
    return zlib.crc32(query_id.encode())


def _plain(value):
    return None if pd.isna(value) else int(value)


class _Packer(StatefulProcessor):
    def __init__(self, limits: PackOptions, time_mode: str, run: int) -> None:
        self.limits, self.run = limits, run
        self.by_clock = time_mode == PROCESSING_TIME
        self.metadata = opening_metadata_size(limits.source, limits.hostname)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _HELD_SCHEMA)
        self.counter = handle.getValueState("counter", "opened long, due_ms long, timer_ms long")

    def _load(self) -> tuple[pd.DataFrame, int, int, int]:
        held = pd.DataFrame([tuple(row) for row in self.held.get()], columns=_HELD_NAMES)
        opened, due, timer = tuple(self.counter.get()) if self.counter.exists() else (0, -1, -1)
        return held, opened, due, timer

    def _reset_timer(self, due: int, old_timer: int, timerValues) -> int:
        """Replace the timer of a package that is gone by that of the one due at ``due``."""
        if old_timer >= 0:
            self.handle.deleteTimer(old_timer)
        if due < 0:
            return -1
        timer = due
        if self.by_clock:
            timer = timerValues.getCurrentProcessingTimeInMs() + self.limits.linger_ms
        self.handle.registerTimer(timer)
        return timer

    def _store(self, still_open: pd.DataFrame) -> None:
        if len(still_open):
            rows = still_open[_HELD_NAMES].itertuples(index=False)
            self.held.put(
                [tuple(v if n == "pairs" else _plain(v) for n, v in zip(_HELD_NAMES, r)) for r in rows]
            )
        else:
            self.held.clear()

    def _closed(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[_HELD_NAMES].copy()
        for name in ("seq", "arrival_ms", "time", "collect_time", "size_bytes", "logs_wire_bytes"):
            out[name] = out[name].astype("Int64")
        out.insert(0, "topic_id", key[1])
        out.insert(1, "producer", key[0])
        out["n_logs"] = 1
        for name in ("package_seq", "create_ms", "close_ms", "close_reason"):
            out[name] = rows[name]
        query_id = TaskContext.get().getLocalProperty(QUERY_ID)
        named = self.limits.run_secs is None and query_id
        out["run"] = _run_of(query_id) if named else self.run
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1] == TICK_TOPIC:
            for _ in rows:
                pass
            return
        incoming = pd.concat(list(rows))
        marks = incoming["seq"] == FLUSH_SEQ
        flushing, incoming = bool(marks.any()), incoming[~marks]
        if len(incoming):
            yield from self._take(key, incoming, timerValues)
        if flushing:
            yield from self._flush(key)

    def _flush(self, key) -> Iterator[pd.DataFrame]:
        held, opened, due, timer = self._load()
        if not len(held):
            return
        self._forget(opened, timer)
        yield self._closed(
            key,
            held.assign(
                package_seq=opened,
                create_ms=self._created(held, due),
                close_ms=int(held["arrival_ms"].max()),
                close_reason="flush",
            ),
        )

    def _created(self, held: pd.DataFrame, due: int) -> int:
        return due - self.limits.linger_ms if due >= 0 else int(held["arrival_ms"].min())

    def _forget(self, opened: int, timer: int) -> None:
        """Nothing is open any more; the counter goes on."""
        if timer >= 0:
            self.handle.deleteTimer(timer)
        self.counter.update((opened, -1, -1))
        self.held.clear()

    def _take(self, key, incoming, timerValues) -> Iterator[pd.DataFrame]:
        incoming = incoming.sort_values(["arrival_ms", "seq"], kind="stable")[_HELD_NAMES]
        held, opened, old_due, timer = self._load()
        together = pd.concat([held, incoming], ignore_index=True) if len(held) else incoming
        together = together.reset_index(drop=True)

        # A row that comes late counts as arriving with the row before it.
        arrival = np.maximum.accumulate(together["arrival_ms"].to_numpy(np.int64))
        size = together["size_bytes"].to_numpy(np.int64)
        opening = together["logs_wire_bytes"].to_numpy(np.int64) + self.metadata
        first = np.arange(len(together)) == 0
        packable = greedy.Rows(arrival, size, opening, np.ones_like(size), first)
        before = opened - (len(held) > 0)
        border = greedy.Border(key=key, opened=before, tail_reason=greedy.UNKNOWN)
        number, create, close, reason = greedy.label(packable, key, border, self.limits)

        together = together.assign(package_seq=number, create_ms=create, close_ms=close)
        is_open = reason == greedy.UNKNOWN
        due = int(create[-1]) + self.limits.linger_ms if is_open[-1] else -1
        if due != old_due or int(number[-1]) != opened:
            timer = self._reset_timer(due, timer, timerValues)
        self.counter.update((int(number[-1]), due, timer))
        self._store(together[is_open])
        if not is_open.all():
            done = together[~is_open].assign(
                close_reason=np.array(greedy.REASONS)[reason[~is_open]]
            )
            yield self._closed(key, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, opened, due, timer = self._load()
        if not len(held) or expiredTimerInfo.getExpiryTimeInMs() != timer:
            return
        done = held.assign(
            package_seq=opened,
            create_ms=due - self.limits.linger_ms,
            close_ms=due,
            close_reason="linger",
        )
        self._forget(opened, -1)
        yield self._closed(key, done)

    def close(self) -> None:
        pass


def flush_rows(logs: DataFrame) -> DataFrame:
    """A mark for every (producer, topic) of ``logs``: rows that close what these have open.

    A mark moves no watermark and ends nothing: logs that are read after it are packed as
    ever. Write marks to the input of a stream (or to a folder it also reads, see
    ``with_marks``) once all logs before them have been read.
    """
    keys = logs.select("producer", "topic_id").distinct()
    marks = keys.select("topic_id", "producer", F.lit(FLUSH_SEQ).alias("seq"), F.lit(0).alias("arrival_ms"), F.lit(0).alias("time"))
    blank = {"contents": F.array().cast(PAIRS), "collect_time": F.lit(None).cast("long")}
    return marks.withColumns(blank).select(*[F.col(f.name).cast(f.dataType) for f in LOGS.fields])


def with_marks(stream: DataFrame, folder: str) -> DataFrame:
    """The stream together with a folder into which ``flush_rows`` are written.

    Only what is written after the stream has read its logs closes them: run the stream over
    its input first (``availableNow``), then write the marks and run it again.
    """
    marks = stream.sparkSession.readStream.schema(LOGS).parquet(folder)
    return stream.unionByName(marks)


def use_state_store(session: SparkSession) -> None:
    provider = "spark.sql.streaming.stateStore.providerClass"
    if not session.conf.get(provider).endswith("RocksDBStateStoreProvider"):
        session.conf.set(provider, STATE_STORE)


def open_packages(spark: SparkSession, checkpoint: str, opts: PackOptions = PackOptions()) -> DataFrame:
    """The packages that a stopped ``pack_stream`` has open, closed as ``flush``: rows like its own.

    They come from the state that its last batch committed to ``checkpoint`` (not from its
    input), so nothing has to be written, waited for or run again. The state itself stays: a stream
    that goes on from it packs its open logs on and gives them once more.
    """
    use_state_store(spark)

    def variable(name: str) -> DataFrame:
        reader = spark.read.format("statestore").option("stateVarName", name)
        return reader.load(checkpoint)

    held = variable("held").select("key.producer", "key.topic_id", "list_element.*")
    counter = variable("counter").select("key.producer", "key.topic_id", "value.opened", "value.due_ms")
    ends = held.groupBy("producer", "topic_id").agg(
        F.min("arrival_ms").alias("_first"), F.max("arrival_ms").alias("close_ms")
    )
    known = ends.join(counter, ["producer", "topic_id"]).select(
        "producer",
        "topic_id",
        F.lit(1).cast("long").alias("n_logs"),
        F.col("opened").alias("package_seq"),
        F.when(F.col("due_ms") >= 0, F.col("due_ms") - opts.linger_ms).otherwise(F.col("_first")).alias("create_ms"),
        "close_ms",
        F.lit("flush").alias("close_reason"),
    )
    told = spark.read.text(f"{checkpoint}/metadata").first()
    run = _run_of(json.loads(told[0])["id"]) if opts.run_secs is None else opts.run_secs
    both = held.join(known, ["producer", "topic_id"]).withColumn("run", F.lit(run).cast("long"))
    return _named(both)


def _named(packed: DataFrame) -> DataFrame:
    names = ["topic_id", "producer", *_HELD_NAMES, "n_logs", "package_seq", "create_ms", "close_ms", "close_reason"]
    identity = package_id(F.col("producer"), F.col("topic_id"), number_in_id(F.col("package_seq")), F.col("run"))
    named = packed.withColumn("package_id", identity).select(*names, "package_id")
    return named.withColumn("contents", F.from_json("pairs", PAIRS)).drop("pairs")


def _with_ticks(sized: DataFrame) -> DataFrame:
    """Every row without its time, and beside it a tick that has nothing but the time."""
    names = [name for name in sized.columns if name != "event_ts"]
    log = F.struct(*names, F.lit(None).cast("timestamp").alias("event_ts"))
    kept = {"topic_id": F.lit(TICK_TOPIC), "event_ts": F.col("event_ts"),
            "producer": F.pmod(F.xxhash64("seq"), F.lit(TICK_GROUPS)).cast("string")}
    kinds = dict(sized.dtypes)
    tick = F.struct(*[kept.get(n, F.lit(None).cast(kinds[n])).alias(n) for n in [*names, "event_ts"]])
    is_mark = F.col("seq") == FLUSH_SEQ
    rows = F.when(is_mark, F.array(log)).otherwise(F.array(log, tick))
    return sized.select(F.explode(rows).alias("_row")).select("_row.*")


def pack_stream(
    stream: DataFrame,
    opts: PackOptions = PackOptions(),
    time_mode: str = EVENT_TIME,
    delay_ms: int = 600_000,
) -> DataFrame:
    """Packed logs of a stream of log rows, emitted once their package is closed.

    No log is dropped. In event time a package closes once ``delay_ms`` more than its linger
    time has passed in the data; in processing time once the linger time has passed on the
    clock since the batch it was opened in, and such a query does not end by itself. All rows of a
    (producer, topic) in a micro-batch go to one task, so let the source bound the batch, deal a
    busy topic out to several producers (``producer_shards`` of the log sources), or use
    ``pack_stream_carried``. What is open is closed by ``flush_rows``, or read by
    ``open_packages`` once the stream has stopped. Without ``run_secs`` the run in package ids
    follows from the id that the query keeps in its checkpoint, so a batch that is replayed
    after a restart gives the same ids. Also takes a batch
    DataFrame. The session's state store has to be the one in ``STATE_STORE``; it is set where
    the session has none of its own.
    """
    use_state_store(stream.sparkSession)
    narrow = ["topic_id", "producer", "seq", "arrival_ms", "time", "collect_time"]
    sized = stream.selectExpr(
        *narrow,
        "to_json(contents, map('ignoreNullFields', 'false')) AS pairs",
        f"{log_size()} AS size_bytes",
        f"{log_wire_size()} AS _wire",
        "timestamp_millis(arrival_ms) AS event_ts",
    )
    wire = f"{field_size('_wire')} AS logs_wire_bytes"
    if time_mode == EVENT_TIME:
        sized = _with_ticks(sized.selectExpr(*narrow, "pairs", "size_bytes", wire, "event_ts"))
        # Ticks have done their part once the watermark has seen them.
        sized = sized.withWatermark("event_ts", f"{delay_ms} milliseconds").filter("event_ts IS NULL")
    else:
        sized = sized.selectExpr(*narrow, "pairs", "size_bytes", wire)
    packed = sized.groupBy("producer", "topic_id").transformWithStateInPandas(
        statefulProcessor=_Packer(opts, time_mode, run_number(opts.run_secs)),
        outputStructType=_OUT_SCHEMA,
        outputMode="append",
        timeMode=time_mode,
    )
    return _named(packed)
