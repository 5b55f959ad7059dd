"""Packing logs into packages bounded by bytes, count and linger time.

The packing is greedy in arrival order and exact, and no sequence is handed to a single
task: see ``plans.greedy`` for the rules and how slices of a sequence are put together.
Only keys and sizes are sorted and checkpointed; contents are joined back afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logfreight.functions.ids import name_in_id, number_in_id, package_id, run_number
from logfreight.functions.sizes import (
    field_size,
    list_size,
    log_size,
    log_wire_size,
    logs_wire_size,
    opening_metadata_size,
)
from logfreight.model import PackOptions
from logfreight.plans import greedy
from logfreight.plans.ordered import (
    PART_BITS,
    previous_value,
    range_ordered,
    read_once,
    running_sums,
)

SEQUENCE = ["producer", "topic_id"]
ARRIVAL = ["arrival_ms", "seq"]
ROW = SEQUENCE + ARRIVAL
SIZES = ["size_bytes", "logs_wire_bytes", "n_logs"]
CELL = ["bucket", "by_bytes", "by_count"]
_NUMBERS = ["package_seq", "create_ms", "close_ms"]
FANOUT = 32

_SUMMARY = (
    "part int, first_key array<string>, last_key array<string>, one_run boolean, "
    "run_rows long, run_bytes long, run_logs long, head_ms array<long>, "
    "head_bytes array<long>, head_logs array<long>, last_ms long, is_open array<boolean>, "
    "size array<long>, logs array<long>, create_ms array<long>, opened array<long>"
)
_LABELS = (
    "producer string, topic_id string, arrival_ms long, seq long, size_bytes long, "
    "logs_wire_bytes long, n_logs long, package_seq long, create_ms long, close_ms long, "
    "close_reason string"
)


def sized_logs(logs: DataFrame) -> DataFrame:
    """The narrow rows that decide the packing of single logs."""
    sized = logs.selectExpr(*ROW, f"{log_size()} AS size_bytes", f"{log_wire_size()} AS _wire")
    return sized.selectExpr(
        *ROW, "size_bytes", f"{field_size('_wire')} AS logs_wire_bytes", "1L AS n_logs"
    )


def sized_lists(lists: DataFrame) -> DataFrame:
    """The narrow rows that decide the packing of log lists; empty lists pack nothing."""
    return lists.filter(F.size("logs") > 0).selectExpr(
        *ROW,
        f"{list_size()} AS size_bytes",
        f"{logs_wire_size()} AS logs_wire_bytes",
        "cast(size(logs) AS bigint) AS n_logs",
    )


def _repeats(table: pa.Table, names: list[str]) -> np.ndarray:
    """Whether each row but the first equals the one before it in all of the columns."""
    same = np.ones(table.num_rows - 1, dtype=bool)
    for name in names:
        column = table[name].combine_chunks()
        same &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return same


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, bool]]:
    """The rows of a partition in tables of about ``rows``, and whether it is the last."""
    waiting: pa.Table | None = None
    gathered: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gathered.append(batch)
        if sum(b.num_rows for b in gathered) >= rows:
            if waiting is not None:
                yield waiting, False
            waiting, gathered = pa.Table.from_batches(gathered), []
    if gathered:
        if waiting is not None:
            yield waiting, False
        waiting = pa.Table.from_batches(gathered)
    if waiting is not None:
        yield waiting, True


def _key(table: pa.Table, at: int, names: list[str] = SEQUENCE) -> tuple:
    return tuple(table[name][at].as_py() for name in names)


def _packable(table: pa.Table, metadata: int) -> greedy.Rows:
    if any(table[name].null_count for name in ROW):
        raise ValueError(f"{ROW} must not be null")
    if _repeats(table, ROW).any():
        raise ValueError(f"rows are not unique in {ROW}")
    changed = np.concatenate([[True], ~_repeats(table, SEQUENCE)])
    names = ["arrival_ms", "size_bytes", "logs_wire_bytes", "n_logs"]
    arrival, size, wire, n_logs = (table[name].to_numpy() for name in names)
    return greedy.Rows(arrival, size, wire + metadata, n_logs, changed)


def _summarise(limits: PackOptions, metadata: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[greedy.Slice] = []
        number = None
        for table, _ in _slices(batches, limits.slice_rows):
            number = table["row_id"][0].as_py() >> PART_BITS
            rows = _packable(table, metadata)
            last = _key(table, table.num_rows - 1)
            parts.append(greedy.summarise(rows, _key(table, 0), last, limits))
            if len(parts) == FANOUT:
                parts = [greedy.merge(parts, limits)]
        if parts:
            record = _as_record(number, greedy.merge(parts, limits))
            yield pa.RecordBatch.from_pylist([record], _SUMMARY_ARROW)

    return run


_LONGS = pa.list_(pa.int64())
_SUMMARY_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("first_key", pa.list_(pa.string())),
        ("last_key", pa.list_(pa.string())),
        ("one_run", pa.bool_()),
        ("run_rows", pa.int64()),
        ("run_bytes", pa.int64()),
        ("run_logs", pa.int64()),
        ("head_ms", _LONGS),
        ("head_bytes", _LONGS),
        ("head_logs", _LONGS),
        ("last_ms", pa.int64()),
        ("is_open", pa.list_(pa.bool_())),
        ("size", _LONGS),
        ("logs", _LONGS),
        ("create_ms", _LONGS),
        ("opened", _LONGS),
    ]
)
_HEAD = ("run_rows", "run_bytes", "run_logs", "head_ms", "head_bytes", "head_logs")
_EXIT = ("is_open", "size", "logs", "create_ms", "opened")


def _as_record(number: int, part: greedy.Slice) -> dict:
    return {
        "part": number,
        "first_key": list(part.first_key),
        "last_key": list(part.exits.key),
        "one_run": part.one_run,
        **{name: getattr(part, name) for name in _HEAD},
        "last_ms": int(part.exits.last_ms),
        **{name: getattr(part.exits, name) for name in _EXIT},
    }


def _as_slices(records: pd.DataFrame) -> tuple[list[int], list[greedy.Slice]]:
    numbers, slices = [], []
    for record in records.sort_values("part").to_dict("records"):
        numbers.append(int(record["part"]))
        exits = greedy.Open(
            tuple(record["last_key"]),
            int(record["last_ms"]),
            *(np.asarray(record[name]) for name in _EXIT),
        )
        slices.append(
            greedy.Slice(
                tuple(record["first_key"]),
                bool(record["one_run"]),
                *(int(record[name]) for name in _HEAD[:3]),
                *(np.asarray(record[name]) for name in _HEAD[3:]),
                exits,
            )
        )
    return numbers, slices


def _borders(summaries: DataFrame, parts: int, limits: PackOptions) -> DataFrame:
    """One row (part, border) per slice, by merging summaries up a tree and back down."""

    def merge_block(key: tuple, records: pd.DataFrame) -> pd.DataFrame:
        _, slices = _as_slices(records)
        merged = greedy.merge(slices, limits)
        return pd.DataFrame([_as_record(int(key[0]), merged)])

    def resolve_top(records: pd.DataFrame) -> pd.DataFrame:
        numbers, slices = _as_slices(records)
        borders = greedy.resolve(slices, greedy.Border(), limits)
        return pd.DataFrame({"part": numbers, "border": [b.dumps() for b in borders]})

    def resolve_block(records: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        numbers, slices = _as_slices(records)
        borders = greedy.resolve(slices, greedy.Border.loads(outer["border"].iloc[0]), limits)
        return pd.DataFrame({"part": numbers, "border": [b.dumps() for b in borders]})

    block = F.expr(f"part div {FANOUT}").cast("int").alias("block")
    levels = [summaries]
    while parts > FANOUT:
        if len(levels) == 1:
            levels[0] = levels[0].checkpoint()
        levels.append(levels[-1].groupBy(block).applyInPandas(merge_block, _SUMMARY))
        parts = -(-parts // FANOUT)
    schema = "part int, border string"
    borders = levels[-1].groupBy().applyInPandas(resolve_top, schema)
    for level in reversed(levels[:-1]):
        outer = borders.groupBy(F.col("part").alias("block"))
        borders = level.groupBy(block).cogroup(outer).applyInPandas(resolve_block, schema)
    return borders


def _label(limits: PackOptions, metadata: int):
    names = pa.array(greedy.REASONS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border: greedy.Border | None = None
        held = before = None
        for table, last in _slices(batches, limits.slice_rows):
            if border is None:
                border = greedy.Border.loads(table["border"][0].as_py())
            if before == _key(table, 0, ROW):
                raise ValueError(f"rows are not unique in {ROW}")
            before = _key(table, table.num_rows - 1, ROW)
            if held is not None:
                table = pa.concat_tables([held, table])
            known = border if last else replace(border, tail_reason=greedy.UNKNOWN)
            number, create, close, reason = greedy.label(
                _packable(table, metadata), _key(table, 0), known, limits
            )
            # What is still open waits for the next rows; it is no more than a package.
            done = int(np.count_nonzero(reason != greedy.UNKNOWN))
            labelled = table.select(ROW + SIZES).slice(0, done)
            for name, values in zip(_NUMBERS, (number, create, close)):
                labelled = labelled.append_column(name, pa.array(values[:done], pa.int64()))
            labelled = labelled.append_column("close_reason", names.take(pa.array(reason[:done])))
            yield from labelled.to_batches(max_chunksize=64 * 1024)
            held = table.slice(done) if done < table.num_rows else None
            if done:
                opened = int(number[-1]) - (held is not None)
                key = _key(table, table.num_rows - 1)
                border = replace(border, key=key, is_open=False, opened=opened)

    return run


def assign_packages(sized: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """Packing of the narrow rows of ``sized_logs`` or ``sized_lists``.

    (producer, topic_id, arrival_ms, seq) must be unique. The source is read once; then
    there is one range shuffle of narrow rows and two passes over them without another.
    """
    metadata = opening_metadata_size(opts.source, opts.hostname)
    table, parts = read_once(sized, opts.partitions)
    ordered = range_ordered(table, SEQUENCE, ARRIVAL, parts)
    summaries = ordered.drop("part").mapInArrow(_summarise(opts, metadata), _SUMMARY)
    borders = _borders(summaries, parts, opts).withColumnRenamed("part", "_part")
    # One short text per partition; only the first row of each needs it.
    told = ordered.join(F.broadcast(borders), F.col("part") == F.col("_part"), "left")
    first_row = F.col("row_id") == F.shiftleft(F.col("part").cast("long"), PART_BITS)
    told = told.select(*ROW, *SIZES, "row_id", F.when(first_row, F.col("border")).alias("border"))
    labelled = told.mapInArrow(_label(opts, metadata), _LABELS)
    return labelled.withColumn("package_id", _id(opts))


def _id(opts: PackOptions) -> Column:
    counter = number_in_id(F.col("package_seq"))
    return package_id(F.col("producer"), F.col("topic_id"), counter, run_number(opts.run_secs))


def attach(wide: DataFrame, labels: DataFrame) -> DataFrame:
    """Put the labels of narrow rows on the rows they were made from."""
    renamed = labels.select(
        *[F.col(name).alias(f"_{name}") for name in ROW],
        *[name for name in labels.columns if name not in ROW],
    )
    # The number of the row first: it alone tells most rows apart.
    matches = [F.col(name) == F.col(f"_{name}") for name in reversed(ROW)]
    return wide.join(renamed, matches).drop(*[f"_{name}" for name in ROW])


def pack_logs(logs: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """Logs with the package each goes into, packed per (producer, topic) in arrival order."""
    return attach(logs, assign_packages(sized_logs(logs), opts))


def pack_log_lists(lists: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """The same where one arrival is a list of logs (``logs``) that is never split.

    The count limit is tested as if a list were one log. Returns one row per log with
    its ``position`` in the list.
    """
    packed = attach(lists, assign_packages(sized_lists(lists), opts).drop(*SIZES))
    others = [name for name in packed.columns if name != "logs"]
    exploded = packed.select(*others, F.posexplode("logs").alias("position", "_log"))
    exploded = exploded.select(*others, F.col("position").cast("long").alias("position"), "_log.*")
    sized = exploded.selectExpr("*", f"{log_size()} AS size_bytes", f"{log_wire_size()} AS _wire")
    return sized.selectExpr("*", f"{field_size('_wire')} AS logs_wire_bytes", "1L AS n_logs").drop(
        "_wire"
    )


def split_segments(
    logs: DataFrame, linger_ms: int, partitions: int | None = None
) -> DataFrame:
    """Number the stretches of each (producer, topic) without a gap of ``linger_ms``.

    No package crosses such a gap. Returns the key columns and ``segment``, from 0.
    """
    table, parts = read_once(logs.select(*ROW), partitions)
    ordered = range_ordered(table, SEQUENCE, ARRIVAL, parts)
    gaps = previous_value(ordered, SEQUENCE, ARRIVAL, "arrival_ms", "previous_ms")
    cut = F.when(F.col("arrival_ms") - F.col("previous_ms") >= linger_ms, 1).otherwise(0)
    cuts = gaps.withColumn("_cut", cut.cast("long"))
    numbered = running_sums(cuts, SEQUENCE, ARRIVAL, {"segment": F.col("_cut")})
    return numbered.select(*ROW, "previous_ms", "segment")


def assign_grid(sized: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """Packages as cells of a fixed grid over arrival time, running bytes and rank.

    The limits of ``assign_packages`` hold (bytes by up to one log more) without following
    any sequence; the cut points differ and there are more packages.
    """
    linger = F.lit(opts.linger_ms).cast("long")
    bucketed = sized.withColumn("bucket", F.call_function("div", "arrival_ms", linger))
    table, parts = read_once(bucketed, opts.partitions)
    keys = [*SEQUENCE, "bucket"]
    ordered = range_ordered(table, keys, ARRIVAL, parts)
    running = running_sums(
        ordered, keys, ARRIVAL, {"_bytes": F.col("size_bytes"), "_rank": F.col("n_logs")}
    )
    cells = running.selectExpr(
        *ROW,
        *SIZES,
        "bucket",
        f"(_bytes - size_bytes) div {opts.max_bytes}L AS by_bytes",
        f"(_rank - n_logs) div {opts.max_logs}L AS by_count",
    )
    cell = name_in_id(*[F.col(n) for n in CELL])
    identity = package_id(F.col("producer"), F.col("topic_id"), cell, run_number(opts.run_secs))
    return cells.withColumn("package_id", identity)


def pack_logs_grid(logs: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """Logs with the cell of ``assign_grid`` each goes into."""
    return attach(logs, assign_grid(sized_logs(logs), opts))


def package_summary(packed: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """One row per package of ``pack_logs``, ``pack_log_lists`` or ``assign_packages``."""
    metadata = opening_metadata_size(opts.source, opts.hostname)
    # The three last keys are fixed within a package; as keys they keep the aggregation hashed.
    keys = ["package_id", *SEQUENCE, "package_seq", "create_ms", "close_ms", "close_reason"]
    return packed.groupBy(*keys).agg(
        F.sum("n_logs").alias("n_logs"),
        F.sum("size_bytes").alias("size_bytes"),
        (F.sum("logs_wire_bytes") + metadata).alias("wire_bytes"),
    )
