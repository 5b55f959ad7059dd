"""Running values over long sequences without one task per sequence.

A window over a whole sequence puts all its rows into one task, whatever its share of
the table. Here rows are range-partitioned on (keys, order), so a long sequence spans
many tasks; each piece is summed in one pass over its sorted rows, and pieces pass on their
totals through a table of at most one row per partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logfreight.session import checkpoint_dir, written_table

PART_BITS = 33
# Rows of a range: fewer ranges than there are shuffle partitions for few rows, more for many.
MIN_ROWS = 10_000
MAX_ROWS = 20_000_000


def partitions_of(df: DataFrame, partitions: int | None) -> int:
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranges_for(rows: int, usual: int) -> int:
    """Ranges for so many rows: the usual number, as long as they have a fair size."""
    return max(min(usual, rows // MIN_ROWS + 1), -(-rows // MAX_ROWS))


def read_once(df: DataFrame, partitions: int | None) -> tuple[DataFrame, int]:
    """Narrow rows computed from a wide source, written as a table, and their partitions.

    Range partitioning samples its input before it reads it; this way the wide source is
    read once. The table also tells how many rows there are (from its footers), so that few
    rows do not make many tasks.
    """
    table = written_table(df)
    if partitions is None:
        partitions = ranges_for(table.count(), partitions_of(df, None))
    return table, partitions_of(df, partitions)


def range_ordered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Rows sorted by (keys, order) across partitions, with ``part`` and ``row_id``.

    The bounds of the partitions come from a sample, so the result is checkpointed:
    every later pass must see the same cut. Pass narrow rows.
    """
    checkpoint_dir(df.sparkSession)
    columns = [*keys, *order]
    return (
        df.repartitionByRange(partitions_of(df, partitions), *columns)
        .sortWithinPartitions(*columns)
        .withColumn("row_id", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("row_id", PART_BITS).cast("int"))
        .checkpoint()
    )


def _carry(ordered: DataFrame, pieces: DataFrame, keys: Sequence[str], names: Sequence[str]):
    """Add per-piece values of ``pieces``, of which there are fewer than partitions."""
    side = pieces.select(
        F.col("part").alias("_part"),
        *[F.col(k).alias(f"_{k}") for k in keys],
        *names,
    )
    condition = F.col("part") == F.col("_part")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = ordered.join(F.broadcast(side), condition, "left")
    return joined.drop("_part", *[f"_{k}" for k in keys])


def _starts(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Whether each row but the first has other keys than the row before; nulls are equal."""
    fresh = np.zeros(batch.num_rows - 1, dtype=bool)
    for name in keys:
        column = batch.column(batch.schema.get_field_index(name))
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        fresh |= codes[1:] != codes[:-1]
    return fresh


def _along(ordered: DataFrame, keys: Sequence[str], made: Mapping[str, str], step) -> DataFrame:
    """Add long columns made along each sequence of a partition, in one pass over its rows.

    A window would shuffle and sort the rows again. ``step(values, starts, before)`` gives a
    column and what to hand on; ``before`` is None where a batch begins a new sequence.
    """
    names = [*ordered.columns, *made]
    fields = [T.StructField(name, T.LongType()) for name in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        before: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            places = [batch.schema.get_field_index(k) for k in keys]
            key = tuple(batch.column(i)[0].as_py() for i in places)
            if key != last:
                before = {}
            starts = np.concatenate([[True], _starts(batch, keys)])
            columns = list(batch.columns)
            for name, source in made.items():
                values = batch.column(batch.schema.get_field_index(source))
                column, before[name] = step(values, starts, before.get(name))
                columns.append(column)
            last = tuple(batch.column(i)[batch.num_rows - 1].as_py() for i in places)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return ordered.mapInArrow(run, T.StructType([*ordered.schema.fields, *fields]))


def _sums(values: pa.Array, starts: np.ndarray, before: int | None) -> tuple[pa.Array, int]:
    numbers = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
    totals = np.cumsum(numbers)
    begins = np.flatnonzero(starts)
    base = (totals - numbers)[begins][np.cumsum(starts) - 1]
    out = totals - base
    if before is not None:
        end = begins[1] if len(begins) > 1 else len(out)
        out[:end] += before
    return pa.array(out, type=pa.int64()), int(out[-1])


def _previous(values: pa.Array, starts: np.ndarray, before) -> tuple[pa.Array, object]:
    shifted = pa.concat_arrays([pa.array([before], type=values.type), values[:-1]])
    own = starts.copy()
    own[0] = own[0] and before is None
    return pc.if_else(pa.array(own), pa.scalar(None, values.type), shifted), values[-1].as_py()


def running_sums(
    ordered: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Add inclusive running sums (of longs) along each sequence of a ``range_ordered`` table."""
    valued = ordered.withColumns({f"_val_{name}": value.cast("long") for name, value in sums.items()})
    local = _along(valued, keys, {f"_run_{name}": f"_val_{name}" for name in sums}, _sums)
    totals = ordered.groupBy("part", *keys).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    # At most one sequence enters a partition from the one before, so this window sees
    # one row per partition and sequence and keeps fewer rows than there are partitions.
    across = Window.partitionBy(*keys).orderBy("part")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part",
        *keys,
        *[F.sum(name).over(earlier).alias(f"_off_{name}") for name in sums],
        F.row_number().over(across).alias("_piece"),
    ).filter("_piece > 1")
    joined = _carry(local, offsets, keys, [f"_off_{name}" for name in sums])
    for name in sums:
        offset = F.coalesce(F.col(f"_off_{name}"), F.lit(0))
        joined = joined.withColumn(name, F.col(f"_run_{name}") + offset)
    return joined.drop(*[f"_{kind}_{name}" for name in sums for kind in ("run", "off", "val")])


def previous_value(
    ordered: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, name: str
) -> DataFrame:
    """Add the value of ``column``, which must not fall along the order, on the row before."""
    across = Window.partitionBy(*keys).orderBy("part")
    pieces = ordered.groupBy("part", *keys).agg(F.max(column).alias("_last"))
    before = pieces.select("part", *keys, F.lag("_last").over(across).alias("_before"))
    before = before.filter(F.col("_before").isNotNull())
    local = _along(ordered, keys, {"_lag": column}, _previous)
    joined = _carry(local, before, keys, ["_before"])
    return joined.withColumn(name, F.coalesce("_lag", "_before")).drop("_lag", "_before")
