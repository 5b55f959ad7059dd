"""What several operators share: the input columns, fold numbers, ordered parts, ids of texts."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import itertools
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logfreight.session import prepare


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table of a folder."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` but those that an operator adds itself; it replaces them."""
    added = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in added]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` has not: longer than any of its names."""
    return name + "_" * max(map(len, df.columns), default=0)


def as_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, which holds all columns, so that inner names clash with none."""
    return docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def fold(column: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; null for a null id."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(folds)


def held_out(column: Column, folds: int, which: int) -> Column:
    """Whether a row belongs to the fold that nothing is learned from; null ids do."""
    return F.coalesce(fold(column, folds) == F.lit(which), F.lit(True))


def partitions_of(spark: SparkSession, partitions: int | None = None) -> int:
    return partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounds_of(df: DataFrame, column: str, parts: int) -> np.ndarray:
    """Bounds of ``parts`` ranges of about equal size: quantiles of an integer column alone.

    They are approximate and may differ from call to call: take them once for all uses.
    """
    shares = [i / parts for i in range(1, parts)] or [0.5]
    accuracy = max(10_000, 20 * parts)
    found = df.agg(F.percentile_approx(F.col(column), F.lit(shares), F.lit(accuracy)).alias("b"))
    return np.unique(np.array(found.first()[0] or [], dtype=np.int64))[: parts - 1]


def in_parts(df: DataFrame, column: str, bounds: np.ndarray, name: str = "part") -> DataFrame:
    """Add the number of the range that an integer column falls into; nulls go to range 0."""

    @F.pandas_udf("int")
    def part(values: pd.Series) -> pd.Series:
        known = values.notna().to_numpy()
        out = np.zeros(len(values), dtype=np.int32)
        out[known] = np.searchsorted(bounds, values[known].to_numpy(np.int64), side="left")
        return pd.Series(out)

    return df.withColumn(name, part(F.col(column)))


_HELD: list = []


def for_worker(key: object, make: Callable[[], object]) -> object:
    """What an operator keeps between tasks of a Python worker, made when first asked for.

    Workers live through all stages of a job, so one holds the lookups of one operator only:
    another key drops them and gives freed memory back to the machine.
    """
    if not _HELD or _HELD[0] != key:
        _HELD.clear()
        gc.collect()
        give_back()
        _HELD[:] = [key, make()]
    return _HELD[1]


def give_back() -> None:
    """Give memory that this worker has freed back to the machine; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def flat(found: list[list[int]] | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of lists, one after the other, and how many each list has; given so, as they are."""
    if isinstance(found, tuple):
        return found
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter(itertools.chain.from_iterable(found), "<u4", int(sizes.sum())), sizes


class PieceIds:
    """Ids of pieces of text, kept from batch to batch.

    Arrow cuts a batch of texts into pieces and numbers the distinct ones; Python sees only
    those, and encodes only those not kept. Ids of pieces lie in one pool, from which the ids of
    the whole batch are taken at once. Many pieces are met once only, so one is kept when it is
    met in a second batch (by a table of hashes; a collision keeps one early). When about
    ``limit`` bytes are kept, all are dropped before the next batch.
    """

    MET = 1 << 22

    def __init__(self, encode_many: Callable[[list[str]], list | tuple], limit: int = 96_000_000):
        self.encode_many, self.limit = encode_many, limit
        self._drop()

    def _drop(self) -> None:
        self.slots: dict[str, int] = {}
        self.met = np.zeros(self.MET, dtype=bool)
        self.pool, self.used = np.empty(1 << 16, dtype="<u4"), 0
        # Where the ids of each slot begin; one more than there are slots.
        self.begins, self.many, self.weight = np.zeros(1 << 14, dtype=np.int64), 0, 0

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The slots of new ids."""
        first, held = self.many, len(ids)
        while self.used + held > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while first + len(sizes) + 1 > len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.pool[self.used : self.used + held] = ids
        self.begins[first + 1 : first + 1 + len(sizes)] = self.used + np.cumsum(sizes)
        self.many, self.used = first + len(sizes), self.used + held
        return np.arange(first, self.many)

    def of(self, split: pa.ListArray, whole: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch and how many each text has.

        ``split`` has the pieces of every text; texts in ``whole``, which have one piece there,
        have the given ids in its place.
        """
        if self.weight > self.limit:
            self._drop()
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist
        slot_of = np.fromiter(map(self.slots.get, names, itertools.repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(slot_of < 0)
        places = np.fromiter(map(hash, map(names.__getitem__, new.tolist())), np.int64, len(new)) % self.MET
        again = self.met[places]
        self.met[places] = True
        new = np.concatenate([new[again], new[~again]])  # those to keep come first in the pool
        fresh = [names[i] for i in new.tolist()]
        ids, sizes = flat(self.encode_many(fresh))
        kept = int(again.sum())
        held = int(sizes[:kept].sum())
        slot_of[new[:kept]] = self._add(ids[:held], sizes[:kept])
        self.slots.update(zip(fresh[:kept], slot_of[new[:kept]].tolist()))
        self.weight += 170 * kept + 4 * sum(map(len, fresh[:kept])) + 4 * held
        mark = self.many, self.used
        slot_of[new[kept:]] = self._add(ids[held:], sizes[kept:])
        slots = slot_of[coded.indices.to_numpy()]
        ends = np.cumsum(split.value_lengths().to_numpy())
        if whole:
            slots[ends[list(whole)] - 1] = self._add(*flat(list(whole.values())))
        many = (self.begins[1:] - self.begins[:-1])[slots]
        so_far = np.cumsum(many)
        at = np.repeat(self.begins[slots] - so_far + many, many)
        at += np.arange(len(at))
        out = self.pool[at], np.diff(np.concatenate([[0], so_far])[np.concatenate([[0], ends])])
        self.many, self.used = mark  # the others were for this batch
        return out


# An ASCII letter and the ASCII punctuation behind it: no match of a pre-tokenizer goes across.
LETTER_END = r"([A-Za-z])([!-/:-@\[-`{-~])"


def library_tokenizer(path: str):
    """The tokenizer of a file, single-threaded: Spark's tasks fill the cores."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def batches_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def batches_of_bytes(
    batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20, rows: int = 2000
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows and ``most`` bytes of text (or of one row)."""
    for batch in batches_of(batches, rows):
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < batch.num_rows:
            before = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def with_end(ids: np.ndarray, many: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts, one after the other, with the end id after each."""
    places = np.cumsum(many + 1) - 1
    out = np.full(len(ids) + len(many), end_id, dtype="<u4")
    others = np.ones(len(out), dtype=bool)
    others[places] = False
    out[others] = ids
    return out, many + 1


def id_lists(ids: np.ndarray, many: np.ndarray) -> pa.ListArray:
    """A list column of 32-bit ids: ``many`` of them in each row."""
    offsets = np.concatenate([[0], np.cumsum(many)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view("<i4"), type=pa.int32()))
