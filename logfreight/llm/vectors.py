"""Exact top-k by vector-approximation files.

Components are integers (here floor(64 x)). An approximation file holds, for each vector, the
number of the cell that each component falls into: one byte at most, of ``CELLS`` cells whose
borders are quantiles of a component. From a cell's borders follow bounds on a component, so a
scan of cells gives each vector a lower and an upper bound on its inner product with a query.
The kth best lower bound is certain to be reached; only vectors whose upper bound is not below
it are read exactly, in descending order of that bound, until the kth exact score is above the
next bound. Equal scores go to the smaller id, so a vector on the border is read too.

Vectors and queries are packed into blocks of ``ROWS``; every block of queries meets every
block of vectors in one task of a grid, which carries the running kth scores of its queries
along the blocks of its stripe. Stripes' best k are merged by Spark. A task holds one block of
queries and one block of vectors; nothing is broadcast.

Vectors that are null or hold null, NaN or infinite components take no part, as query or
candidate. Only vectors of the same length are compared; empty ones score 0 against each other. Scores are 64-bit integers; sums must
stay within them. Repeated ids are rows of their own, also as queries, and a query skips only
the rows with its own id. Rows with a null id take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logfreight.session import written_table

CELLS = 16
ROWS = 4096
STRIPE = 8
EXACT = float(1 << 53)


def scaled(embedding: Column, factor: float = 64.0) -> Column:
    """floor(factor * x) of every component, as long integers; null if one is not finite."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fine, F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("bigint")))


def blocks(vectors: DataFrame, rows: int = ROWS) -> DataFrame:
    """dims, block, ids and the vectors of a block as one binary value each.

    ``vectors`` has id and components (array<bigint>). Rows are dealt out by a hash of their
    place in the input, so blocks hold about ``rows`` each whatever ids or vectors repeat.
    Values take the bytes that the largest one needs.
    """
    vectors = vectors.withColumn("place", F.monotonically_increasing_id())
    counts = vectors.select(F.size("components").alias("dims")).groupBy("dims").count()
    sized = counts.select("dims", F.greatest(F.ceil(F.col("count") / rows), F.lit(1)).alias("blocks"))
    keyed = vectors.withColumn("dims", F.size("components")).join(sized, "dims")
    block = F.pmod(F.xxhash64("place"), F.col("blocks")).cast("int")
    keyed = keyed.select("dims", block.alias("block"), "id", "components")

    def pack(key: tuple, held: pa.Table) -> pa.Table:
        ids = held["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        flat = held["components"].combine_chunks()
        values = flat.flatten().to_numpy().reshape(len(ids), -1)[order]
        return pa.table(
            {
                "dims": pa.array([key[0].as_py()], type=pa.int32()),
                "block": pa.array([key[1].as_py()], type=pa.int32()),
                "ids": pa.array([ids[order].tobytes()], type=pa.binary()),
                "exact": pa.array([_narrow(values).tobytes()], type=pa.binary()),
            }
        )

    grouped = keyed.groupBy("dims", "block")
    return grouped.applyInArrow(pack, "dims int, block int, ids binary, exact binary")


def _narrow(values: np.ndarray) -> np.ndarray:
    for kind in ("<i1", "<i2", "<i4"):
        if values.size and np.iinfo(kind).min <= values.min() and values.max() <= np.iinfo(kind).max:
            return values.astype(kind)
    return values.astype("<i8")


def _wide(packed: bytes, rows: int, dims: int) -> np.ndarray:
    kind = f"<i{len(packed) // (rows * dims)}" if rows * dims else "<i8"
    return np.frombuffer(packed, kind).reshape(rows, dims).astype(np.int64)


def with_cells(packed: DataFrame, cells: int = CELLS) -> DataFrame:
    """Add the approximation of each block: borders per component and cells of one byte."""

    def approximate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            borders, approximations = [], []
            for dims, ids, exact in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                values = _wide(exact, len(ids) // 8, dims)
                cut = np.quantile(values, np.linspace(0, 1, cells + 1), axis=0, method="nearest") if dims else values
                cell = np.stack(
                    [np.searchsorted(cut[1:-1, d], values[:, d], side="right") for d in range(dims)], axis=1
                ) if dims else values
                # What a cell really holds gives the closest bounds.
                low = np.full((cells, dims), np.iinfo(np.int64).max)
                high = np.full((cells, dims), np.iinfo(np.int64).min)
                for d in range(dims):
                    np.minimum.at(low[:, d], cell[:, d], values[:, d])
                    np.maximum.at(high[:, d], cell[:, d], values[:, d])
                borders.append(np.stack([low, high]).astype("<i8").tobytes())
                approximations.append(cell.astype(np.uint8).tobytes())
            columns = [*batch.columns, pa.array(borders, type=pa.binary()), pa.array(approximations, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "borders", "cells"])

    return packed.mapInArrow(approximate, "dims int, block int, ids binary, exact binary, borders binary, cells binary")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows: in floating point while that is exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)))
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 1 << 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < EXACT:
        return a.astype(float) @ b.astype(float).T
    return a @ b.T


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds on inner products from the borders of cells."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    lower = _products(up, low) + _products(down, high)
    upper = _products(up, high) + _products(down, low)
    return lower, upper


def _search(queries, query_ids, block, best_scores, best_ids, k: int) -> None:
    """Take a block of vectors into the best k of each query, in place."""
    ids, exact, low, high = block
    lower, upper = _bounds(queries, low, high)
    own = query_ids[:, None] == ids[None, :]
    kept_k = min(k, len(ids))
    for q in range(len(queries)):
        others = ~own[q]
        # What is certain: the kth best of the scores known and the lower bounds found.
        certain = np.concatenate([best_scores[q], lower[q][others]])
        floor = np.partition(certain, -k)[-k] if len(certain) >= k else -np.inf
        reach = np.flatnonzero(others & (upper[q] >= floor))
        reach = reach[np.argsort(-upper[q][reach], kind="stable")]
        scores, names = best_scores[q], best_ids[q]
        at, step = 0, max(4 * kept_k, 64)
        while at < len(reach):
            if len(scores) >= k and upper[q][reach[at]] < scores[-1]:
                break
            now = reach[at : at + step]
            found = _products(queries[q : q + 1], exact[now])[0].astype(np.int64)
            scores, names = np.concatenate([scores, found]), np.concatenate([names, ids[now]])
            order = np.lexsort((names, -scores))[:k]
            scores, names = scores[order], names[order]
            at += step
        best_scores[q], best_ids[q] = scores, names


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 20, rows: int = ROWS, stripe: int = STRIPE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of each query.

    Both inputs have id (bigint) and components (array<bigint>).
    """
    clean = lambda df: df.filter("id IS NOT NULL AND components IS NOT NULL")
    asked = written_table(blocks(clean(queries).select("id", "components"), rows))
    held = written_table(with_cells(blocks(clean(vectors).select("id", "components"), rows)))
    sides = asked.select("dims", F.col("block").alias("q_block"), F.col("ids").alias("q_ids"), F.col("exact").alias("q_exact"))
    # Each block of queries is sent to each stripe of vector blocks once, and a stripe's blocks
    # to each block of queries: a grid over blocks, keyed on (dims, q_block, stripe).
    stripes = held.select("dims", F.floor(F.col("block") / stripe).cast("int").alias("stripe")).distinct()
    keys = asked.select("dims", F.col("block").alias("q_block")).join(stripes, "dims")
    left = sides.join(keys, ["dims", "q_block"])
    right = held.withColumn("stripe", F.floor(F.col("block") / stripe).cast("int")).join(keys, ["dims", "stripe"])
    schema = "query_id bigint, q_row bigint, vec_id bigint, score bigint"

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dims, q_block = key[0].as_py(), key[1].as_py()
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], type=pa.int64()) for n in ("query_id", "q_row", "vec_id", "score")})
        query_ids = np.frombuffer(left["q_ids"][0].as_py(), "<i8")
        asked = _wide(left["q_exact"][0].as_py(), len(query_ids), dims)
        scores = [np.empty(0, np.int64) for _ in query_ids]
        names = [np.empty(0, np.int64) for _ in query_ids]
        place = np.arange(dims)
        for row in right.select(["ids", "exact", "borders", "cells"]).to_pylist():
            ids = np.frombuffer(row["ids"], "<i8")
            cell = np.frombuffer(row["cells"], np.uint8).reshape(len(ids), dims)
            low, high = np.frombuffer(row["borders"], "<i8").reshape(2, CELLS if dims else len(ids), dims)
            exact = _wide(row["exact"], len(ids), dims)
            _search(asked, query_ids, (ids, exact, low[cell, place], high[cell, place]), scores, names, k)
        many = [len(s) for s in scores]
        rows = (q_block << 32) + np.repeat(np.arange(len(query_ids), dtype=np.int64), many)
        return pa.table(
            {
                "query_id": np.repeat(query_ids, many), "q_row": rows,
                "vec_id": np.concatenate(names), "score": np.concatenate(scores),
            }
        )

    grid = ["dims", "q_block", "stripe"]
    found = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(search, schema)
    order = Window.partitionBy("query_id", "q_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
