"""Whitening of embeddings with distributed block matrices.

Rows are integer vectors x. The fit list is each distinct x once; its centred rows x - S/n get
consecutive numbers and become a BlockMatrix A of ``BLOCK_BYTES`` blocks. A'A, multiplied block
by block, is the scatter matrix; its d x d values are decomposed on the driver. The whitening
matrix W has the leading unit eigenvectors, each over the root of its eigenvalue, as columns, and
a second block multiplication projects all rows. What A W gives on the fit list is multiplied
with itself to see how far its covariance is from the identity.

The product over the long dimension is split over as many tasks as there are blocks, and only
the partial d x d products are added up. The driver holds one number per partition, per block
and d x d values; nothing grows with a group of equal vectors, which are counted before the
shuffle in the fit list and are rows of their own in the projection.

Sums are exact (decimals), n x - S and its squares are exact integers, and rows are centred
before multiplying. A deviation that does not fit a long is null.

Vectors that are null or hold null, NaN or infinite components take no part; null and repeated
ids do. Vectors of different lengths are separate matrices. Empty vectors have no component and
give no row. There are at most as many components as a vector is long. A component without
variance (in the rounding of the largest) whitens to 0 and explains what its eigenvalue says;
the identity that covariances are compared with has a 0 for it.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.texts import batches_of
from logfreight.session import written_table

COMPONENTS = 4
BLOCK_BYTES = 4 << 20
MOST_BLOCK_BYTES = 64 << 20
# Blocks that a long dimension is cut into before blocks get larger.
BLOCKS = 20_000
ROWS = 4096


@dataclasses.dataclass
class Whitening:
    """What is known of the fit list: n, sums, eigenvalues and their share, the matrix (d x k)."""

    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    explained: np.ndarray
    matrix: np.ndarray
    identity_error: float


def _numbered(rows: DataFrame) -> DataFrame:
    """Add ``index``, consecutive from 0, by the place of rows in a written table.

    Parts of the table are counted (one row each) and numbered; nothing is sorted or shuffled.
    """
    placed = written_table(rows.withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    offsets, total = [], 0
    for row in sorted(counts):
        offsets.append((row["part"], total))
        total += row["n"]
    parts = rows.sparkSession.createDataFrame(offsets, "part bigint, offset bigint")
    index = F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.withColumn("part", part).join(F.broadcast(parts), "part")  # one row per part
    return joined.withColumn("index", index).drop("part", "offset", "place")


def _matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims)


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """n and the exact sum of every dimension: a row per dimension and task, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, many = np.zeros(dims, dtype=object), 0
        for batch in batches_of(batches, ROWS):
            values = _matrix_of(batch.column(0), dims)
            small = not values.size or np.abs(values.astype(float)).max() < 2.0**50
            sums = sums + (values if small else values.astype(object)).sum(axis=0)
            many += batch.num_rows
        exact = pa.array([str(int(v)) for v in [*sums, many]])
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), type=pa.int32()), exact], names=["d", "v"])

    sent = fit.select("components").mapInArrow(run, "d int, v string")
    found = sent.groupBy("d").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    table = {r["d"]: int(r["v"]) for r in found}
    return table.get(dims, 0), [table.get(d, 0) for d in range(dims)]


def _centred(rows: DataFrame, n: int, sums: list[int], dims: int) -> DataFrame:
    """index, vector (x - S/n) and deviation (the sum of (n x - S)^2) of numbered rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, ROWS):
            values = _matrix_of(batch.column(1), dims)
            reach = np.abs(values.astype(float)).max(initial=0) * n + max(map(abs, sums))
            wide = reach * reach * dims >= 2.0**62  # integers of any size where 64 bits do not do
            kind = object if wide else np.int64
            apart = values.astype(kind) * n - np.array(sums, dtype=kind)
            squares = [int(v) for v in (apart * apart).sum(axis=1)]
            vectors = (apart / n).astype(float)
            lists = pa.ListArray.from_arrays(np.arange(0, vectors.size + 1, dims, dtype=np.int32), vectors.ravel())
            fits = pa.array([v if v < 1 << 63 else None for v in squares], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, fits], names=["index", "vector", "deviation"])

    schema = "index bigint, vector array<double>, deviation bigint"
    return rows.select("index", "components").mapInArrow(run, schema)


def _rows_per_block(n: int, dims: int) -> int:
    """As many rows as make a block of ``BLOCK_BYTES``, more where there would be too many blocks."""
    per_row = 8 * dims
    return max(1, min(max(BLOCK_BYTES // per_row, -(-n // BLOCKS)), MOST_BLOCK_BYTES // per_row))


def _block_matrix(centred: DataFrame, n: int, dims: int) -> BlockMatrix:
    vectors = centred.select("index", array_to_vector("vector").alias("vector"))
    rows = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    return IndexedRowMatrix(rows, n, dims).toBlockMatrix(_rows_per_block(n, dims), dims)


def _product_with_itself(a: BlockMatrix) -> np.ndarray:
    """a' a: each pair of blocks in a task of its own, partial products added up."""
    splits = max(1, min(BLOCKS, -(-a.numRows() // a.rowsPerBlock)))
    across = a.transpose()
    model = across._java_matrix_wrapper.call("multiply", a._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(model, across.rowsPerBlock, a.colsPerBlock).toLocalMatrix().toArray()


def _times(a: BlockMatrix, matrix: np.ndarray) -> BlockMatrix:
    local = Matrices.dense(*matrix.shape, matrix.ravel(order="F").tolist())
    context = a.blocks.context
    return a.multiply(BlockMatrix(context.parallelize([((0, 0), local)], 1), *matrix.shape))


def fit_whitening(vectors: DataFrame, dims: int, k: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors (column components) of length ``dims``; None if there are none."""
    distinct = vectors.filter(F.size("components") == dims).groupBy("components").agg(F.lit(1).alias("one"))
    fit = _numbered(distinct.select("components"))
    n, sums = _sums(fit, dims)
    if not n or not dims:
        return None
    a = _block_matrix(_centred(fit, n, sums, dims), n, dims)
    covariance = _product_with_itself(a) / n
    values, units = np.linalg.eigh((covariance + covariance.T) / 2)
    values, units = np.maximum(values[::-1], 0.0)[:k], units[:, ::-1][:, :k]
    trace = float(np.trace(covariance))
    some = values > dims * np.finfo(float).eps * values[0]
    matrix = np.where(some, units / np.sqrt(np.where(some, values, 1.0)), 0.0)
    whitened = _product_with_itself(_times(a, matrix)) / n
    error = float(np.abs(whitened - np.diag(some.astype(float))).max())
    return Whitening(n, sums, values, values / trace if trace else np.zeros(len(values)), matrix, error)


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """id, deviation, whitened (array<double>) of the rows whose vectors have the model's length."""
    dims = len(model.sums)
    rows = _numbered(vectors.filter(F.size("components") == dims).select("id", "components"))
    centred = written_table(_centred(rows, model.n, model.sums, dims))
    many = centred.count()
    if not many:
        return rows.select("id", F.lit(None).cast("bigint").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    made = _times(_block_matrix(centred, many, dims), model.matrix).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", made._java_matrix_wrapper._java_model)
    found = found.select("index", vector_to_array("vector").alias("whitened"))
    return rows.select("index", "id").join(centred.select("index", "deviation"), "index").join(found, "index").drop("index")


def whitened(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: k rows for each vector.

    ``vectors`` has id and components (array<bigint>, null where a vector takes no part).
    """
    rows = written_table(vectors.filter("components IS NOT NULL").select("id", "components"))
    lengths = [r["d"] for r in rows.select(F.size("components").alias("d")).distinct().collect()]
    schema = "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    out = rows.sparkSession.createDataFrame([], schema)
    for dims in sorted(filter(None, lengths)):
        model = fit_whitening(rows, dims, k)
        found = project(rows, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        shares = F.array(*map(F.lit, map(float, model.explained)))
        out = out.unionByName(
            found.select(
                F.col("id").cast("bigint").alias("id"), (F.col("at") + 1).alias("component"),
                F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
            )
        )
    return out
