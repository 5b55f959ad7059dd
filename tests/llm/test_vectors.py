"""Exact top-k against all inner products."""

import math
import random

import pytest

from logfreight.llm import vectors
from logfreight.llm.queries import QUERIES


def brute(rows, k):
    def integers(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(64 * x) for x in v]

    fine = [(i, integers(v)) for i, v in rows if i is not None and integers(v) is not None]
    out = []
    for i, q in fine:
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def vector_rows():
    dice = random.Random(3)
    rows = [(i, [dice.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 420)]  # ties and a very common vector
    rows += [(500, None), (520, [1.0, None] + [0.0] * 6), (540, [float("nan")] * 8), (560, [float("inf")] * 8)]
    rows += [(600, [0.25] * 3), (601, [0.5] * 3), (602, []), (620, []), (None, [0.5] * 8), (40, [0.1] * 8)]
    rows += [(640, [1e5] * 8), (641, [-3e6] * 8), (-20, [0.3] * 8)]
    return rows


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k_equals_brute_force(spark, block):
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    from pyspark.sql import functions as F

    every = table.select(F.col("vec_id").alias("id"), vectors.scaled(F.col("embedding")).alias("components"))
    found = vectors.top_k(every.filter("id % 20 = 0"), every, 20, rows=block, stripe=2)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 20)


def test_query_on_given_vectors(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op7_vectors"](spark, folder).collect()) == brute(rows, 20)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op7_vectors"](spark, str(tmp_path)).count() == 0
