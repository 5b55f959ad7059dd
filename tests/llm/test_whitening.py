"""Whitening against numpy on the whole table."""

import math

import numpy as np
import pytest

from logfreight.llm import vectors, whitening
from logfreight.llm.queries import QUERIES


def integers(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def brute(rows, dims, k=4):
    """n, deviation per id, whitened (up to sign) per id and share per component."""
    fine = [(i, x) for i, v in rows if (x := integers(v)) is not None and len(x) == dims]
    fit = sorted({tuple(x) for _, x in fine})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in fine]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, units = np.linalg.eigh(centred.T @ centred / n)
    values, units = values[::-1], units[:, ::-1]
    every = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in fine])
    many = min(k, dims)
    return n, deviation, every @ units[:, :many] / np.sqrt(values[:many]), values[:many] / values.sum()


def check(found, rows, dims):
    n, deviation, white, shares = brute(rows, dims)
    many = min(4, dims)
    assert len(found) == many * len(deviation)
    assert {r["n"] for r in found} == {n}
    for c in range(1, many + 1):
        mine = sorted((r for r in found if r["component"] == c), key=lambda r: (repr(r["vec_id"]), r["deviation"], abs(r["whitened"])))
        wanted = sorted(
            ((i, d, w) for (i, d), w in zip(deviation, white[:, c - 1])), key=lambda r: (repr(r[0]), r[1], abs(r[2]))
        )
        assert [(r["vec_id"], r["deviation"]) for r in mine] == [(i, d) for i, d, _ in wanted]
        a, b = np.array([r["whitened"] for r in mine]), np.array([w for *_, w in wanted])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6
        assert all(abs(r["explained"] / shares[c - 1] - 1) < 1e-6 for r in mine)
    errors = {r["identity_error"] for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-6


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], f"vec_id long, embedding array<{kind}>, place string, index string")


def query(spark, tmp_path, rows, kind="double"):
    table(spark, rows, kind).write.parquet(f"{tmp_path}/embeddings.parquet")
    return QUERIES["op12_whitening"](spark, str(tmp_path)).collect()


def test_query_on_given_vectors(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, folder).collect(), rows, 64)


def test_awkward_rows(spark, tmp_path):
    dice = np.random.default_rng(4)
    spread = np.array([9.0, 7.0, 4.0, 2.0, 1.0, 0.5])
    rows = [(i, (dice.normal(size=6) * spread + 5).tolist()) for i in range(200)]
    rows += [(i, [50.0, 0.0, 1.0, 1.0, 0.0, -3.0]) for i in range(200, 350)]  # a very common vector counts once
    rows += [(None, [1.0] * 6), (7, [1.0] * 6), (7, [1.0] * 6), (900, None), (901, [1.0, None] + [0.0] * 4)]
    rows += [(902, [float("nan")] * 6), (903, [float("-inf")] + [0.0] * 5), (904, [])]
    check(query(spark, tmp_path, rows), rows, 6)


def test_far_from_zero(spark, tmp_path):
    # Means of a million with a spread of one: rows have to be centred before multiplying.
    dice = np.random.default_rng(5)
    rows = [(i, (1e6 + dice.normal(size=5) * [3.0, 2.0, 1.0, 0.5, 0.2]).tolist()) for i in range(300)]
    check(query(spark, tmp_path, rows), rows, 5)


def test_several_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 5 * 16)
    dice = np.random.default_rng(6)
    rows = [(i, (dice.normal(size=5) * [9.0, 7.0, 4.0, 2.0, 1.0]).tolist()) for i in range(250)]
    check(query(spark, tmp_path, rows), rows, 5)


def test_lengths_apart_and_short_vectors(spark):
    dice = np.random.default_rng(7)
    long = [(i, (dice.normal(size=6) * [9, 7, 4, 2, 1, 0.5]).tolist()) for i in range(100)]
    short = [(i, (dice.normal(size=2) * [5, 1]).tolist()) for i in range(100, 180)]
    from pyspark.sql import functions as F

    rows = table(spark, long + short).select(F.col("vec_id").alias("id"), vectors.scaled(F.col("embedding"), 256.0).alias("components"))
    found = whitening.whitened(rows).withColumnRenamed("id", "vec_id").collect()
    check([r for r in found if r["vec_id"] < 100], long, 6)
    check([r for r in found if r["vec_id"] >= 100], short, 2)


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0, 3.0])], [(i, [float(i), 2.0 * i, 5.0]) for i in range(40)]])
def test_components_without_variance(spark, tmp_path, rows):
    found = query(spark, tmp_path, rows)
    assert len(found) == 3 * len(rows)
    assert all(math.isfinite(r["whitened"]) and r["identity_error"] < 1e-6 for r in found)
    assert all(r["whitened"] == 0.0 for r in found if r["component"] > 1)


def test_large_sums_stay_exact(spark, tmp_path):
    rows = [(i, [float(v), 1.0, 0.0]) for i, v in enumerate([1e13, -1e13, 2e12, 5.0, 1e9])]
    found = query(spark, tmp_path, rows)
    n, deviation, *_ = brute(rows, 3)
    fits = {i: d if d < 2**63 else None for i, d in deviation}
    assert {(r["vec_id"], r["deviation"]) for r in found} == set(fits.items())


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, [], "float") == []
