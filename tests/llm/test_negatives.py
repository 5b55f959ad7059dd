"""Hard negatives against all scores, and the cover tree on its own."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logfreight.llm import negatives, vectors
from logfreight.llm.cover_tree import CoverTree, Window
from logfreight.llm.queries import QUERIES


def brute(rows, scale=256):
    fine = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fine.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(scale * x) for x in v]))
    out = []
    for i, label, a in fine:
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), j, other) for j, other, v in fine if j != i and len(v) == len(a))
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            fit = [(-s, j) for s, j, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p]
            out += [(i, positive, n + 1, j, -p, s) for n, (s, j) in enumerate(fit[:10])]
    return sorted(out)


def awkward():
    dice = random.Random(8)
    rows = [(i, dice.randrange(4), [dice.gauss(0.1, 0.2) for _ in range(6)]) for i in range(400)]
    middles = [[dice.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    for i in range(400, 900):  # clusters, so that trees have levels, of which one label has most
        middle = dice.choice(middles)
        rows.append((i, 9 if dice.random() < 0.7 else dice.randrange(10), [x + dice.gauss(0, 0.02) for x in middle]))
    rows += [(i, i % 3, [0.25] * 6) for i in range(900, 1100)]  # ties and a very common vector
    rows += [(1200, 1, [0.0] * 6), (1300, 2, None), (1400, None, [0.5] * 6), (1500, 1, [0.1, None] + [0.0] * 4)]
    rows += [(1600, 3, [float("nan")] * 6), (1700, 3, [float("inf")] * 6), (None, 1, [0.5] * 6), (2000, 77, [0.4] * 6)]
    rows += [(100, 1, [0.3] * 6), (100, 1, [0.3] * 6), (-100, 2, [0.2] * 6), (2100, 2, []), (2101, 2, []), (2102, 3, [])]
    rows += [(3000, 1, [0.2, 0.3]), (3001, 2, [0.2, 0.29]), (3002, 1, [0.21, 0.3])]
    return rows


@pytest.mark.parametrize(("size", "stripe", "anchors"), [(2048, 8, 1024), (16, 2, 3)])
def test_equals_brute_force(spark, size, stripe, anchors):
    rows = awkward()
    table = spark.createDataFrame([(i, n, v, 1) for i, n, v in rows], "vec_id long, label int, embedding array<double>, row int")
    every = table.select(
        F.col("vec_id").alias("id"), vectors.scaled(F.col("embedding"), 256.0).alias("components"), "row",
        F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label"),
    )
    found = negatives.hard_negatives(every, "id % 100 = 0", size=size, stripe=stripe, anchors=anchors)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_query_on_given_vectors(spark, folder):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, folder).collect()) == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert QUERIES["op13_hard_negatives"](spark, str(tmp_path)).count() == 0


def clustered(n, dims, seed):
    dice = np.random.default_rng(seed)
    middles = dice.normal(size=(12, dims)) * 200
    return np.round(middles[dice.integers(0, 12, n)] + dice.normal(size=(n, dims)) * 6).astype(np.int64)


@pytest.mark.parametrize("low, high", [(-math.inf, math.inf), (1000, 90_000), (5, 4), (-90_000, -1000)])
def test_tree_equals_scan_and_skips(low, high):
    points = clustered(1500, 8, 1)
    ids = np.random.default_rng(2).permutation(1500)
    tree = CoverTree(ids, points)
    looked = 0
    for q in clustered(40, 8, 3):
        window = Window(low, high, 10)
        looked += tree.search(q, 17, [window])
        scores = points @ q
        fit = [(-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if low <= s <= high and i != 17]
        assert list(zip((-window.scores).tolist(), window.ids.tolist())) == sorted(fit)[:10]
    assert looked < 0.5 * 40 * 1500  # most points of clustered data are never compared


def test_tree_covers_and_separates():
    points = clustered(600, 5, 4)
    tree = CoverTree(np.arange(600), points)
    norms = (points**2).sum(axis=1)
    last = np.sqrt(np.maximum(norms.max() - norms, 0.0))
    grown = np.concatenate([points, last[:, None]], axis=1)
    place = {int(i): n for n, i in enumerate(tree.ids)}
    assert sorted(place) == list(range(600))

    def below(node):
        if not tree.children[node]:
            return list(range(tree.low[node], tree.high[node]))
        first = tree.child[node]
        return [p for c in range(first, first + tree.children[node]) for p in below(c)]

    assert sorted(below(0)) == list(range(600))
    grown = grown[tree.ids]
    for node in range(len(tree.centre)):
        far = np.linalg.norm(grown[below(node)] - grown[tree.centre[node]], axis=1)
        assert far.max() <= tree.radius[node] * (1 + 1e-6) + 1e-6
        first, many = tree.child[node], tree.children[node]
        middles = grown[tree.centre[first : first + many]] if many else grown[:0]
        for a in range(many):
            assert tree.radius[first + a] <= tree.radius[node] / 2 * (1 + 1e-6)
            for b in range(a):
                assert np.linalg.norm(middles[a] - middles[b]) > tree.radius[node] / 2 * (1 - 1e-6)


def test_packed_tree_is_the_same():
    points = clustered(100, 4, 5)
    tree = CoverTree(np.arange(100), points)
    again = CoverTree.unpacked(tree.packed(), 4)
    assert (again.points == tree.points).all() and (again.centre == tree.centre).all() and again.reach == tree.reach
