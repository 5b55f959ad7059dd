"""The array packer against the row-by-row fold, on cut and uncut sequences."""

import random

import numpy as np
import pytest

from logfreight.model import PackOptions
from logfreight.plans import greedy
from tests.folds import fold


def make_rows(rng, n, keys, lists, still=False):
    counts = [rng.randint(0, n) for _ in range(keys)]
    rows = []
    for key, count in enumerate(counts):
        clock = rng.randint(0, 1000)
        for _ in range(count):
            clock += 0 if still else rng.choice([0, 1, 5, 50, 100, 400])
            size = rng.randint(4, 60)
            n_logs = rng.randint(1, 6) if lists else 1
            rows.append((("p", str(key)), clock, size, size + rng.randint(10, 80), n_logs))
    return rows


def as_rows(rows):
    keys = [r[0] for r in rows]
    arrays = [np.array([r[i] for r in rows], dtype=np.int64) for i in range(1, 5)]
    new_key = np.array([True] + [a != b for a, b in zip(keys, keys[1:])])
    return greedy.Rows(*arrays, new_key)


def pack_cut(rows, cuts, fanout, limits):
    edges = sorted({0, len(rows), *cuts})
    pieces = [rows[a:b] for a, b in zip(edges, edges[1:])]
    leaves = [greedy.summarise(as_rows(p), p[0][0], p[-1][0], limits) for p in pieces]
    levels = [leaves]
    while len(levels[-1]) > fanout:
        level = levels[-1]
        blocks = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        levels.append([greedy.merge(block, limits) for block in blocks])
    borders = greedy.resolve(levels[-1], greedy.Border(), limits)
    for level in reversed(levels[:-1]):
        blocks = [level[i : i + fanout] for i in range(0, len(level), fanout)]
        borders = [
            child
            for block, border in zip(blocks, borders)
            for child in greedy.resolve(block, greedy.Border.loads(border.dumps()), limits)
        ]
    got = []
    for piece, border in zip(pieces, borders):
        number, create, close, reason = greedy.label(as_rows(piece), piece[0][0], border, limits)
        got += [
            (int(a), int(b), int(c), greedy.REASONS[d])
            for a, b, c, d in zip(number, create, close, reason)
        ]
    return got


@pytest.mark.parametrize("seed", range(400))
def test_cut_packing_equals_fold(seed):
    rng = random.Random(seed)
    rows = make_rows(rng, rng.choice([5, 40, 200]), rng.choice([1, 1, 2, 5]), seed % 2, seed % 7 == 0)
    if not rows:
        return
    limits = PackOptions(
        max_bytes=rng.choice([60, 120, 400, 3000]),
        cap_bytes=rng.choice([130, 420, 5000]),
        max_logs=rng.choice([1, 2, 7, 30]),
        linger_ms=rng.choice([100, 300, 2000, 100000]),
    )
    cuts = [rng.randint(0, len(rows)) for _ in range(rng.choice([0, 1, 5, 30, 100]))]
    expected = fold(rows, limits)
    assert pack_cut(rows, cuts, rng.choice([2, 3, 8, 1000]), limits) == expected


def test_every_reason_occurs():
    reasons = set()
    for seed in range(60):
        rng = random.Random(seed)
        rows = make_rows(rng, 60, 2, False)
        limits = PackOptions(max_bytes=300, cap_bytes=320, max_logs=8, linger_ms=600)
        reasons |= {r[3] for r in fold(rows, limits)}
    assert reasons == set(greedy.REASONS)


def test_summary_is_no_larger_than_a_package():
    n = 50_000
    flat = np.full(n, 10, dtype=np.int64)
    rows = greedy.Rows(np.zeros(n, dtype=np.int64), flat, flat + 60, flat * 0 + 1, np.arange(n) == 0)
    part = greedy.summarise(rows, ("p", "t"), ("p", "t"), PackOptions(max_bytes=1000, max_logs=500))
    assert len(part.head_ms) <= 102
    assert len(part.exits.opened) <= 103
