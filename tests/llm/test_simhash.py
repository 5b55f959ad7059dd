"""SimHash classes against all pairs of fingerprints."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from logfreight.llm import simhash
from logfreight.llm.queries import QUERIES
from tests.llm import corpus

ASCII = "".join(chr(b) for b in range(65, 91))


def plain_fingerprint(text, words=4):
    lowered = (text or "").translate(str.maketrans(ASCII, ASCII.lower()))
    for blank in "\x09\x0a\x0b\x0c\x0d":
        lowered = lowered.replace(blank, " ")
    split = [w for w in lowered.split(" ") if w]
    grams = [" ".join(split[i : i + words]) for i in range(max(len(split) - words + 1, 1))] if split else []
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(v >> bit & 1 for v in values) > len(values)) if values else 0


def classes(prints, ids, radius=4):
    """component_id per row by union of all pairs within the radius."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[root(i)] = root(j)
    least = {}
    for i, doc_id in enumerate(ids):
        known = [x for x in (least.get(root(i)), doc_id) if x is not None]
        least[root(i)] = min(known) if known else None
    return [least[root(i)] for i in range(len(prints))]


def expected(rows):
    prints = [plain_fingerprint(text) for _, text, _ in rows]
    named = classes(prints, [i for i, _, _ in rows])
    return sorted(((i, f"{p:016x}", c) for (i, _, _), p, c in zip(rows, prints, named)), key=repr)


def test_given_documents_equal_brute_force(spark, folder):
    found = sorted((tuple(r) for r in QUERIES["op11_simhash"](spark, folder).collect()), key=repr)
    assert found == expected(corpus.given(folder))


def test_awkward_documents_equal_brute_force(spark, tmp_path):
    rows = corpus.odd_documents()
    rows += [(100, "ONE Two\tthree  FOUR five", "en"), (101, "one two three\nfour five", "en"), (102, "É é", "fr"), (103, "é é", "fr")]
    place = corpus.written(spark, tmp_path, rows)
    found = sorted((tuple(r) for r in QUERIES["op11_simhash"](spark, place).collect()), key=repr)
    assert found == expected(rows)


def test_empty_table(spark, tmp_path):
    place = corpus.written(spark, tmp_path, [])
    assert QUERIES["op11_simhash"](spark, place).count() == 0


def dense_ball(n, seed):
    """Fingerprints of which a third lie in one ball, in chains at distances up to 6, and random ones."""
    dice = random.Random(seed)
    middle = dice.getrandbits(64)
    prints = {0, 1 << 63, (1 << 64) - 1, middle}
    while len(prints) < n:
        if dice.random() < 0.4:
            bits = dice.sample(range(64), dice.randint(1, 6))
            prints.add(middle ^ sum(1 << b for b in bits))
        else:
            prints.add(dice.choice(sorted(prints)[:50]) ^ dice.getrandbits(64) & dice.getrandbits(64) & dice.getrandbits(64))
    return sorted(prints)


@pytest.mark.parametrize(("depth", "leaf", "held"), [(18, 1 << 22, 1 << 21), (6, 3000, 5000), (10, 2000, 100)])
def test_links_connect_what_is_near(spark, monkeypatch, depth, leaf, held):
    # Small leaves and small steps: the tree and the walk below it are cut deep.
    prints = dense_ball(400, depth)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(p,) for p in signed], T.StructType([T.StructField("fp", T.LongType())]))
    monkeypatch.setattr(simhash, "VARIANTS", held)
    pairs = [(int(r["a"]) % (1 << 64), int(r["b"]) % (1 << 64)) for r in simhash.links(table, depth, leaf).collect()]
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in pairs)
    assert len(pairs) == len(set(pairs))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in pairs:
        parent[root(a)] = root(b)
    wanted = classes(prints, list(range(len(prints))))
    groups = {}
    for p, c in zip(prints, wanted):
        groups.setdefault(c, set()).add(root(p))
    assert all(len(roots) == 1 for roots in groups.values())
    assert len({next(iter(r)) for r in groups.values()}) == len(groups)


def test_every_variant_lies_in_one_leaf():
    prints = np.array(dense_ball(60, 1), dtype=np.uint64)
    counts = {}
    for p in prints.tolist():
        counts[p >> 56] = counts.get(p >> 56, 0) + 1
    tree = simhash.prefix_tree(counts, 8, 4000)
    assert (tree.child[:, 0] >= 0).sum() > 3
    levels = simhash._levels(tree.child)
    index, leaf, flips = tree.leaves_of(prints)
    many = sum(simhash.ball(64 - int(levels[node]), int(f)) for node, f in zip(leaf, flips))
    assert many == len(prints) * simhash.ball(64, 2)
    assert len(set(zip(index.tolist(), leaf.tolist()))) == len(index)


def test_walk_below_a_leaf_holds_few_variants(monkeypatch):
    monkeypatch.setattr(simhash, "VARIANTS", 200)
    prints = np.array(dense_ball(300, 2), dtype=np.uint64)
    found = {tuple(p) for part in simhash.met(prints, np.full(300, 2, np.int8), 0) for p in part.tolist()}
    monkeypatch.setattr(simhash, "VARIANTS", 1 << 22)
    whole = {tuple(p) for part in simhash.met(prints, np.full(300, 2, np.int8), 0) for p in part.tolist()}
    assert found == whole
