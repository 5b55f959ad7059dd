"""SimHash near copies by meet-in-the-middle ball hashing.

A fingerprint has 64 bits: bit i is 1 if it is set in over half of the XXH64 values (seed 42) of
a text's word shingles, repeats counted. Two fingerprints that differ in at most ``2 * HALF``
bits have a variant in common that differs from each in at most ``HALF`` bits. So every
distinct fingerprint emits all its variants within half the radius, variants are shuffled, and
fingerprints meet where they share one.

- Variants are shuffled by their leading bits, as deep as the counts ask for: a task owns all
  variants below one leaf of a prefix tree. A fingerprint is sent once to each leaf that holds
  a variant of it, with what it may still flip, and the variants themselves are written out on
  arrival; one leaf costs 9 bytes in place of 16 for each of thousands of variants.
- The tree is cut from the counts of fingerprints by their first ``DEPTH`` bits, so that leaves
  hold about equally many variants: a dense ball of near copies gets deep leaves of its own.
  A task walks further down from its leaf, so it holds ``VARIANTS`` variants at a time.
- Two fingerprints with a variant in common are at most ``2 * HALF`` apart by the triangle
  inequality, so of each variant only the links to the least fingerprint go on: a variant with n
  fingerprints gives n - 1 links, not n * n. They are deduplicated and verified, and connected
  components follow.

Exact copies share a fingerprint and are one row of all this. Nothing is capped or sampled.

Null texts count as empty; a text without words has fingerprint 0. Null doc_ids take part, also
as bridges; a component's id is the least doc_id that is not null, or null if it has none.
Repeated rows come out as often as they came in. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.components import components
from logfreight.llm.texts import batches_of, for_worker
from logfreight.session import written_table

WORDS = 4
BITS = 64
HALF = 2
SEED = 42
# Bits by which fingerprints are counted for the tree: at most 2^18 counts reach the driver.
DEPTH = 18
LEAVES = 1 << 15
TASKS = 1 << 13
# Variants of a leaf at least, and variants that a task holds at a time.
LEAF_VARIANTS = 1 << 22
VARIANTS = 1 << 21
HASHES = 1 << 16
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The SimHash of a text in UTF-8."""
    import xxhash

    split = (text or b"").translate(LOWER).split()  # splits at 0x20 and 0x09 to 0x0D
    if not split:
        return 0
    ends = np.cumsum([len(word) + 1 for word in split]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, hashed = b" ".join(split), xxhash.xxh64_intdigest
    many = max(len(split) - words + 1, 1)
    ends = ends[min(words, len(split)) - 1 :]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, many, HASHES):
        to = min(at + HASHES, many)
        spans = zip(starts[at:to].tolist(), ends[at:to].tolist())
        values = np.array([hashed(joined[a:b], SEED) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > many).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed 64-bit integer) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for_worker("simhash", lambda: None)
        for batch in batches_of(batches, 500):
            made = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string").cast("binary"))
    return narrow.mapInArrow(run, "doc_id bigint, fp bigint")


def ball(bits: int, flips: int) -> int:
    """How many variants there are within ``flips`` of ``bits`` bits."""
    return 1 + (bits if flips else 0) + (bits * (bits - 1) // 2 if flips > 1 else 0)


class PrefixTree:
    """Leaves of a binary tree over leading bits; ``child[node, bit]`` is a node, a leaf has none."""

    def __init__(self, child: list[tuple[int, int]]):
        self.child = np.array(child, dtype=np.int32).reshape(-1, 2)

    def leaves_of(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """index of the fingerprint, leaf, flips left: every leaf that holds a variant of it."""
        index = np.arange(len(prints))
        node = np.zeros(len(prints), dtype=np.int32)
        left = np.full(len(prints), HALF, dtype=np.int8)
        out = []
        for level in range(BITS):
            ended = self.child[node, 0] < 0
            out.append((index[ended], node[ended], left[ended]))
            index, node, left = index[~ended], node[~ended], left[~ended]
            if not len(index):
                break
            own = (prints[index] >> np.uint64(BITS - 1 - level)).astype(np.int64) & 1
            other = left > 0
            near, far = self.child[node, own], self.child[node, 1 - own]
            index = np.concatenate([index, index[other]])
            node = np.concatenate([near, far[other]])
            left = np.concatenate([left, left[other] - 1])
        return tuple(np.concatenate(parts) for parts in zip(*out))


def prefix_tree(counts: dict[int, int], depth: int = DEPTH, leaf: int = LEAF_VARIANTS) -> PrefixTree:
    """Cut where a leaf would hold more than ``leaf`` variants, from counts by leading bits.

    The cut gets coarser where more than about ``LEAVES`` leaves would be needed.
    """
    sizes = np.zeros(1 << depth)
    for prefix, n in counts.items():
        sizes[prefix] = n
    leaf = max(leaf, sizes.sum() * ball(BITS, HALF) / LEAVES)
    # near[d][j][p]: fingerprints at a distance of j from prefix p of d bits.
    levels, exact = [], sizes
    for d in range(depth, -1, -1):
        near = [exact]
        once = sum(_flipped(exact, bit, d) for bit in range(d)) if d else np.zeros(1)
        near.append(once)
        near.append(sum(_flipped(once, bit, d) for bit in range(d)) / 2 - d * exact / 2 if d else np.zeros(1))
        levels.append(sum(n * ball(BITS - d, HALF - j) for j, n in enumerate(near)))
        exact = exact.reshape(-1, 2).sum(axis=1) if d else exact
    levels.reverse()
    child: list[tuple[int, int]] = [(-1, -1)]
    open_nodes = [(0, 0, 0)]
    while open_nodes:
        node, d, prefix = open_nodes.pop()
        if d < depth and levels[d][prefix] > leaf:
            child[node] = len(child), len(child) + 1
            child += [(-1, -1), (-1, -1)]
            open_nodes += [(child[node][bit], d + 1, 2 * prefix + bit) for bit in (0, 1)]
    return PrefixTree(child)


def _flipped(values: np.ndarray, bit: int, d: int) -> np.ndarray:
    return values.reshape(-1, 2, 1 << bit)[:, ::-1, :].reshape(-1)


def met(prints: np.ndarray, left: np.ndarray, level: int) -> Iterator[np.ndarray]:
    """Links (least, other) of fingerprints that share a variant below a prefix of ``level`` bits.

    ``left`` holds how many of the bits from there on each may flip. Goes down bit by bit until
    the variants fit; so at most ``VARIANTS`` (or one variant of each) are held.
    """
    if len(prints) < 2:
        return
    free = BITS - level
    many = sum(int((left == j).sum()) * ball(free, j) for j in range(HALF + 1))
    if free and many > VARIANTS:
        bit = (prints >> np.uint64(free - 1)) & np.uint64(1)
        for side in (0, 1):
            stay = bit == side
            cross = ~stay & (left > 0)
            both = np.concatenate([left[stay], left[cross] - 1])
            yield from met(np.concatenate([prints[stay], prints[cross]]), both, level + 1)
        return
    keep = np.uint64((1 << free) - 1)  # the bits before are those of the prefix: equal for all
    one = np.uint64(1) << np.arange(free, dtype=np.uint64)
    a, b = np.triu_indices(free, 1)
    masks = [np.zeros(1, np.uint64), one, one[a] | one[b]]
    variants, owner = [], []
    for j in range(HALF + 1):
        mine = np.flatnonzero(left == j)
        for mask in masks[: j + 1]:
            variants.append(((prints[mine] & keep)[:, None] ^ mask[None, :]).ravel())
            owner.append(np.repeat(mine, len(mask)))
    variants, owner = np.concatenate(variants), np.concatenate(owner)
    order = np.argsort(variants, kind="stable")
    variants, owner = variants[order], prints[owner[order]]
    begins = np.flatnonzero(np.concatenate([[True], variants[1:] != variants[:-1]]))
    sizes = np.diff(np.append(begins, len(variants)))
    shared = sizes > 1
    if not shared.any():
        return
    least = np.minimum.reduceat(owner, begins)
    pairs = np.stack([np.repeat(least, sizes), owner], axis=1)[np.repeat(shared, sizes)]
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    yield np.unique(pairs, axis=0)


def links(prints: DataFrame, depth: int = DEPTH, leaf: int = LEAF_VARIANTS) -> DataFrame:
    """a, b: links that connect all distinct fingerprints (column fp) at most 2 * HALF apart."""
    context = prints.sparkSession.sparkContext
    prefix = F.shiftrightunsigned("fp", BITS - depth)
    counts = {r["p"]: r["n"] for r in prints.groupBy(prefix.alias("p")).agg(F.count("*").alias("n")).collect()}
    tree = context.broadcast(prefix_tree(counts, depth, leaf))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 20_000):
            values = batch.column(0).to_numpy().view(np.uint64)
            index, node, left = tree.value.leaves_of(values)
            columns = [pa.array(node), pa.array(values[index].view(np.int64)), pa.array(left)]
            yield pa.RecordBatch.from_arrays(columns, names=["leaf", "fp", "flips"])

    def meet(key: tuple, held: pa.Table) -> pa.Table:
        level = levels.value[key[0].as_py()]
        prints = held["fp"].to_numpy().view(np.uint64)
        found = list(met(prints, held["flips"].to_numpy(), int(level)))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.uint64)
        pairs = np.ascontiguousarray(pairs.T).view(np.int64)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    levels = context.broadcast(_levels(tree.value.child))
    # As many tasks as leaves: what they send is small, but what they write out is not.
    tasks = min(int((tree.value.child[:, 0] < 0).sum()), TASKS)
    sent = prints.select("fp").mapInArrow(send, "leaf int, fp bigint, flips byte").repartition(tasks, "leaf")
    found = sent.groupBy("leaf").applyInArrow(meet, "a bigint, b bigint").distinct()
    return found.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2 * HALF)


def _levels(child: np.ndarray) -> np.ndarray:
    """The depth of every node; children come after their parent."""
    out = np.zeros(len(child), dtype=np.int8)
    for node, (zero, one) in enumerate(child):
        if zero >= 0:
            out[zero] = out[one] = out[node] + 1
    return out


def near_copies(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp, component_id of every row: the least doc_id reachable over links."""
    rows = written_table(fingerprints(docs, words))
    prints = written_table(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(written_table(links(prints)))
    known = prints.join(labels, prints["fp"] == labels["node"], "left")
    named = known.select("fp", "least", F.coalesce("component", "fp").alias("component"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "component").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")
