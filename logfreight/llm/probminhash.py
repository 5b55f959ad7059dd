"""Near-duplicate documents by ProbMinHash, banding and exact verification.

A document is the set of its runs of five words (lower case, cut at white space; shorter texts
are one run), each weighted 1 + ln(times it occurs). ProbMinHash lets every run arrive as a
Poisson process at the rate of its weight, each arrival falling into one of ``SIZE`` slots; a
slot keeps its earliest run. Arrivals are made in rounds, and a run stops as soon as its next
arrival comes after the latest of the slots' earliest times: nothing it does later can count.
Two documents agree in a slot with the probability Jaccard similarity of their weights.

``BANDS`` bands of seven slots give buckets; at similarity 0.8 a pair shares one with probability
0.9998, at 0.5 with 0.25. Within a bucket all members are compared with one of them, and what
that links becomes components. Then come ``ROUNDS`` rounds: in each bucket that holds several
components, members outside the largest one are compared with one member of it and with one
from outside it, by a hash that changes with the round. What is still apart after that is
compared with all other components of the bucket, if ``AGREE`` slots agree (which a pair at 0.8
misses once in 10^5) and if a bound allows it: runs that occur in
one component only cannot be common to members of two, so with n runs, r of them in several
components, two such documents have a Jaccard index of at most m / (n + n' - m), m the lesser r;
and the probability Jaccard is at most the share of weight of these runs in either. A second bound
tells pairs apart that have most such runs in common: ``odd_classes`` deals the runs of a document into
``CLASSES`` classes and keeps a bit per class, whether it has an odd number. A class whose bits differ
holds a run of one document only, so the bits that differ are at most the runs that only one has: at
a Jaccard index of t at most (n + n') (1 - t) / (1 + t). At a probability Jaccard of t the shares of
weight a and b that only one has fulfil a + b <= 2 (1 - t) / (1 + t) (below), and a run weighs 1 or
more, so they are at most the greater of both weights times that. So a bucket of near copies costs a few comparisons a
member, variants that are all a little too far from each other are told by their bits inside the
join (which still looks at each two of them in a bucket), and no link between different texts is
lost. Beyond some 4,000 runs a document the bits tell little, and the slots have to.

Verification is exact: a pair is linked if its probability Jaccard, or the Jaccard index of
the plain sets (so that repeated lines hide no copy), is ``THRESHOLD`` or more. Texts with a
repeated run have a second sketch of the plain set for that.

Equal texts are one node, however many there are. Every input row gives one row; its class is
the least doc_id of the texts linked to it. Null, empty and wordless texts are linked to none:
their class is their own id. Null ids take part; a class of null ids alone has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.components import components
from logfreight.llm.rolling import gram_hashes, mixed
from logfreight.llm.texts import as_rows, batches_of, for_worker
from logfreight.session import written_table

WORDS = 5
SIZE, BANDS = 252, 36
THRESHOLD = 0.8
AGREE = 172
ROUNDS = 2
CLASSES = 2048


class WordHashes(dict):
    """Hashes of words met lately."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) > 200_000:
                self.clear()
            self[word] = found
        return found


def shingles(text: str | None, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the runs of words, and how often each occurs."""
    split = (text or "").lower().split()
    if not split:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    known = for_worker("shingles", WordHashes)
    symbols = np.fromiter(map(known.__getitem__, split), np.uint64, len(split))
    return np.unique(gram_hashes(symbols, min(words, len(split))), return_counts=True)


def weights_of(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts, dtype=float)


def prob_min_hash(elements: np.ndarray, weights: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The element that arrives first in each slot."""
    first = np.full(size, np.inf)
    owner = np.zeros(size, np.uint64)
    active, rates, clock, turn = elements, weights, np.zeros(len(elements)), 0
    while len(active):
        many = max(1, -(-2 * size // len(active)))
        turns = np.arange(turn + 1, turn + many + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        draws = mixed(active[:, None] + turns[None, :])
        slots = (mixed(draws ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(size)).astype(np.int64).ravel()
        gaps = -np.log1p(-((draws >> np.uint64(11)).astype(float) * 2.0**-53)) / rates[:, None]
        times = clock[:, None] + np.cumsum(gaps, axis=1)
        flat, before = times.ravel(), first.copy()
        np.minimum.at(first, slots, flat)
        won = np.flatnonzero((flat == first[slots]) & (flat < before[slots]))[::-1]
        owner[slots[won]] = active[won // many]
        clock, turn = times[:, -1], turn + many
        going = clock < first.max()
        active, rates, clock = active[going], rates[going], clock[going]
    return owner


def band_hashes(owner: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit integer per band; the band's number is part of it."""
    rows = owner.reshape(bands, -1)
    code = mixed(np.arange(1, bands + 1, dtype=np.uint64))
    for column in rows.T:
        code = mixed(code * np.uint64(0x100000001B3) + column)
    return code.view(np.int64)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Sum over common d of 1 / sum over e of max(a_e / a_d, b_e / b_d), by order of a_e / b_e."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = wa[ia], wb[ib]
    ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    above = x.sum() - np.concatenate([[0], np.cumsum(x)[:-1]])
    below = np.concatenate([[0], np.cumsum(y)[:-1]])
    return float((x / (above + only_a + ratio * (below + only_b))).sum())


def linked(a: tuple, b: tuple, threshold: float = THRESHOLD) -> bool:
    """Whether two documents, as (hashes, counts), are near copies."""
    common = len(np.intersect1d(a[0], b[0], assume_unique=True))
    if not common:
        return False
    slack = 1e-9
    if common / (len(a[0]) + len(b[0]) - common) >= threshold - slack:
        return True
    if a[1].max() == 1 and b[1].max() == 1:
        return False
    return probability_jaccard(a[0], weights_of(a[1]), b[0], weights_of(b[1])) >= threshold - slack


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, text and the digest that names equal texts."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, node, slots (8 bits of each), plain slots and bands; nulls for texts without words.

    A text with a repeated run has a second sketch with all weights 1, its plain slots, and the
    bands of both; of other texts the two are the same and plain is null.
    """
    short = lambda owner: (owner & np.uint64(0xFF)).astype(np.uint8).view(np.int8)

    def sketch(text: str | None) -> tuple | None:
        hashes, counts = shingles(text)
        if not len(hashes):
            return None
        owner = prob_min_hash(hashes, weights_of(counts))
        if counts.max() == 1:
            return short(owner), None, band_hashes(owner)
        plain = prob_min_hash(hashes, np.ones(len(hashes)))
        return short(owner), short(plain), np.union1d(band_hashes(owner), band_hashes(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1000):
            made, kept, seen = [], [], {}
            for node, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if node not in seen:
                    seen[node] = sketch(text)
                made.append(seen[node] or (None, None, None))
                kept.append(node if seen[node] else None)
            slots, plain, bands = zip(*made) if made else ((), (), ())
            columns = [
                batch.column(0), pa.array(kept, type=pa.binary()), pa.array(slots, type=pa.list_(pa.int8())),
                pa.array(plain, type=pa.list_(pa.int8())), pa.array(bands, type=pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "slots", "plain", "bands"])

    return _nodes(docs).mapInArrow(run, "doc_id bigint, node binary, slots array<tinyint>, plain array<tinyint>, bands array<bigint>")


def _hashed(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and blob, hashes of 32 bits with counts, of the nodes in ``wanted`` (node, doc_id).

    Only their texts are read on, each from the row of its least doc_id.
    """
    rows, w = _nodes(docs).alias("r"), wanted.alias("w")
    same = (F.col("r.node") == F.col("w.node")) & F.col("r.doc_id").eqNullSafe(F.col("w.doc_id"))
    texts = rows.join(w, same, "left_semi")

    def hash_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 500):
            blobs = []
            for text in batch.column(1).to_pylist():
                hashes, counts = shingles(text)
                low, at = np.unique((hashes >> np.uint64(32)).astype("<u4"), return_inverse=True)
                total = np.bincount(at, counts, len(low)).astype("<u4")
                small = total.max(initial=0) < 256
                blobs.append(bytes([1 if small else 4]) + low.tobytes() + total.astype("<u1" if small else "<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, type=pa.binary())], names=["node", "blob"])

    return texts.select("node", "text").mapInArrow(hash_all, "node binary, blob binary").dropDuplicates(["node"])


def parsed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of 32 bits and counts."""
    wide = blob[0]
    n = (len(blob) - 1) // (4 + wide)
    return np.frombuffer(blob, "<u4", n, 1), np.frombuffer(blob, f"<u{wide}", n, 1 + 4 * n)


def odd_classes(hashes: np.ndarray) -> np.ndarray:
    """A bit for each class of hashes, whether an odd number of them is in it, as 64-bit integers."""
    many = np.bincount((hashes % CLASSES).astype(np.int64), minlength=CLASSES)
    return np.packbits((many & 1).astype(bool)).view(np.int64)


def _bounds(hashed: DataFrame, of: DataFrame) -> DataFrame:
    """node, n, total (weight), r (runs that other components have too), share (of weight), even and odd.

    ``of`` has node and c, its component. Rows are (run, node); the components of a run are
    told by the least and the greatest, combined below the shuffle.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 200):
            for node, blob, c in zip(*(column.to_pylist() for column in batch.columns)):
                hashes, counts = parsed(blob)
                same = pa.array(np.zeros(len(hashes), np.int32))
                ends = [pa.array([value], type=pa.binary()).take(same) for value in (node, c)]
                columns = [pa.array(hashes.view(np.int32)), ends[0], pa.array(weights_of(counts)), ends[1]]
                yield pa.RecordBatch.from_arrays(columns, names=["run", "node", "weight", "c"])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1000):
            hashes, counts = zip(*map(parsed, batch.column(1).to_pylist())) if batch.num_rows else ((), ())
            columns = [
                batch.column(0), pa.array([len(c) for c in counts], type=pa.int64()),
                pa.array([weights_of(c).sum() for c in counts], type=pa.float64()),
                pa.array([int(c.max(initial=1)) == 1 for c in counts], type=pa.bool_()),
                pa.array([odd_classes(h) for h in hashes], type=pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "total", "even", "odd"])

    table = hashed.join(of, "node").select("node", "blob", "c")
    each = written_table(table.mapInArrow(runs, "run int, node binary, weight double, c binary"))
    inside = each.groupBy("run").agg(F.min("c").alias("least"), F.max("c").alias("most")).filter("least = most").select("run")
    alone = each.join(inside, "run", "left_semi").groupBy("node").agg(F.count("*").alias("alone"), F.sum("weight").alias("lost"))
    sums = table.select("node", "blob").mapInArrow(totals, "node binary, n bigint, total double, even boolean, odd array<bigint>")
    r, share = F.expr("n - coalesce(alone, 0)"), F.expr("1 - coalesce(lost, 0) / total")
    return sums.join(alone, "node", "left").select("node", "n", "total", r.alias("r"), share.alias("share"), "even", "odd")


def verified(pairs: DataFrame, hashed: DataFrame) -> DataFrame:
    """Those pairs (a, b) of nodes that are near copies, by their hashes."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1000):
            blobs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            keep = pa.array([linked(parsed(x), parsed(y)) for x, y in blobs])
            yield batch.select(["a", "b"]).filter(keep)

    first = pairs.join(hashed.select(F.col("node").alias("a"), F.col("blob").alias("blob_a")), "a")
    both = first.join(hashed.select(F.col("node").alias("b"), F.col("blob").alias("blob_b")), "b")
    return both.select("a", "b", "blob_a", "blob_b").mapInArrow(verify, "a binary, b binary")


def _agree(x: str, y: str) -> str:
    """Whether enough of the slots of two documents (columns such as xs, xp and ys, yp) agree."""
    test = "aggregate(zip_with({}, {}, (p, q) -> if(p = q, 1, 0)), 0, (s, t) -> s + t) >= {}".format
    return f"{test(f'{x}s', f'{y}s', AGREE)} OR {test(f'coalesce({x}p, {x}s)', f'coalesce({y}p, {y}s)', AGREE)}"


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """band, node, component c and main of the buckets with members of several components.

    ``main`` is the bucket's largest component; nodes without links are components of their own.
    """
    labelled = members.join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("c"))
    sizes = labelled.groupBy("band", "c").agg(F.count("*").alias("n"))
    buckets = sizes.groupBy("band").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("kinds"))
    return labelled.join(buckets.filter("kinds > 1").select("band", "main"), "band")


LEAST = THRESHOLD - 1e-6
# What one document's own runs allow, and what those of two allow.
ALLOWED_ALONE = f"r >= {LEAST}D * n OR (NOT even AND share >= {LEAST}D)"
ALLOWED = f"least(xr, yr) >= {LEAST}D * (xn + yn - least(xr, yr)) OR NOT (xe AND ye)"
# What the runs that only one of them has allow. Probability Jaccard: a common run's term is at most
# 1 / (u / x + v / y), u the mean of x's weight and of that x has alone, v the same of y. That is concave, so
# their sum is at most that of the sums of x and y, 2 / ((1 + a) / (1 - a) + (1 + b) / (1 - b)).
APART = "aggregate(zip_with(xo, yo, (p, q) -> bit_count(p ^ q)), 0, (s, t) -> s + t)"
ALLOWED_APART = f"{APART} <= {(1 - LEAST) / (1 + LEAST)}D * if(xe AND ye, xn + yn, 2 * greatest(xw, yw))"


def _pivots(rows: DataFrame, slots: DataFrame, turn: int) -> DataFrame:
    """Pairs of members outside a bucket's main component with one inside and one outside it."""
    order = F.xxhash64("node", F.lit(turn))
    chosen = rows.groupBy("band", (F.col("c") == F.col("main")).alias("inside")).agg(F.min_by(F.struct("node", "c"), order).alias("p"))
    met = rows.filter("c <> main").join(chosen.select("band", "p"), "band").filter("c <> p.c")
    pairs = met.select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
    for end in ("a", "b"):
        sides = slots.select(F.col("node").alias(end), F.col("slots").alias(f"{end}s"), F.col("plain").alias(f"{end}p"))
        pairs = pairs.join(sides, end)
    return pairs.filter(_agree("a", "b")).select("a", "b")


def _across(rows: DataFrame, slots: DataFrame, hashed: DataFrame) -> DataFrame:
    """Pairs of one bucket but different components that may be near copies by both bounds and slots."""
    bounds = _bounds(hashed, rows.select("node", "c").distinct()).filter(ALLOWED_ALONE)
    full = written_table(rows.join(slots.join(bounds, "node"), "node"))
    kept = {"node": "", "c": "c", "slots": "s", "plain": "p", "n": "n", "total": "w", "r": "r", "even": "e", "odd": "o"}
    side = lambda table, name: table.select("band", "main", *[F.col(c).alias(name + short) for c, short in kept.items()])
    met = side(full.filter("c <> main"), "x").join(side(full, "y").drop("main"), "band")
    met = met.filter("xc <> yc AND (yc = main OR x < y)").filter(ALLOWED).filter(ALLOWED_APART).filter(_agree("x", "y"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Components after further links."""
    stars = labels.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return written_table(components(stars.union(found)))


def classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id and node of every row; node, class_id and main (the node that stands for its class)."""
    sketched = written_table(sketches(docs))
    named = sketched.filter("node IS NOT NULL")
    reps = written_table(named.groupBy("node").agg(F.min("doc_id").alias("doc_id")))
    bands = named.select("node", F.explode("bands").alias("band")).groupBy("band", "node").agg(F.lit(1).alias("one"))
    leaders = bands.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
    members = written_table(bands.select("band", "node").join(leaders.select("band", "leader"), "band"))
    met = members.select("node").distinct()
    hashed = written_table(_hashed(docs, met.join(reps, "node")))
    stars = members.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    labels = written_table(components(written_table(verified(stars.distinct(), hashed))))
    slots = named.join(met, "node", "left_semi").select("node", "slots", "plain").dropDuplicates(["node"])
    rows = written_table(_mixed(members.select("band", "node"), labels))
    for turn in range(ROUNDS + 1):
        found = written_table(verified(_pivots(rows, slots, turn) if turn < ROUNDS else _across(rows, slots, hashed), hashed))
        if found.limit(1).count():
            labels = _joined(labels, found)
            if turn < ROUNDS:
                rows = written_table(_mixed(rows.select("band", "node"), labels))
    joined = reps.join(labels, "node", "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    first = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "node")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.min_by("node", first).alias("main"))
    return sketched.select("doc_id", "node"), joined.join(least, "component").select("node", "class_id", "main", "doc_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and is_kept (the document that stands for its class) of every row."""
    rows, classes = classes_of(docs)
    rows = rows.join(classes.select("node", "class_id"), "node", "left")
    class_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return rows.select("doc_id", class_id.alias("class_id"), F.col("doc_id").eqNullSafe(class_id).alias("is_kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the least doc_id.

    Of repeated rows of it one stays. Rows without words stay all.
    """
    _, classes = classes_of(docs)
    kept = classes.filter("node = main").select(F.col("node").alias("_node"), F.col("doc_id").alias("_doc"))
    rows = as_rows(docs).select("row", "text", F.unhex(F.md5("text")).alias("_node"), F.col("doc_id").alias("_doc"))
    worded = F.length(F.trim(F.regexp_replace("text", r"(?U)\s+", " "))) > 0
    blank = rows.filter(~F.coalesce(worded, F.lit(False)))
    stay = rows.join(kept.alias("k"), (rows["_node"] == F.col("k._node")) & rows["_doc"].eqNullSafe(F.col("k._doc")), "left_semi")
    return stay.dropDuplicates(["_node", "_doc"]).union(blank).select("row.*")
