"""Hard negatives: of other labels, with scores in a window below that of a positive.

Components are integers; a score is an inner product with the anchor. The positives of an
anchor are its ``positives`` best rows of the same label. For each, the best ``negatives`` rows
of other labels whose score is from ``low`` to ``high`` hundredths of the positive's are mined.

Candidates are sorted by label over ranges (a label with a third of all rows spans as many as
its share) and cut into blocks of ``ROWS`` of one label; a cover tree is built over each where it
lies. Anchors are packed into blocks of ``ANCHORS``. A task of the grid holds one block of
anchors and one stripe of trees, whose windows carry their kth scores from tree to tree; Spark
merges the best k of stripes. The search for positives leaves out stripes without a label of
the block. Nothing is broadcast and no pair is written out but what windows hold.

Rows with a null id, label or vector, or a component that is null, NaN or infinite take no part.
Only vectors of the same length are compared; empty ones score 0. An anchor skips the rows that
have its own id; repeated ids are rows of their own, also as anchors. Sums must stay within
64 bits. Positives of score 0 have negatives of score 0, those below 0 have none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as Over
from pyspark.sql import functions as F

from logfreight.llm.cover_tree import CoverTree, Window, narrow, wide
from logfreight.session import written_table

ROWS = 2048
ANCHORS = 256
STRIPE = 4
# Tasks for each full cell of the grid (a block of anchors and a stripe of full trees), and at most.
SPREAD = 4
TASKS = 1 << 14
KEY = ["dims", "label", "row"]
TREE = ["centre", "radius", "child", "children", "low", "high", "ids", "points"]


def _ordered(rows: DataFrame, per_task: int) -> DataFrame:
    """Rows in ranges of (dims, label, row) of about ``per_task`` rows each, sorted."""
    parts = max(1, -(-rows.count() // per_task))
    # Where the session makes more ranges than that, neighbours are put together again.
    return rows.repartitionByRange(parts, *KEY).sortWithinPartitions(*KEY).coalesce(parts)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, at most ``most`` of them at a time."""
    held: list[pa.RecordBatch] = []
    last, many = None, 0
    for batch in batches:
        columns = [batch.column(name).to_numpy() for name in keys]
        differ = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
        for column in columns:
            differ |= column[1:] != column[:-1]
        edges = [0, *(np.flatnonzero(differ) + 1), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            if begin == end:
                continue
            key = [column[begin] for column in columns]
            if held and key != last:
                yield pa.Table.from_batches(held)
                held, many = [], 0
            last = key
            while begin < end:
                part = batch.slice(begin, min(end - begin, most - many))
                held.append(part)
                begin, many = begin + part.num_rows, many + part.num_rows
                if many == most:
                    yield pa.Table.from_batches(held)
                    held, many = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _points(table: pa.Table, dims: int) -> np.ndarray:
    return table["components"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, dims)


def trees(rows: DataFrame, size: int = ROWS, stripe: int = STRIPE) -> DataFrame:
    """dims, label, stripe and the packed cover tree of every block of candidates."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["dims", "label"], size):
            dims, label = run["dims"][0].as_py(), run["label"][0].as_py()
            tree = CoverTree(run["id"].to_numpy(), _points(run, dims))
            yield pa.RecordBatch.from_pylist([{"dims": dims, "label": label, **tree.packed()}], schema=kind)

    kind = pa.schema(
        [("dims", pa.int32()), ("label", pa.int64()), *[(n, pa.binary()) for n in TREE], ("reach", pa.float64())]
    )
    schema = "dims int, label bigint, " + ", ".join(f"{n} binary" for n in TREE) + ", reach double"
    made = _ordered(rows, size * stripe).mapInArrow(build, schema)
    # Ranges follow the labels, so a stripe is a part of a range and has few labels.
    place = F.monotonically_increasing_id()
    return written_table(made.withColumn("stripe", place - F.pmod(place, F.lit(stripe))))


def anchor_blocks(anchors: DataFrame, size: int = ANCHORS) -> DataFrame:
    """dims, block, first and last label, and the anchors of a block with their windows.

    ``anchors`` has id, label, row, dims, components, lows and highs (array<bigint>).
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["dims"], size):
            dims, labels = run["dims"][0].as_py(), run["label"].to_numpy()
            whole = {n: run[n].to_numpy().tobytes() for n in ("id", "row", "label")}
            lists = {n: [run[n].combine_chunks()] for n in ("lows", "highs")}
            columns = {
                "dims": pa.array([dims], pa.int32()), "first": pa.array([labels.min()]), "last": pa.array([labels.max()]),
                **{n: pa.array([v], pa.binary()) for n, v in whole.items()},
                "exact": pa.array([narrow(_points(run, dims))], pa.binary()),
                **{n: pa.array([v[0].to_pylist()], pa.list_(pa.list_(pa.int64()))) for n, v in lists.items()},
            }
            yield pa.RecordBatch.from_pydict(columns)

    schema = (
        "dims int, first bigint, last bigint, id binary, row binary, label binary, exact binary, "
        "lows array<array<bigint>>, highs array<array<bigint>>"
    )
    made = _ordered(anchors, size).mapInArrow(pack, schema)
    return written_table(made.withColumn("block", F.monotonically_increasing_id()))


def search(blocks: DataFrame, held: DataFrame, k: int, same: bool) -> DataFrame:
    """row, window, rank, id, score: the k best candidates in each window of each anchor.

    ``same`` searches the candidates of an anchor's label, otherwise those of all others.
    """
    stripes = held.groupBy("dims", "stripe").agg(F.min("label").alias("low_label"), F.max("label").alias("high_label"))
    near = F.col("low_label").between(F.col("first"), F.col("last")) | F.col("first").between(F.col("low_label"), F.col("high_label"))
    one = (F.col("low_label") == F.col("first")) & (F.col("high_label") == F.col("last")) & (F.col("first") == F.col("last"))
    wanted = near if same else ~one
    keys = blocks.select("dims", "block", "first", "last").join(stripes, "dims").filter(wanted)
    keys = written_table(keys.select("dims", "block", "stripe"))
    grid = ["dims", "block", "stripe"]
    # Where ranges hold few rows there are many small cells, so tasks follow the pairs in them.
    asked = blocks.agg(F.sum(F.octet_length("id")) / 8).first()[0] or 0
    candidates = held.agg(F.sum(F.octet_length("ids")) / 8).first()[0] or 0
    tasks = int(max(1, min(keys.count(), SPREAD * -(-asked * candidates // (ANCHORS * ROWS * STRIPE)), TASKS)))
    left = blocks.join(keys, ["dims", "block"]).repartition(tasks, *grid)
    right = held.join(keys, ["dims", "stripe"]).repartition(tasks, *grid)
    schema = "row bigint, window int, id bigint, score bigint"

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        dims, asked = key[0].as_py(), left.to_pylist()
        names = ("row", "window", "id", "score")
        out: dict[str, list] = {n: [np.empty(0, np.int64)] for n in names}
        if asked and right.num_rows:
            block = asked[0]
            ids, rows, labels = (np.frombuffer(block[n], "<i8") for n in ("id", "row", "label"))
            queries = wide(block["exact"], len(ids), dims)
            windows = [[Window(a, b, k) for a, b in zip(*both)] for both in zip(block["lows"], block["highs"])]
            for row in range(right.num_rows):
                packed = right.slice(row, 1).to_pylist()[0]
                tree = CoverTree.unpacked(packed, dims)
                for q in np.flatnonzero((labels == packed["label"]) == same):
                    tree.search(queries[q], int(ids[q]), windows[q])
            for row, open_windows in zip(rows.tolist(), windows):
                for w, window in enumerate(open_windows):
                    n = len(window.ids)
                    for name, value in zip(names, (np.full(n, row), np.full(n, w), window.ids, window.scores)):
                        out[name].append(value)
        kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64()
        return pa.table({n: pa.array(np.concatenate(out[n]), type=t) for n, t in zip(names, kinds)})

    found = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInArrow(run, schema)
    order = Over.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: str, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    size: int = ROWS, stripe: int = STRIPE, anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has id, label and components (array<bigint>); ``is_anchor`` is a condition on id.
    """
    clean = vectors.filter("id IS NOT NULL AND label IS NOT NULL AND components IS NOT NULL")
    rows = written_table(
        clean.select(
            F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), "components",
            F.size("components").alias("dims"), F.monotonically_increasing_id().alias("row"),
        )
    )
    held = trees(rows, size, stripe)
    asked = rows.filter(is_anchor)
    all_scores = F.array(F.lit(-(2**63))).alias("lows"), F.array(F.lit(2**63 - 1)).alias("highs")
    near = written_table(search(anchor_blocks(asked.select("*", *all_scores), anchors), held, positives, same=True))
    # At most ``positives`` of a row; the place in the list is the number of its window.
    listed = F.array_sort(F.collect_list(F.struct("rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))))
    best = written_table(near.groupBy("row").agg(listed.alias("best")))
    # Scores s with low * p <= 100 s <= high * p, as whole numbers.
    least = F.expr(f"transform(best, p -> -(({-low} * p.positive_score - pmod({-low} * p.positive_score, 100L)) div 100))")
    most = F.expr(f"transform(best, p -> ({high} * p.positive_score - pmod({high} * p.positive_score, 100L)) div 100)")
    windows = asked.join(best, "row").select(*rows.columns, least.alias("lows"), most.alias("highs"))
    found = search(anchor_blocks(windows, anchors), held, negatives, same=False)
    known = best.join(rows.select("row", F.col("id").alias("anchor_id")), "row")
    known = known.select("row", "anchor_id", F.posexplode("best").alias("window", "p"))
    return known.join(found, ["row", "window"]).select(
        "anchor_id", F.col("p.positive_id"), "rank", F.col("id").alias("negative_id"),
        F.col("p.positive_score"), F.col("score").alias("negative_score"),
    )
