"""Packing on Spark: skew, slices, the tree of borders, and its contracts."""

import random

import pytest
from pyspark.sql import functions as F

from logfreight.functions.sizes import opening_metadata_size
from logfreight.model import PackOptions
from logfreight.operators import pack
from logfreight.plans import greedy
from tests.folds import fold

SCHEMA = (
    "producer string, topic_id string, arrival_ms long, seq long, size_bytes long, "
    "logs_wire_bytes long, n_logs long"
)


def narrow_rows(seed, n, hot_share=0.6, still=False, lists=False):
    rng = random.Random(seed)
    rows, clock = [], {}
    for seq in range(n):
        topic = "hot" if rng.random() < hot_share else f"t{rng.randint(0, 20)}"
        clock[topic] = clock.get(topic, 0) + (0 if still else rng.choice([0, 1, 3, 20, 150]))
        size = rng.randint(4, 60)
        n_logs = rng.randint(1, 5) if lists else 1
        rows.append(("main", topic, clock[topic], seq, size, size + rng.randint(5, 30), n_logs))
    return rows


def expected(rows, opts):
    metadata = opening_metadata_size(opts.source, opts.hostname)
    ordered = sorted(rows)
    folded = fold([((r[0], r[1]), r[2], r[4], r[5] + metadata, r[6]) for r in ordered], opts)
    return sorted((r[1], r[3], *label) for r, label in zip(ordered, folded))


def packed(spark, rows, opts):
    random.Random(1).shuffle(rows)
    labels = pack.assign_packages(spark.createDataFrame(rows, SCHEMA), opts)
    names = ["topic_id", "seq", "package_seq", "create_ms", "close_ms", "close_reason"]
    return sorted(tuple(r) for r in labels.select(*names).collect())


@pytest.mark.parametrize(
    "seed, partitions, slice_rows, still, lists",
    [
        (1, 1, 10**6, False, False),
        (2, 7, 10**6, False, False),
        (3, 70, 10**6, False, False),  # more than one level of borders
        (4, 5, 37, False, False),  # partitions taken in slices
        (5, 40, 9, True, False),  # all rows of a topic at the same time
        (6, 9, 50, False, True),
    ],
)
def test_equals_fold(spark, seed, partitions, slice_rows, still, lists):
    opts = PackOptions(
        max_bytes=400,
        cap_bytes=430,
        max_logs=12,
        linger_ms=400,
        partitions=partitions,
        slice_rows=slice_rows,
    )
    rows = narrow_rows(seed, 3000, still=still, lists=lists)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert packed(spark, rows, opts) == expected(rows, opts)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_topic_spans_tasks(spark):
    rows = narrow_rows(8, 4000, hot_share=0.9, still=True)
    ordered = pack.range_ordered(
        spark.createDataFrame(rows, SCHEMA), pack.SEQUENCE, pack.ARRIVAL, 8
    )
    sizes = [r["count"] for r in ordered.groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8


def test_limits_at_the_edge(spark):
    metadata = opening_metadata_size("", "")
    opts = PackOptions(max_bytes=200, cap_bytes=210, max_logs=3, linger_ms=100, partitions=3)
    rows = [
        # exactly full, then one byte over, then a close by count
        ("main", "full", 0, 1, 50, 100 - metadata, 1),
        ("main", "full", 1, 2, 100, 100, 1),
        ("main", "full", 2, 3, 1, 1, 1),
        # an opener larger than the limit or the cap is not tested itself
        ("main", "big", 0, 1, 500, 500, 1),
        ("main", "big", 0, 2, 4, 10, 1),
        # linger: one before, exactly at it
        ("main", "slow", 0, 1, 4, 10, 1),
        ("main", "slow", 99, 2, 4, 10, 1),
        ("main", "slow", 100, 3, 4, 10, 1),
        # max_logs and one more
        *[("main", "many", 0, i, 4, 10, 1) for i in range(4)],
    ]
    got = {(t, s): (n, why) for t, s, n, _, _, why in packed(spark, rows, opts)}
    assert got[("full", 3)] == (1, "size")
    assert got[("big", 1)] == (1, "overflow") and got[("big", 2)] == (2, "flush")
    assert got[("slow", 2)] == (1, "linger") and got[("slow", 3)] == (2, "flush")
    assert got[("many", 2)] == (1, "count") and got[("many", 3)] == (2, "flush")


def test_rows_must_be_unique(spark):
    rows = [("main", "t", 5, 1, 4, 10, 1)] * 2
    with pytest.raises(Exception, match="not unique"):
        packed(spark, rows, PackOptions(partitions=2))


def test_empty_input(spark):
    assert packed(spark, [], PackOptions()) == []


def test_every_log_is_packed_once(spark, folder):
    from logfreight.plans.sample_tables import event_logs

    logs = event_logs(spark, folder)
    out = pack.pack_logs(logs, PackOptions(linger_ms=3_600_000, max_logs=5))
    assert out.count() == logs.count()
    assert out.select("topic_id", "seq").distinct().count() == logs.count()
    assert set(logs.columns) < set(out.columns)


def test_grid_keeps_the_limits(spark, folder):
    from logfreight.plans.sample_tables import event_logs

    opts = PackOptions(max_bytes=200, max_logs=5, linger_ms=10_800_000, partitions=6)
    logs = event_logs(spark, folder)
    cells = pack.pack_logs_grid(logs, opts)
    assert cells.count() == logs.count()
    per_cell = cells.groupBy("package_id").agg(
        F.count("*").alias("n"),
        F.sum("size_bytes").alias("bytes"),
        F.max("size_bytes").alias("largest"),
        (F.max("arrival_ms") - F.min("arrival_ms")).alias("span"),
    )
    over = "n > 5 OR bytes > 200 + largest OR span >= 10800000"
    assert per_cell.filter(over).count() == 0


def test_segments_pack_alone(spark):
    """Packing a stretch between gaps by itself gives the same packages."""
    opts = PackOptions(max_bytes=300, cap_bytes=320, max_logs=8, linger_ms=120)
    rows = narrow_rows(11, 1500)
    whole = expected(rows, opts)
    segments = pack.split_segments(spark.createDataFrame(rows, SCHEMA), 120, 5)
    number = {(r.topic_id, r.seq): r.segment for r in segments.collect()}
    alone = [("main", f"{r[1]}/{number[(r[1], r[3])]:05}", *r[2:]) for r in rows]
    cut = expected(alone, opts)
    by_row = {s: c for _, s, _, c, _, _ in whole}
    assert all(by_row[s] == c for _, s, _, c, _, _ in cut)
    assert {why for *_, why in whole} == set(greedy.REASONS)
