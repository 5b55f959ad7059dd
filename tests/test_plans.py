"""Running values over cut sequences, and what the physical plans look like."""

import pathlib
import random
import urllib.parse

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from logfreight.operators.pack import assign_packages, package_summary, sized_logs
from logfreight.plans.ordered import previous_value, range_ordered, ranges_for, running_sums
from logfreight.plans.sample_tables import event_logs
from logfreight.session import work_folder


def sequence_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", "b", None])
        rows.append((key, rng.randint(0, n // 3), i, rng.randint(-5, 9)))
    return rows


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("partitions", [1, 6, 40])
def test_running_values(spark, keys, partitions):
    rows = sequence_rows(partitions, 600)
    frame = spark.createDataFrame(rows, "k string, t long, i long, v long")
    ordered = range_ordered(frame, keys, ["t", "i"], partitions)
    ordered = previous_value(ordered, keys, ["t", "i"], "t", "before")
    got = running_sums(ordered, keys, ["t", "i"], {"total": F.col("v"), "n": F.lit(1)})
    got = {r.i: (r.before, r.total, r.n) for r in got.collect()}

    expected, state = {}, {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        key = k if keys else 0
        before, total, n = state.get(key, (None, 0, 0))
        expected[i] = (before, total + v, n + 1)
        state[key] = (t, total + v, n + 1)
    assert got == expected


def executed(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "log_size",
    "reject_oversize",
    "check_requests",
    "pack_logs",
    "package_summary",
    "pack_logs_grid",
    "split_segments",
    "in_flight_bytes",
    "log_status",
    "unsent",
    "retry_schedule",
    "dead_letters",
    "attempt_history",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_joins(spark, folder, name):
    plan = executed(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name", ["check_request_groups", "split_segments", "in_flight_bytes", "pack_logs_grid"]
)
def test_running_sums_sort_no_rows_again(spark, folder, name):
    assert "Sort [part" not in executed(entry.queries()[name](spark, folder))


def test_more_rows_make_more_ranges():
    assert [ranges_for(n, 200) for n in (0, 25_000, 10**8, 10**11)] == [1, 3, 200, 5000]


def test_work_folder_leaves_nothing(spark, folder, tmp_path):
    before = spark.sparkContext.getCheckpointDir()
    with work_folder(spark) as inside:
        package_summary(assign_packages(sized_logs(event_logs(spark, folder)))).collect()
        place = pathlib.Path(urllib.parse.urlparse(inside).path)
        assert any(place.iterdir())
    assert not place.exists()
    assert spark.sparkContext.getCheckpointDir().startswith(before)


def test_packages_of_two_runs_differ(spark, folder):
    logs = event_logs(spark, folder)
    ids = [assign_packages(sized_logs(logs)).select("package_id").distinct() for _ in range(2)]
    assert ids[0].intersect(ids[1]).count() == 0 and ids[0].count() == ids[1].count()


def test_only_needed_columns_are_read(spark, folder):
    plan = executed(event_logs(spark, folder).select("seq", F.size("contents")))
    schema = plan.split("ReadSchema: ")[1]
    assert "value" not in schema and "props" in schema


def test_filter_reaches_the_scan(spark, folder):
    plan = executed(event_logs(spark, folder).filter("seq > 500"))
    assert "GreaterThan(event_id,500)" in plan


def test_summary_reads_no_contents(spark, folder):
    """After sizing, packing sees narrow rows only, aggregated without a sort."""
    plan = executed(package_summary(assign_packages(sized_logs(event_logs(spark, folder)))))
    assert "contents" not in plan and "SortAggregate" not in plan


def test_few_rows_make_few_partitions(spark, folder):
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        labels = assign_packages(sized_logs(event_logs(spark, folder)))
        assert labels.rdd.getNumPartitions() <= 11
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
