"""Log rows from tables, contents, validation and the outbox."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logfreight.model import LOGS, OUTBOX
from logfreight.operators import assemble, validate
from logfreight.operators.contents import contents_long, contents_wide
from logfreight.sources.logs import logs_from_columns, logs_from_map, with_defaults
from logfreight.sources.outbox import read_outbox, write_outbox
from logfreight.sources import payloads
from logfreight.session import prepare


def test_columns_become_pairs_in_order(spark):
    frame = spark.createDataFrame(
        [(1, "x", 5, None), (2, None, None, 1.5)], "id long, b string, a int, c double"
    )
    logs = logs_from_columns(frame, F.lit("t"), "id", ["b", "a", "c"], "id", "id")
    assert [f.name for f in logs.schema] == [f.name for f in LOGS]
    got = [[tuple(p) for p in r.contents] for r in logs.orderBy("seq").collect()]
    assert got == [[("b", "x"), ("a", "5")], [("c", "1.5")]]


def test_maps_become_pairs_by_key(spark):
    frame = spark.createDataFrame([(1, {"z": 1, "a": 2, "m": None}), (2, None)], "id long, m map<string,int>")
    logs = logs_from_map(frame, "m", F.lit(None).cast("string"), "id", "id", "id").orderBy("seq")
    rows = logs.collect()
    assert [tuple(p) for p in rows[0].contents] == [("a", "2"), ("z", "1")]
    assert rows[1].contents is None and rows[0].topic_id == ""


def test_shards_spread_a_topic(spark):
    frame = spark.range(1000)
    logs = logs_from_columns(frame, F.lit("t"), "id", ["id"], "id", "id", producer_shards=4)
    counts = [r["count"] for r in logs.groupBy("producer").count().collect()]
    assert len(counts) == 4 and min(counts) > 150


def test_duplicate_and_missing_keys(spark):
    pairs = [("k", "1"), ("k", "2"), ("j", "")]
    logs = spark.createDataFrame([("t", "p", 1, 1, 1, pairs, None), ("t", "p", 2, 2, 2, [], None)], LOGS)
    wide = contents_wide(logs, ["k", "j", "none"]).orderBy("seq").collect()
    assert (wide[0].k, wide[0].j, wide[0].none) == ("1", "", None)
    assert (wide[1].k, wide[1].j) == (None, None)
    long = contents_long(logs).orderBy("seq", "position").collect()
    assert [(r.position, r.key, r.value) for r in long] == [
        (0, "k", "1"),
        (1, "k", "2"),
        (2, "j", ""),
        (None, None, None),
    ]


def test_defaults(spark):
    logs = spark.createDataFrame([("t", "p", 1, 1, None, [(None, "v"), ("k", None)], None)], LOGS)
    row = with_defaults(logs.withColumn("source", F.lit(None).cast("string"))).first()
    assert (row.time, row.collect_time, row.source) == (0, 0, "")
    assert [tuple(p) for p in row.contents] == [("", "v"), ("k", "")]


def values(spark, *texts):
    rows = [("t", "p", i, i, i, [("k", t)], None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, LOGS)


@pytest.mark.parametrize("unit", ["a", "é", "日"])
def test_value_limit_counts_bytes(spark, unit):
    width = len(unit.encode())
    fits = unit * (1048576 // width) + "x" * (1048576 % width)
    accepted, rejected = validate.reject_oversize(values(spark, fits, fits + "x"))
    assert [r.seq for r in accepted.collect()] == [0]
    assert [(r.seq, r.reason) for r in rejected.collect()] == [(1, "value_too_large")]


def test_incomplete_logs(spark):
    rows = [
        ("t", "p", 0, 0, 0, None, None),
        ("t", "p", 1, 1, None, [], None),
        ("t", "p", 2, 2, 2, [("k", "v"), (None, "v")], None),
        ("t", "p", 3, 3, 3, [("k", None)], None),
    ]
    accepted, rejected = validate.reject_incomplete(spark.createDataFrame(rows, LOGS))
    assert [r.seq for r in accepted.collect()] == [0]
    reasons = {r.seq: r.reason for r in rejected.collect()}
    assert reasons == {1: "missing_time", 2: "missing_key", 3: "missing_value"}


def test_request_limits(spark):
    big = "v" * (5242880 // 8 - 5)
    logs = values(spark, *[big] * 8).withColumn("r", F.lit("exact"))
    over = values(spark, *[big] * 7, big + "v").withColumn("r", F.lit("over"))
    empty = [("t", "p", i, i, i, [], None) for i in range(10001)]
    many = spark.createDataFrame(empty, LOGS).withColumn("r", F.lit("many"))
    enough = many.filter("seq < 10000").withColumn("r", F.lit("enough"))
    wide = values(spark, "v" * 1048577).withColumn("r", F.lit("wide"))
    checked = validate.check_requests(
        logs.unionByName(over).unionByName(many).unionByName(enough).unionByName(wide), ["r"]
    )
    got = {r.r: (r.accepted, r.reason) for r in checked.collect()}
    assert got == {
        "exact": (True, None),
        "over": (False, "request_too_large"),
        "many": (False, "request_too_large"),
        "enough": (True, None),
        "wide": (False, "value_too_large"),
    }


def test_third_group_is_the_first_over(spark):
    logs = values(spark, *["v" * 100] * 5).withColumns({"r": F.lit(1), "g": F.col("seq")})
    limit = 2 * 105
    row = validate.check_request_groups(logs, ["r"], "g", max_bytes=limit, partitions=4).first()
    assert (row.accepted, row.first_bad, row.reason) == (False, 2, "request_too_large")
    row = validate.check_request_groups(logs, ["r"], "g", max_bytes=5 * 105, partitions=4).first()
    assert row.accepted and row.first_bad is None and row.n_groups == 5


def test_direct_and_queued_metadata(spark):
    frame = spark.range(1)
    queued = assemble.stamp_group(frame, source=None).first()
    assert (queued.source, queued.hostname, queued.filename, queued.tags) == ("", "", None, [])
    direct = assemble.stamp_group(frame, source=None, direct=True).first()
    assert (direct.source, direct.hostname) == (None, None)
    kept = frame.withColumn("source", F.lit("own"))
    assert assemble.stamp_group(kept, source=None, direct=True).first().source == "own"
    assert assemble.stamp_group(kept, source="new", hostname="h", direct=True).first().source == "new"


def box(spark, *packages):
    rows = [(p, "none", 1, 1, bytearray(b"x"), topic) for p, topic in packages]
    return spark.createDataFrame(rows, OUTBOX)


def test_outbox_batches_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "outbox")
    write_outbox(box(spark, ("a", "007"), ("b", ""), ("c", "t/x")), path, 0)
    write_outbox(box(spark, ("d", "t")), path, 1)
    write_outbox(box(spark, ("a", "007"), ("b", "")), path, 0)
    rows = sorted((r.package_id, r.topic_id, r.batch_id) for r in read_outbox(spark, path).collect())
    assert rows == [("a", "007", 0), ("b", "", 0), ("d", "t", 1)]


def test_outbox_prunes_topics(spark, tmp_path):
    path = str(tmp_path / "outbox")
    write_outbox(box(spark, ("a", "x"), ("b", "y")), path, 0)
    found = read_outbox(spark, path).filter("topic_id = 'x'")
    assert [r.package_id for r in found.collect()] == ["a"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_assembled_requests_are_bounded(spark):
    logs = values(spark, *["v" * 100] * 6).withColumns(
        {"r": F.expr("seq div 3"), "g": F.expr("seq % 3")}
    )
    groups = logs.groupBy("r", "g").agg(
        F.collect_list(F.struct("time", "contents", "collect_time")).alias("logs")
    )
    extra = groups.filter("r = 1").withColumn("g", F.col("g") + 10)
    requests, rejected = assemble.assemble_requests(
        groups.unionByName(extra), ["r"], "g", max_bytes=4 * 105
    )
    assert [(r.r, [g.g for g in r.groups]) for r in requests.collect()] == [(0, [0, 1, 2])]
    assert [(r.r, r.first_bad) for r in rejected.collect()] == [(1, 11)]


def _field(tag, body):
    size, n = b"", len(body)
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    return bytes([tag]) + size + bytes([n]) + body


def test_decoded_batches_are_bounded_by_bytes():
    pair = _field(0x0A, b"k") + _field(0x12, b"v" * 200_000)
    body = _field(0x0A, _field(0x0A, b"\x08\x05" + _field(0x12, pair)))
    columns = [pa.array([str(i) for i in range(60)]), pa.array(["none"] * 60), pa.array([body] * 60, pa.binary())]
    given = pa.RecordBatch.from_arrays(columns, names=["payload_id", "compress_type", "payload"])
    batches = list(payloads._decode(iter([given])))
    assert sum(b.num_rows for b in batches) == 60 and all(b["_corrupt"].null_count == b.num_rows for b in batches)
    assert max(b.nbytes for b in batches) < 5 << 20


def test_large_rows_reach_python_in_bounded_batches(spark):
    prepare(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    rows = spark.range(0, 1600, 1, 1).selectExpr("CAST(repeat('x', 20000) AS binary) AS payload")
    told = [r.n for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(told) >= 32_000_000 and max(told) < 10 << 20
