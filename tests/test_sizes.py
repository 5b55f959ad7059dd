"""Sizes at their boundaries and against the encoded bytes."""

import pytest
from pyspark.sql import functions as F

from logfreight.functions import sizes, wire
from logfreight.model import LOG, PAIRS
from logfreight.plans.queries import QUERIES

VARINTS = {
    0: 1,
    1: 1,
    127: 1,
    128: 2,
    16383: 2,
    16384: 3,
    2**35 - 1: 5,
    2**35: 6,
    2**56 - 1: 8,
    2**56: 9,
    2**63 - 1: 9,
    -1: 10,
    -(2**63): 10,
}

LOG_ROWS = [
    (0, [], None),
    (0, None, None),
    (-5, [("k", "v")], -1),
    (1_700_000_000, [("", "")], 0),
    (1, [("k", "v"), ("k", "v")], 2**40),
    (127, [("ключ", "значение"), ("n", "日本語" * 50)], 1_700_000_000),
    (128, [("a" * 200, "b" * 20_000)], None),
]


def test_varint_size(spark):
    frame = spark.createDataFrame([(n,) for n in VARINTS], "n long")
    rows = frame.selectExpr(
        "n", f"{sizes.varint_size('n')} AS size", f"hex(unhex({wire.varint_hex('n')})) AS bytes"
    ).collect()
    for row in rows:
        assert row.size == VARINTS[row.n]
        data = bytes.fromhex(row.bytes)
        assert len(data) == row.size
        value = sum((b & 127) << (7 * i) for i, b in enumerate(data))
        assert value == row.n % (1 << 64)
        assert all(b > 127 for b in data[:-1]) and data[-1] < 128


def test_varint_size_beyond_63_bits(spark, tmp_path):
    events = [4, 3_036_000, 3_100_000, 6_000_000, 36_000_000, 36_000_001]
    spark.createDataFrame([(i,) for i in events], "event_id long").write.parquet(f"{tmp_path}/events.parquet")
    got = dict(QUERIES["varint_size"](spark, str(tmp_path)).collect())
    assert got == {i: 10 if i % 2 else -(-(i * i * 1000003).bit_length() // 7) for i in events}
    assert (got[3_036_000], got[6_000_000], got[36_000_000]) == (9, 10, 11)


@pytest.fixture(scope="module")
def logs(spark):
    return spark.createDataFrame(LOG_ROWS, LOG)


def test_accounting_size_counts_bytes(logs):
    got = [r[0] for r in logs.select(F.expr(sizes.log_size())).collect()]
    expected = [
        4 + sum(len(k.encode()) + len(v.encode()) for k, v in contents or [])
        for _, contents, _ in LOG_ROWS
    ]
    assert got == expected


def test_wire_size_is_the_length_of_the_bytes(logs):
    rows = logs.selectExpr(
        f"{sizes.log_wire_size()} AS size", f"length(unhex({wire.log_hex()})) AS length"
    ).collect()
    assert all(r.size == r.length for r in rows)


def test_group_size_is_the_length_of_the_bytes(logs):
    tags = F.array(F.struct(F.lit("a").alias("key"), F.lit("é").alias("value"))).cast(PAIRS)
    group = logs.agg(F.collect_list(F.struct(*LOG.fieldNames())).alias("logs")).withColumns(
        {
            "context_flow": F.lit("X" * 41),
            "filename": F.lit(None).cast("string"),
            "source": F.lit(""),
            "hostname": F.lit("h" * 130),
            "tags": tags,
        }
    )
    packed = group.select(F.struct("*").alias("g"), "*")
    row = packed.selectExpr(
        f"{sizes.group_wire_size()} AS size",
        f"length(unhex({wire.group_hex('g')})) AS length",
        f"{sizes.request_wire_size(f'array({sizes.group_wire_size()})')} AS request_size",
        f"length({wire.request_bytes('array(g)')}) AS request_length",
    ).first()
    assert row.size == row.length
    assert row.request_size == row.request_length


def test_present_but_empty_text_costs_two_bytes(spark):
    frame = spark.createDataFrame([("",), (None,), ("x",)], "t string")
    got = [r[0] for r in frame.selectExpr(sizes.text_field_size("t")).collect()]
    assert got == [2, 0, 3]


def test_opening_metadata(spark):
    assert sizes.opening_metadata_size("", "") == 43 + 2 + 2
    assert sizes.opening_metadata_size("é" * 64, "h") == 43 + (1 + 2 + 128) + 3


def test_ns_to_ms_cuts_toward_zero(spark):
    values = [1_500_001, -1_500_001, 999_999, -999_999, 0]
    frame = spark.createDataFrame([(v,) for v in values], "n long")
    got = [r[0] for r in frame.selectExpr(sizes.ns_to_ms("n")).collect()]
    assert got == [1, -1, 0, 0, 0]
