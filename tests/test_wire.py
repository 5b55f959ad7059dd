"""Encoding, compressing and reading back."""

import random

import pytest
from pyspark.sql import functions as F

from logfreight.functions import codecs
from logfreight.model import LOGS, PackOptions
from logfreight.operators.assemble import encode_packages, stamp_group
from logfreight.operators.pack import pack_logs
from logfreight.sources.payloads import decode_payloads, decode_request, read_payloads

OPTS = PackOptions(max_bytes=3000, max_logs=20, source="s", hostname="")


def sample(seed=3, n=200):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        pairs = [
            (rng.choice(["a", "é", "", "long key"]), "日x " * rng.choice([0, 1, 30, 300]))
            for _ in range(rng.randint(0, 4))
        ]
        time = rng.choice([0, -1, 127, 128, 2**40])
        rows.append(
            (rng.choice(["t", ""]), "main", seq, seq, time, pairs, rng.choice([None, 0, 99]))
        )
    return rows


@pytest.mark.parametrize("compress_type", codecs.CODECS)
def test_round_trip(spark, compress_type):
    logs = spark.createDataFrame(sample(), LOGS)
    packed = pack_logs(logs, OPTS)
    stamped = stamp_group(packed, source="s", hostname="", filename="f", tags={"k": "v", "": "w"})
    encoded = encode_packages(stamped, compress_type, OPTS).withColumnRenamed(
        "package_id", "payload_id"
    )
    back = decode_payloads(encoded)
    kept = ["time", "contents", "collect_time"]
    got = sorted(map(repr, back.select("payload_id", *kept).collect()))
    expected = sorted(
        map(repr, packed.select(F.col("package_id").alias("payload_id"), *kept).collect())
    )
    assert got == expected
    meta = back.select(
        "context_flow", "payload_id", "filename", "source", "hostname", "tags", "_corrupt"
    ).distinct()
    for row in meta.collect():
        assert row.context_flow == row.payload_id and row._corrupt is None
        assert (row.filename, row.source, row.hostname) == ("f", "s", "")
        assert [tuple(t) for t in row.tags] == [("k", "v"), ("", "w")]


def test_bytes_equal_those_of_protobuf(spark):
    descriptor_pb2 = pytest.importorskip("google.protobuf.descriptor_pb2")
    from google.protobuf import descriptor_pool, message_factory

    kinds = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="t.proto", package="t", syntax="proto2")

    def message(name, fields):
        made = file.message_type.add(name=name)
        for number, (field, label, kind) in enumerate(fields, 1):
            added = made.field.add(name=field, number=number, label=label)
            if isinstance(kind, str):
                added.type, added.type_name = kinds.TYPE_MESSAGE, f".t.{kind}"
            else:
                added.type = kind

    optional, required, repeated = 1, 2, 3
    text, number = kinds.TYPE_STRING, kinds.TYPE_INT64
    message("Pair", [("key", required, text), ("value", required, text)])
    message(
        "Log",
        [("time", required, number), ("contents", repeated, "Pair"), ("collect", optional, number)],
    )
    names = ["context", "filename", "source"]
    message(
        "Group",
        [("logs", repeated, "Log")]
        + [(n, optional, text) for n in names]
        + [("tags", repeated, "Pair"), ("hostname", optional, text)],
    )
    message("Request", [("groups", repeated, "Group")])
    pool = descriptor_pool.DescriptorPool()
    pool.Add(file)
    request_class = message_factory.GetMessageClass(pool.FindMessageTypeByName("t.Request"))

    packed = pack_logs(spark.createDataFrame(sample(), LOGS), OPTS).cache()
    payloads = {r.package_id: r.payload for r in encode_packages(packed, "none", OPTS).collect()}
    expected = {name: request_class() for name in payloads}
    for row in packed.orderBy("arrival_ms", "seq").collect():
        request = expected[row.package_id]
        group = request.groups[0] if request.groups else request.groups.add()
        group.context, group.source, group.hostname = row.package_id, "s", ""
        log = group.logs.add(time=row.time)
        if row.collect_time is not None:
            log.collect = row.collect_time
        for pair in row.contents:
            log.contents.add(key=pair.key, value=pair.value)
    assert len(payloads) > 3
    for name, request in expected.items():
        assert bytes(payloads[name]) == request.SerializeToString()


def field(tag, body):
    return bytes([tag, len(body)]) + body


PAIR = field(0x0A, b"k") + field(0x12, b"v")
GOOD_LOG = b"\x08\x05" + field(0x12, PAIR)
CASES = {
    "good": (field(0x0A, field(0x0A, GOOD_LOG)), 1, None),
    "empty body": (b"", 0, None),
    "unknown fields": (
        field(0x0A, field(0x0A, GOOD_LOG + b"\x28\x01" + field(0x7A, b"x")) + b"\x3d1234"),
        1,
        None,
    ),
    "cut off": (field(0x0A, field(0x0A, GOOD_LOG))[:-1], 1, "cut off"),
    "wrong wire type": (field(0x0A, field(0x0A, b"\x0a\x01x")), 1, "unexpected field"),
    "no time": (field(0x0A, field(0x0A, field(0x12, PAIR))), 1, "without time"),
    "no value": (field(0x0A, field(0x0A, b"\x08\x05" + field(0x12, field(0x0A, b"k")))), 1, "pair"),
    "endless number": (b"\x0a" + b"\xff" * 12, 1, "too long"),
    "group end": (b"\x0c", 1, "unexpected field"),
}


def test_payloads_that_are_odd_or_bad(spark):
    rows = [(name, "none", bytearray(case[0])) for name, case in CASES.items()]
    rows += [("no payload", "none", None), ("zstd noise", "zstd", bytearray(b"noise"))]
    rows += [("codec", "snappy", bytearray(b"x"))]
    frame = spark.createDataFrame(rows, "payload_id string, compress_type string, payload binary")
    got = decode_payloads(frame).collect()
    for name, (_, count, why) in CASES.items():
        found = [r for r in got if r.payload_id == name]
        assert len(found) == count, name
        for row in found:
            if why is None:
                assert row._corrupt is None and row.time == 5
                assert [tuple(p) for p in row.contents] == [("k", "v")]
            else:
                assert why in row._corrupt and row.time is None
    for name in ("no payload", "zstd noise", "codec"):
        assert [r._corrupt is not None for r in got if r.payload_id == name] == [True]


def test_negative_and_large_numbers():
    body = field(0x0A, field(0x0A, b"\x08" + b"\xff" * 9 + b"\x01"))
    assert [log["time"] for log in decode_request(body)] == [-1]


@pytest.mark.parametrize("size", [0, 1, 14, 15, 16, 254, 270, 5000, 200_000])
@pytest.mark.parametrize("kind", ["noise", "runs", "text"])
def test_codecs_round_trip(size, kind):
    rng = random.Random(size)
    data = {
        "noise": bytes(rng.randrange(256) for _ in range(size)),
        "runs": b"a" * size,
        "text": (b"the quick brown fox %d " * (size // 20 + 1))[:size],
    }[kind]
    for name in codecs.CODECS:
        packed = codecs.compressor(name)(data)
        assert codecs.expand(name, packed) == data, name
    if data:
        assert codecs.lz4_length(codecs.compressor("lz4")(data)) == len(data)


def test_unknown_codec_is_an_error(spark):
    with pytest.raises(ValueError, match="snappy"):
        codecs.compress(F.lit(b""), "snappy")


def test_read_files(spark, tmp_path):
    for number in range(3):
        body = codecs.compressor("deflate")(CASES["good"][0])
        (tmp_path / f"{number}.bin").write_bytes(body)
    (tmp_path / "bad.bin").write_bytes(b"\x01\x02")
    logs = read_payloads(spark, str(tmp_path), "files", "deflate")
    assert logs.filter("_corrupt IS NULL").count() == 3
    assert logs.filter("_corrupt IS NOT NULL").count() == 1


def test_incomplete_log_is_not_encoded(spark):
    logs = spark.createDataFrame([("t", "main", 1, 1, None, [("k", "v")], None)], LOGS)
    with pytest.raises(Exception, match="reject_incomplete"):
        encode_packages(pack_logs(logs, OPTS), "none", OPTS).collect()
