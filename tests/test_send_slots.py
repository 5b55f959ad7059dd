"""Many parts, few of them sent at a time: in waves here, by slots on a cluster of processes."""

import os
import pathlib
import subprocess
import sys

import pyspark
import pytest

from logfreight.model import ATTEMPTS, OUTBOX, DeliveryOptions
from logfreight.operators.send import _parts_of, deliver, drain, read_attempts, send_slots

ROOT = pathlib.Path(__file__).resolve().parent.parent


def boxes(spark, n):
    rows = [(f"p{i}", "none", 10, 10, f"{i:010d}".encode(), "t") for i in range(n)]
    return spark.createDataFrame(rows, OUTBOX)


def logged(folder):
    """A send function that logs begin and end of every send, by process."""

    def send(topic_id, payload, compress_type):
        import time

        with open(f"{folder}/{os.getpid()}", "a") as log:
            begin = time.time_ns()
            time.sleep(0.01)
            log.write(f"{payload.decode()} {begin} {time.time_ns()}\n")
        return 200, "id", ""

    return send


def sends(folder):
    rows = [line.split() for path in pathlib.Path(folder).iterdir() for line in path.read_text().splitlines()]
    return [(name, int(begin), int(end)) for name, begin, end in rows]


def most_at_a_time(rows):
    moves = sorted([(begin, 1) for _, begin, _ in rows] + [(end, -1) for _, _, end in rows])
    now = most = 0
    for _, move in moves:
        now += move
        most = max(most, now)
    return most


def test_parts_follow_bytes_and_waves_bound_senders(spark, tmp_path):
    (tmp_path / "log").mkdir()
    opts = DeliveryOptions(workers=3, task_bytes=100)
    box = boxes(spark, 200)
    assert _parts_of(box, opts) == 20 and _parts_of(box, DeliveryOptions(workers=7)) == 7
    assert _parts_of(box.drop("payload_bytes"), opts) == 20
    sent = deliver(box, logged(tmp_path / "log"), f"{tmp_path}/attempts", 4, opts)
    assert sorted(r.package_id for r in sent.collect()) == sorted(f"p{i}" for i in range(200))
    rows = sends(tmp_path / "log")
    assert len(rows) == 200 and most_at_a_time(rows) <= 3
    assert len(list((tmp_path / "attempts" / "pass_id=4").glob("wave=*"))) == 7
    # The pass again, with fewer waves: nothing of the first try is left.
    deliver(box.limit(5), logged(tmp_path / "log"), f"{tmp_path}/attempts", 4, opts)
    assert read_attempts(spark, f"{tmp_path}/attempts").count() == 5
    assert send_slots(spark, 3) is None


def test_empty_and_null_payloads(spark, tmp_path):
    opts = DeliveryOptions(workers=2, task_bytes=1)
    assert deliver(boxes(spark, 1).limit(0), logged(tmp_path), f"{tmp_path}/a", 0, opts).count() == 0


@pytest.mark.parametrize("deadline, left", [(10**18, 0), (0, 3)])
def test_drain(spark, tmp_path, deadline, left):
    def refuse_twice(topic_id, payload, compress_type):
        with open(f"{tmp_path}/{payload.decode()}", "a") as log:
            log.write("x")
        return 200 if os.path.getsize(f"{tmp_path}/{payload.decode()}") > 2 else 503, "id", "{}"

    opts = DeliveryOptions(workers=2, backoff_ms=10**9)
    none = spark.createDataFrame([], ATTEMPTS)
    attempts, unsent = drain(boxes(spark, 3), none, refuse_twice, f"{tmp_path}/a", 0, deadline, opts)
    assert unsent.count() == left
    assert attempts.count() == (0 if left else 9)


CLUSTER = """
import os, pathlib, sys
from pyspark.sql import SparkSession
from pyspark import TaskContext
from logfreight.model import OUTBOX, DeliveryOptions
from logfreight.operators.send import deliver, send_slots
from logfreight.session import prepare

where = sys.argv[1]
spark = (
    SparkSession.builder.master("local-cluster[2,2,1024]").config("spark.checkpoint.dir", f"file://{where}/shared")
    .config("spark.ui.enabled", "false").config("spark.executor.memory", "512m").config("spark.driver.host", "127.0.0.1")
    .config("spark.python.worker.reuse", "false").config("spark.executorEnv.TMPDIR", where).getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
prepare(spark)

def send(topic_id, payload, compress_type):
    import time
    task = TaskContext.get()
    with open(f"{where}/log/{os.getpid()}", "a") as log:
        begin = time.time_ns()
        time.sleep(0.02)
        log.write(f"{payload.decode()} {begin} {time.time_ns()}\\n")
    if payload.endswith(b"42") and task.attemptNumber() == 0:
        pathlib.Path(f"{where}/part").write_text(str(task.partitionId()))
        os._exit(1)
    return 200, "id", ""

rows = [(f"p{i}", "none", 10, 10, f"{i:010d}".encode(), "t") for i in range(100)]
box = spark.createDataFrame(rows, OUTBOX)
opts = DeliveryOptions(workers=2, task_bytes=50)
assert send_slots(spark, 2) is not None and send_slots(spark, 1) is None
sent = deliver(box, send, f"file://{where}/attempts", 0, opts)
assert sorted(r.package_id for r in sent.collect()) == sorted(r[0] for r in rows)
spark.stop()
"""


def test_slots_on_executors_and_a_lost_task(tmp_path):
    for name in ("home/work", "log", "shared"):
        (tmp_path / name).mkdir(parents=True)
    for path in pathlib.Path(pyspark.__file__).parent.iterdir():  # executors write beside Spark's files
        if path.name != "work":
            (tmp_path / "home" / path.name).symlink_to(path)
    env = os.environ | {"SPARK_HOME": f"{tmp_path}/home", "SPARK_SCALA_VERSION": "2.13", "PYTHONPATH": str(ROOT), "SPARK_LOCAL_IP": "127.0.0.1",
                        "SPARK_LOCAL_DIRS": f"{tmp_path}/local", "PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([sys.executable, "-c", CLUSTER, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-3000:]
    rows = sends(tmp_path / "log")
    assert most_at_a_time(rows) == 2  # of the four cores
    names = [name for name, *_ in rows]
    twice = {name for name in names if names.count(name) > 1}
    # Only what the lost task had sent is sent again: packages of one part of twenty.
    assert "0000000042" in twice and len(twice) <= 15 and set(names) == {f"{i:010d}" for i in range(100)}
    assert len(names) == 100 + len(twice)
