"""The streaming packers against the batch packer, with the input in one or many files."""

import pytest
from pyspark.sql import functions as F

from logfreight.model import LOGS, PackOptions
from logfreight.operators.pack import pack_logs
from logfreight.plans.sample_tables import as_event_logs, event_logs, table
from logfreight.streaming import carried, microbatch, stateful

OPTS = PackOptions(max_bytes=200, cap_bytes=230, max_logs=6, linger_ms=10_800_000)


def write_in_files(spark, logs, path, files):
    """The logs in arrival order, a later file never older than an earlier one."""
    ranked = logs.selectExpr("*", f"ntile({files}) over (order by arrival_ms, seq) AS file")
    ranked = ranked.cache()
    for file in range(1, files + 1):
        part = ranked.filter(F.col("file") == file).drop("file").coalesce(1)
        part.write.mode("append").parquet(path)
    ranked.unpersist()


def stream_of(spark, path):
    return spark.readStream.schema(LOGS).option("maxFilesPerTrigger", 1).parquet(path)


def packages(df):
    """The set of packages as sets of logs, and the row count."""
    rows = df.groupBy("topic_id", "package_id").agg(F.sort_array(F.collect_list("seq")).alias("s"))
    return sorted((r.topic_id, tuple(r.s)) for r in rows.collect())


def drained(packed, tmp_path):
    query = (
        packed.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(240)
    assert query.exception() is None
    return query


@pytest.mark.parametrize("files", [1, 3])
def test_stateful_equals_batch(spark, folder, tmp_path, files):
    logs = event_logs(spark, folder)
    write_in_files(spark, logs, f"{tmp_path}/in", files)
    packed = stateful.pack_stream(stream_of(spark, f"{tmp_path}/in"), OPTS)
    query = drained(packed, tmp_path)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == files
    stateful.flush_rows(logs).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    drained(packed, tmp_path)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == logs.count()
    assert packages(out) == packages(pack_logs(logs, OPTS))
    same = out.join(logs, ["topic_id", "seq"]).filter(out.contents == logs.contents)
    assert same.count() == logs.count()


@pytest.mark.parametrize("files", [1, 4])
def test_open_packages_come_from_the_state(spark, folder, tmp_path, files):
    logs = event_logs(spark, folder)
    write_in_files(spark, logs, f"{tmp_path}/in", files)
    packed = stateful.pack_stream(stream_of(spark, f"{tmp_path}/in"), OPTS)
    drained(packed, tmp_path)
    closed = spark.read.schema(packed.schema).parquet(f"{tmp_path}/out")
    still_open = stateful.open_packages(spark, f"{tmp_path}/state", OPTS)
    assert still_open.schema.fieldNames() == closed.schema.fieldNames()
    assert still_open.count() > 0 and closed.filter("close_reason = 'flush'").count() == 0
    every = closed.unionByName(still_open)
    assert every.count() == logs.count()
    assert packages(every) == packages(pack_logs(logs, OPTS))
    same = every.join(logs, ["topic_id", "seq"]).filter(every.contents == logs.contents)
    assert same.count() == logs.count()
    # Reading changes nothing: the stream goes on and gives the same packages, under the same ids.
    before = {(r.seq, r.package_id, r.create_ms) for r in still_open.select("seq", "package_id", "create_ms").collect()}
    stateful.flush_rows(logs).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    drained(stateful.pack_stream(stream_of(spark, f"{tmp_path}/in"), OPTS), tmp_path)
    out = spark.read.schema(packed.schema).parquet(f"{tmp_path}/out")
    flushed = out.filter("close_reason = 'flush'")
    assert {(r.seq, r.package_id, r.create_ms) for r in flushed.select("seq", "package_id", "create_ms").collect()} == before
    assert stateful.open_packages(spark, f"{tmp_path}/state", OPTS).count() == 0
    # One run over two starts of the query.
    assert out.select(F.substring("package_id", 17, 8)).distinct().count() == 1


def test_stateful_packs_late_logs_and_logs_after_a_flush(spark, folder, tmp_path):
    logs = event_logs(spark, folder)
    late = F.col("seq") % 5 == 0
    write_in_files(spark, logs.filter(~late), f"{tmp_path}/in", 2)
    packed = stateful.pack_stream(stream_of(spark, f"{tmp_path}/in"), OPTS, delay_ms=0)
    drained(packed, tmp_path)
    for part in (logs.filter(late & (F.col("seq") % 2 == 0)), stateful.flush_rows(logs), logs.filter(late & (F.col("seq") % 2 == 1)), stateful.flush_rows(logs)):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        drained(packed, tmp_path)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == logs.count()
    assert out.select("seq").distinct().count() == logs.count()
    assert out.groupBy("package_id").agg(F.sum("n_logs").alias("n")).filter(F.col("n") > OPTS.max_logs).count() == 0


@pytest.mark.parametrize("files", [1, 4])
def test_carried_equals_batch(spark, folder, tmp_path, files):
    logs = event_logs(spark, folder)
    write_in_files(spark, logs, f"{tmp_path}/in", files)
    query = carried.pack_stream_carried(
        stream_of(spark, f"{tmp_path}/in"),
        f"{tmp_path}/out",
        f"{tmp_path}/state",
        OPTS,
        available_now=True,
    )
    query.awaitTermination(240)
    assert query.exception() is None
    out = carried.read_packed(spark, f"{tmp_path}/out", ended=True)
    assert out.count() == logs.count()
    assert packages(out) == packages(pack_logs(logs, OPTS))
    closed = carried.read_packed(spark, f"{tmp_path}/out")
    assert 0 < closed.count() <= logs.count()
    assert closed.filter("close_reason = 'flush'").count() == 0


def test_microbatch_closes_every_batch(spark, folder, tmp_path):
    logs = event_logs(spark, folder)
    write_in_files(spark, logs, f"{tmp_path}/in", 2)
    query = microbatch.pack_stream_microbatch(
        stream_of(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state", OPTS, True
    )
    query.awaitTermination(240)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == logs.count()
    spread = out.groupBy("package_id").agg(F.countDistinct("batch_id").alias("n"))
    assert spread.filter("n > 1").count() == 0


def test_outbox_stream_keeps_every_log(spark, folder, tmp_path):
    from logfreight.sources.payloads import read_payloads

    logs = event_logs(spark, folder)
    broken = logs.withColumn("time", F.when(F.col("seq") % 10 != 0, F.col("time")))
    write_in_files(spark, broken, f"{tmp_path}/in", 2)
    query = microbatch.outbox_stream(
        stream_of(spark, f"{tmp_path}/in"),
        f"{tmp_path}/outbox",
        f"{tmp_path}/rejected",
        f"{tmp_path}/state",
        OPTS,
        available_now=True,
    )
    query.awaitTermination(240)
    sent = read_payloads(spark, f"{tmp_path}/outbox")
    rejected = spark.read.parquet(f"{tmp_path}/rejected")
    assert sent.filter("_corrupt IS NOT NULL").count() == 0
    assert sent.count() + rejected.count() == logs.count()
    assert {r.reason for r in rejected.select("reason").distinct().collect()} == {"missing_time"}


def test_processing_time_closes_by_the_clock(spark, folder, tmp_path):
    import time

    logs = event_logs(spark, folder).filter("seq < 100")
    opts = PackOptions(max_bytes=200, cap_bytes=230, max_logs=6, linger_ms=2_000)
    squeezed = logs.withColumn("arrival_ms", F.col("seq"))
    write_in_files(spark, squeezed, f"{tmp_path}/in", 2)
    packed = stateful.pack_stream(
        stream_of(spark, f"{tmp_path}/in"), opts, stateful.PROCESSING_TIME
    )
    query = (
        packed.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(processingTime="1 second")
        .start()
    )
    end = time.monotonic() + 120
    seen = 0
    try:
        while seen < 100 and time.monotonic() < end and query.isActive:
            time.sleep(2)
            if list((tmp_path / "out").glob("part-*")):
                seen = spark.read.schema(packed.schema).parquet(f"{tmp_path}/out").count()
    finally:
        query.stop()
    assert query.exception() is None
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 100 and out.select("seq").distinct().count() == 100
    reasons = {r.close_reason for r in out.select("close_reason").distinct().collect()}
    assert "linger" in reasons and "flush" not in reasons


def test_ticks_end_behind_the_watermark(spark, folder):
    """They move the watermark and are neither shuffled nor handed to Python."""
    events = spark.readStream.schema(table(spark, folder, "events").schema).parquet(f"{folder}/event[s].parquet")
    packed = stateful.pack_stream(as_event_logs(events))
    plan = packed._jdf.queryExecution().analyzed().toString()
    lines = [line for line in plan.splitlines() if "Filter isnull(event_ts" in line or "EventTimeWatermark" in line]
    assert "Filter isnull(event_ts" in lines[0] and "EventTimeWatermark" in lines[1]
