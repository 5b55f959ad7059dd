"""The outbox as a data source: batches once, filters pushed, streams replayed."""

import pathlib

import pytest
from pyspark.sql import functions as F

from logfreight.model import OUTBOX
from logfreight.sources import outbox_source


@pytest.fixture
def source(spark):
    outbox_source.register_outbox(spark)
    return spark


def boxes(spark, first, many):
    rows = [(f"p{i}", "none", i, i, bytes([i % 256]) * i, f"t{i % 3}" if i % 7 else "") for i in range(first, first + many)]
    return spark.createDataFrame(rows, OUTBOX)


def put(df, where, batch):
    df.repartition(3).write.format("outbox").mode("append").option("batch", batch).save(str(where))


def get(spark, where):
    return spark.read.format("outbox").load(str(where))


def test_what_is_written_is_read(source, tmp_path):
    put(boxes(source, 0, 50), tmp_path, 3)
    put(boxes(source, 50, 20), tmp_path, 4)
    read = get(source, tmp_path)
    want = boxes(source, 0, 50).withColumn("batch_id", F.lit(3).cast("long")).union(boxes(source, 50, 20).withColumn("batch_id", F.lit(4).cast("long")))
    assert read.schema.fieldNames() == want.schema.fieldNames()
    assert sorted(read.collect()) == sorted(want.collect())


def test_a_batch_is_there_once(source, tmp_path):
    put(boxes(source, 0, 30), tmp_path, 0)
    files = set((tmp_path / "data").iterdir())
    put(boxes(source, 0, 30), tmp_path, 0)
    assert get(source, tmp_path).count() == 30
    assert set((tmp_path / "data").iterdir()) == files


def test_a_failed_write_leaves_nothing_visible(source, tmp_path):
    @F.udf("string")
    def broken(package_id):
        raise ValueError("broken")

    with pytest.raises(Exception, match="broken"):
        put(boxes(source, 0, 30).withColumn("package_id", broken("package_id")), tmp_path, 0)
    assert get(source, tmp_path).count() == 0
    with pytest.raises(Exception, match="appended"):
        boxes(source, 0, 3).write.format("outbox").mode("overwrite").option("batch", 1).save(str(tmp_path))


def test_filters_rule_files_out(source, tmp_path):
    for batch in range(3):
        put(boxes(source, 40 * batch, 40), tmp_path, batch)
    every = get(source, tmp_path)
    assert every.rdd.getNumPartitions() > 9
    for condition in ("topic_id = 't1'", "batch_id = 1 AND topic_id IN ('t0', '')", "batch_id > 1", "batch_id <= 0 AND raw_bytes > 5"):
        few = every.filter(condition)
        assert few.rdd.getNumPartitions() < every.rdd.getNumPartitions()
        assert sorted(few.collect()) == sorted(source.createDataFrame(every.collect(), every.schema).filter(condition).collect())
    plan = every.filter("topic_id = 't1' AND raw_bytes > 5")._jdf.queryExecution().executedPlan().toString()
    # What the reader takes over is no filter of the plan any more; the rest is.
    assert "> 5" in plan.split("BatchScan")[0] and "= t1" not in plan.split("BatchScan")[0]
    assert every.filter("topic_id = 'none such'").count() == 0


def test_a_stream_that_is_replayed(source, tmp_path):
    for part in range(3):
        boxes(source, 20 * part, 20).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = source.readStream.schema(OUTBOX).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

    def run():
        query = (
            stream.writeStream.format("outbox").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination(240)
        assert query.exception() is None

    run()
    assert get(source, f"{tmp_path}/out").groupBy("batch_id").count().count() == 3
    # The commit of the last batch is lost: it is processed again under the same number.
    commits = sorted(p for p in pathlib.Path(f"{tmp_path}/state/commits").iterdir() if p.name.isdigit())
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    read = get(source, f"{tmp_path}/out")
    assert read.count() == 60 and read.select("package_id").distinct().count() == 60


def test_many_topics_in_little_memory(source, tmp_path, monkeypatch):
    writer = outbox_source._Writer(str(tmp_path))
    monkeypatch.setattr(outbox_source, "HELD_BYTES", 3000)
    rows = boxes(source, 0, 60).collect()
    told = writer.write(iter(rows))
    assert sum(f["rows"] for f in told.files) == 60 and len(told.files) > 4
    writer.publish([told, None], 9)
    assert sorted(get(source, tmp_path).drop("batch_id").collect()) == sorted(rows)
