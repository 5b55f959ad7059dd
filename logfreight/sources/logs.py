"""Turning tables and streams into log rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logfreight.model import PAIRS


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _log_rows(
    df: DataFrame,
    contents: Column,
    topic: Column | str,
    time: Column | str,
    arrival: Column | str,
    seq: Column | str,
    producer: Column | str | None,
    producer_shards: int,
    collect_time: Column | str | None,
) -> DataFrame:
    name = F.lit("main") if producer is None else _column(producer)
    if producer_shards > 1:
        shard = F.pmod(F.xxhash64(_column(seq)), F.lit(producer_shards))
        name = F.concat(name, F.lit("-"), shard.cast("string"))
    collected = F.lit(None) if collect_time is None else _column(collect_time)
    return df.select(
        F.coalesce(_column(topic), F.lit("")).alias("topic_id"),
        name.alias("producer"),
        _column(seq).cast("long").alias("seq"),
        _column(arrival).cast("long").alias("arrival_ms"),
        _column(time).cast("long").alias("time"),
        contents.alias("contents"),
        collected.cast("long").alias("collect_time"),
    )


def logs_from_columns(
    df: DataFrame,
    topic: Column | str,
    time: Column | str,
    contents: Mapping[str, Column | str] | list[str],
    arrival: Column | str,
    seq: Column | str,
    producer: Column | str | None = None,
    producer_shards: int = 1,
    collect_time: Column | str | None = None,
) -> DataFrame:
    """Each named content column becomes a pair of key and text, nulls none at all.

    ``producer_shards`` deals the rows out to that many packers, as several clients of
    one topic would.
    """
    if not isinstance(contents, Mapping):
        contents = {name: name for name in contents}
    pairs = F.array(
        *[
            F.struct(F.lit(key).alias("key"), _column(value).cast("string").alias("value"))
            for key, value in contents.items()
        ]
    )
    pairs = F.filter(pairs, lambda pair: pair["value"].isNotNull()).cast(PAIRS)
    return _log_rows(
        df, pairs, topic, time, arrival, seq, producer, producer_shards, collect_time
    )


def logs_from_map(
    df: DataFrame,
    map_col: Column | str,
    topic: Column | str,
    time: Column | str,
    arrival: Column | str,
    seq: Column | str,
    producer: Column | str | None = None,
    producer_shards: int = 1,
    collect_time: Column | str | None = None,
) -> DataFrame:
    """The entries of a map column become the pairs, in key order, nulls none at all."""
    pairs = F.array_sort(F.map_entries(_column(map_col)))
    pairs = F.filter(pairs, lambda pair: pair["value"].isNotNull())
    pairs = F.transform(
        pairs,
        lambda pair: F.struct(
            pair["key"].cast("string").alias("key"), pair["value"].cast("string").alias("value")
        ),
    )
    return _log_rows(
        df, pairs, topic, time, arrival, seq, producer, producer_shards, collect_time
    )


def with_defaults(logs: DataFrame) -> DataFrame:
    """Absent optional fields read as 0, empty text or an empty list."""
    plain = {
        "time": F.lit(0).cast("long"),
        "collect_time": F.lit(0).cast("long"),
        "source": F.lit(""),
        "hostname": F.lit(""),
        "filename": F.lit(""),
        "context_flow": F.lit(""),
    }
    out = logs
    for name, value in plain.items():
        if name in logs.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), value))
    for name in ("contents", "tags"):
        if name in logs.columns:
            filled = F.transform(
                F.coalesce(F.col(name), F.array().cast(PAIRS)),
                lambda pair: F.struct(
                    F.coalesce(pair["key"], F.lit("")).alias("key"),
                    F.coalesce(pair["value"], F.lit("")).alias("value"),
                ),
            )
            out = out.withColumn(name, filled)
    return out


def arrival_ms(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a timestamp, rounded down; the session is in UTC."""
    return F.unix_millis(_column(ts).cast("timestamp"))
