"""From packed logs to packages, requests and encoded payloads."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logfreight.functions import codecs, wire
from logfreight.functions.sizes import field_size, group_wire_size
from logfreight.model import MAX_REQUEST_BYTES, MAX_REQUEST_LOGS, PAIRS, PackOptions
from logfreight.operators.validate import check_request_groups
from logfreight.session import written_table

METADATA = ["source", "hostname", "filename", "tags"]
PACKAGE = ["package_id", "topic_id"]
ORDER = ["arrival_ms", "seq", "position"]


def stamp_group(
    df: DataFrame,
    source: str | None = "",
    hostname: str = "",
    filename: str | None = None,
    tags: Mapping[str, str] | None = None,
    direct: bool = False,
) -> DataFrame:
    """Set the metadata of packages.

    Packed logs always carry a source and a host name, empty ones included. Requests
    sent directly (``direct``) keep their own source unless one is given, and get a host
    name only if it is not empty.
    """

    def present(name: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast("string")

    if direct:
        new_source = present("source") if source is None else F.lit(source)
        new_host = F.lit(hostname) if hostname else present("hostname")
    else:
        new_source, new_host = F.lit(source or ""), F.lit(hostname)
    pairs = F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.lit(value).alias("value"))
            for key, value in (tags or {}).items()
        ]
    )
    return df.withColumns(
        {
            "source": new_source,
            "hostname": new_host,
            "filename": present("filename") if filename is None else F.lit(filename),
            "tags": pairs.cast(PAIRS),
        }
    )


def _with_metadata(df: DataFrame, opts: PackOptions) -> DataFrame:
    plain = {
        "source": F.lit(opts.source),
        "hostname": F.lit(opts.hostname),
        "filename": F.lit(None).cast("string"),
        "tags": F.array().cast(PAIRS),
    }
    return df.withColumns({k: v for k, v in plain.items() if k not in df.columns})


def assemble_groups(packed: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """One row per package with its logs as an ordered array.

    Packages are bounded by the limits they were packed with, so the arrays are too.
    """
    packed = _with_metadata(packed, opts)
    log = F.struct("time", "contents", "collect_time").alias("log")
    collected = packed.groupBy("package_id", "topic_id").agg(
        F.array_sort(F.collect_list(F.struct(*[n for n in ORDER if n in packed.columns], log))).alias("_logs"),
        *[F.first(name).alias(name) for name in METADATA],
    )
    logs = F.transform("_logs", lambda entry: entry["log"])
    return collected.select(
        "package_id",
        "topic_id",
        F.col("package_id").alias("context_flow"),
        *METADATA,
        logs.alias("logs"),
    )


def group_sizes(groups: DataFrame) -> DataFrame:
    """Exact encoded size of packages held as rows."""
    return groups.withColumn("wire_bytes", F.expr(group_wire_size()))


def assemble_requests(
    groups: DataFrame,
    by: Sequence[str],
    order: str,
    max_bytes: int = MAX_REQUEST_BYTES,
    max_logs: int = MAX_REQUEST_LOGS,
) -> tuple[DataFrame, DataFrame]:
    """(requests, rejected): the groups of each request as one row.

    The limits on requests are tested first, so that no request grows without bound;
    the requests over them are returned with the reason.
    """
    logs = groups.select(*by, order, F.explode("logs").alias("_log"))
    logs = logs.select(*by, order, F.col("_log.contents").alias("contents"))
    judged = check_request_groups(logs, by, order, max_bytes, max_logs)
    rejected = judged.filter(~F.col("accepted"))
    others = [name for name in groups.columns if name not in by]
    kept = groups.join(rejected.select(*by), list(by), "left_anti")
    entry = F.struct(order, F.struct(*others).alias("group"))
    requests = kept.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_groups"))
    ordered = F.transform("_groups", lambda e: e["group"]).alias("groups")
    return requests.select(*by, ordered), rejected


def _checked_log(df: DataFrame) -> Column:
    complete = F.col("time").isNotNull() & ~F.exists(
        F.coalesce("contents", F.array().cast(PAIRS)),
        lambda pair: pair["key"].isNull() | pair["value"].isNull(),
    )
    body = F.expr(wire.log_hex())
    failure = F.raise_error(F.lit("log without time, key or value: apply reject_incomplete"))
    return F.when(complete, body).otherwise(failure.cast("string"))


def encode_packages(
    packed: DataFrame, compress_type: str = codecs.LZ4, opts: PackOptions = PackOptions()
) -> DataFrame:
    """One payload per package: a request holding that one package, then compressed."""
    return _compressed(raw_packages(packed, opts), PACKAGE, compress_type)


def encode_variants(
    packed: DataFrame, compress_types: Sequence[str], opts: PackOptions = PackOptions()
) -> DataFrame:
    """The payloads of ``encode_packages`` in several codecs; packages are put together once."""
    raw = written_table(raw_packages(packed, opts))
    kinds = [_compressed(raw, PACKAGE, compress_type) for compress_type in compress_types]
    return functools.reduce(DataFrame.unionByName, kinds)


def raw_packages(packed: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """package_id, topic_id and ``_raw``, the request that holds the package, not compressed.

    Logs are encoded where they are and shuffled once, by package, as bytes.
    """
    packed = _with_metadata(packed, opts)
    order = ", ".join(name for name in ORDER if name in packed.columns)
    # Each body is a column before it is used: the field around it mentions it repeatedly.
    bodies = packed.withColumn("_body", _checked_log(packed))
    encoded = bodies.withColumn("_log", F.expr(wire.group_log_bytes("_body")))
    collected = encoded.groupBy("package_id", "topic_id").agg(
        F.expr(f"listagg(_log) WITHIN GROUP (ORDER BY {order})").alias("_logs"),
        *[F.first(name).alias(name) for name in METADATA],
    )
    metadata = wire.metadata_hex("package_id")
    groups = collected.selectExpr(*PACKAGE, f"concat(_logs, unhex({metadata})) AS _group")
    return groups.selectExpr(*PACKAGE, f"{wire.request_of('_group')} AS _raw")


def encode_requests(requests: DataFrame, by: Sequence[str], compress_type: str = codecs.LZ4):
    """One payload per row of ``assemble_requests``."""
    raw = requests.selectExpr(*by, f"{wire.request_bytes('groups')} AS _raw")
    return _compressed(raw, by, compress_type)


def _compressed(raw: DataFrame, keys: Sequence[str], compress_type: str) -> DataFrame:
    payloads = raw.select(
        *keys,
        F.lit(codecs.known(compress_type)).alias("compress_type"),
        F.length("_raw").cast("long").alias("raw_bytes"),
        codecs.compress(F.col("_raw"), compress_type).alias("payload"),
    )
    return payloads.withColumn("payload_bytes", F.length("payload").cast("long"))


def request_sizes(groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Exact encoded size of requests from the sizes of their groups."""
    return groups.groupBy(*by).agg(F.sum(F.expr(field_size("wire_bytes"))).alias("request_bytes"))


def payload_stats(outbox: DataFrame) -> DataFrame:
    """Raw and compressed bytes by topic and compression."""
    return (
        outbox.groupBy("topic_id", "compress_type")
        .agg(
            F.count("*").alias("packages"),
            F.sum("raw_bytes").alias("raw_bytes"),
            F.sum("payload_bytes").alias("payload_bytes"),
        )
        .withColumn("ratio", F.col("raw_bytes") / F.col("payload_bytes"))
    )
