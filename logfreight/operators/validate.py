"""Setting aside logs and requests that break the rules. Nothing is dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logfreight.functions.sizes import log_size
from logfreight.model import MAX_REQUEST_BYTES, MAX_REQUEST_LOGS, MAX_VALUE_BYTES
from logfreight.plans.ordered import range_ordered, read_once, running_sums


def has_oversize_value(contents: Column, max_value_bytes: int = MAX_VALUE_BYTES) -> Column:
    over = F.exists(contents, lambda pair: F.octet_length(pair["value"]) > max_value_bytes)
    return F.coalesce(over, F.lit(False))


def _split(logs: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    judged = logs.withColumn("reason", reason)
    accepted = judged.filter(F.col("reason").isNull()).drop("reason")
    return accepted, judged.filter(F.col("reason").isNotNull())


def reject_oversize(
    logs: DataFrame, max_value_bytes: int = MAX_VALUE_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a log is rejected if a single value is over the limit."""
    over = has_oversize_value(F.col("contents"), max_value_bytes)
    return _split(logs, F.when(over, "value_too_large"))


def reject_incomplete(logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a log needs a place (producer, topic, arrival, number) and a time,
    and every pair a key and a value."""
    place = [F.col(n).isNull() for n in ("producer", "topic_id", "arrival_ms", "seq")]
    reason = (
        F.when(place[0] | place[1] | place[2] | place[3], "missing_place")
        .when(F.col("time").isNull(), "missing_time")
        .when(F.exists("contents", lambda pair: pair["key"].isNull()), "missing_key")
        .when(F.exists("contents", lambda pair: pair["value"].isNull()), "missing_value")
    )
    return _split(logs, reason)


def log_list_size(logs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Accounting size of lists of logs."""
    return logs.groupBy(*by).agg(F.sum(F.expr(log_size())).alias("size_bytes"))


def _measured(logs: DataFrame, by: Sequence[str], max_value_bytes: int) -> DataFrame:
    over = has_oversize_value(F.col("contents"), max_value_bytes)
    return logs.groupBy(*by).agg(
        F.sum(F.expr(log_size())).alias("size_bytes"),
        F.count("*").alias("n_logs"),
        F.max(over).alias("oversize"),
    )


def check_requests(
    logs: DataFrame,
    by: Sequence[str],
    max_bytes: int = MAX_REQUEST_BYTES,
    max_logs: int = MAX_REQUEST_LOGS,
    max_value_bytes: int = MAX_VALUE_BYTES,
) -> DataFrame:
    """Accept or reject each request of one list of logs, as a whole."""
    measured = _measured(logs, by, max_value_bytes)
    too_large = (F.col("size_bytes") > max_bytes) | (F.col("n_logs") > max_logs)
    reason = F.when(F.col("oversize"), "value_too_large").when(too_large, "request_too_large")
    judged = measured.withColumn("reason", reason)
    return judged.select(
        *by, "size_bytes", "n_logs", F.col("reason").isNull().alias("accepted"), "reason"
    )


def check_request_groups(
    logs: DataFrame,
    by: Sequence[str],
    order: str,
    max_bytes: int = MAX_REQUEST_BYTES,
    max_logs: int = MAX_REQUEST_LOGS,
    max_value_bytes: int = MAX_VALUE_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """Accept or reject each request of several groups, in the order of ``order``.

    The size runs over the groups; the first group that takes it over the limit, has too
    many logs or too large a value rejects the whole request and is given as
    ``first_bad``.
    """
    groups, parts = read_once(_measured(logs, [*by, order], max_value_bytes), partitions)
    ordered = range_ordered(groups, by, [order], parts)
    running = running_sums(ordered, by, [order], {"running_bytes": F.col("size_bytes")})
    too_large = (F.col("running_bytes") > max_bytes) | (F.col("n_logs") > max_logs)
    bad = F.when(F.col("oversize") | too_large, F.col(order))
    value_bad = F.when(F.col("oversize"), F.col(order))
    requests = running.groupBy(*by).agg(
        F.sum("size_bytes").alias("size_bytes"),
        F.sum("n_logs").alias("n_logs"),
        F.count("*").alias("n_groups"),
        F.min(bad).alias("first_bad"),
        F.min(value_bad).alias("_value_bad"),
    )
    reason = F.when(F.col("_value_bad") == F.col("first_bad"), "value_too_large").when(
        F.col("first_bad").isNotNull(), "request_too_large"
    )
    return (
        requests.withColumn("reason", reason)
        .withColumn("accepted", F.col("first_bad").isNull())
        .drop("_value_bad")
    )
