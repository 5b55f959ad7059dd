"""Key/value contents as rows and as columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contents_long(logs: DataFrame) -> DataFrame:
    """One row per pair with its position from 0; a log without pairs keeps one row."""
    others = [name for name in logs.columns if name != "contents"]
    long = logs.select(*others, F.posexplode_outer("contents").alias("position", "_pair"))
    return long.select(
        *others,
        F.col("position"),
        F.col("_pair.key").alias("key"),
        F.col("_pair.value").alias("value"),
    )


def contents_wide(logs: DataFrame, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """Chosen keys as columns, the first value where a key occurs twice.

    ``prefix`` keeps them apart from columns of the same name.
    """

    def first_value(name: str):
        matches = F.filter("contents", lambda pair: pair["key"] == name)
        return F.try_element_at(matches, F.lit(1))["value"].alias(prefix + name)

    others = [name for name in logs.columns if name != "contents"]
    return logs.select(*others, *[first_value(name) for name in keys])
