"""Package identifiers."""

from __future__ import annotations

import secrets

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_number(run_secs: int | None) -> int:
    """The run that goes into ids: the one given, or a number no other run has."""
    return secrets.randbits(32) if run_secs is None else run_secs


def run_in_id(run: int | Column) -> Column:
    if isinstance(run, Column):
        return F.concat(F.lpad(F.hex(run.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"), F.lit("-"))
    return F.lit(f"{run & 0xFFFFFFFF:08x}-")


def number_in_id(seq: Column) -> Column:
    return F.lpad(F.hex(seq), 16, "0")


def name_in_id(*parts: Column) -> Column:
    """The counter part of an id for packages that are named instead of counted."""
    return F.substring(F.md5(F.concat_ws("/", *[part.cast("string") for part in parts])), 1, 16)


def package_id(producer: Column, topic: Column, counter: Column, run: int | Column = 0) -> Column:
    """``<16 hex of producer and topic><8 hex of the run>-<16 hex of the counter>``, upper case.

    The counter runs per (producer, topic), so no global order is needed. Ids are equal
    for equal input and run: a replayed job rewrites its packages instead of doubling them.
    """
    name = F.concat_ws(
        "", F.octet_length(F.coalesce(producer, F.lit(""))).cast("string"), F.lit(":"), producer, topic
    )
    return F.upper(
        F.concat(
            F.substring(F.md5(name), 1, 16),
            run_in_id(run),
            counter,
        )
    )
