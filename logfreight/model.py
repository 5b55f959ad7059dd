"""Schemas of the tables this library reads and writes, and the option sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The limits and defaults a packer has to agree on with the service.
MAX_VALUE_BYTES = 1048576
MAX_PACKAGE_BYTES = 5242880
MAX_PACKAGE_LOGS = 40960
MAX_REQUEST_BYTES = 5242880
MAX_REQUEST_LOGS = 10000
DEFAULT_PACKAGE_BYTES = 524288
DEFAULT_PACKAGE_LOGS = 4096
DEFAULT_LINGER_MS = 2000
MIN_LINGER_MS = 100
DEFAULT_TOTAL_BYTES = 104857600
DEFAULT_SEND_WORKERS = 50
DEFAULT_TASK_BYTES = 33554432
DEFAULT_RETRIES = 10
DEFAULT_BACKOFF_MS = 100
DEFAULT_MAX_BACKOFF_MS = 50000
DEFAULT_KEPT_ATTEMPTS = 11

PAIR = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)
PAIRS = T.ArrayType(PAIR)
LOG = T.StructType(
    [
        T.StructField("time", T.LongType()),
        T.StructField("contents", PAIRS),
        T.StructField("collect_time", T.LongType()),
    ]
)
LOGS = T.StructType(
    [
        T.StructField("topic_id", T.StringType()),
        T.StructField("producer", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("arrival_ms", T.LongType()),
        *LOG.fields,
    ]
)
PACKED = T.StructType(
    [
        *LOGS.fields,
        T.StructField("size_bytes", T.LongType()),
        T.StructField("logs_wire_bytes", T.LongType()),
        T.StructField("n_logs", T.LongType()),
        T.StructField("create_ms", T.LongType()),
        T.StructField("close_ms", T.LongType()),
        T.StructField("close_reason", T.StringType()),
        T.StructField("package_id", T.StringType()),
    ]
)
OUTBOX = T.StructType(
    [
        T.StructField("package_id", T.StringType()),
        T.StructField("compress_type", T.StringType()),
        T.StructField("raw_bytes", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("topic_id", T.StringType()),
    ]
)
ATTEMPTS = T.StructType(
    [
        T.StructField("package_id", T.StringType()),
        T.StructField("topic_id", T.StringType()),
        T.StructField("attempt_no", T.IntegerType()),
        T.StructField("http_code", T.IntegerType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)


@dataclass(frozen=True)
class PackOptions:
    """Limits of a package.

    ``max_bytes`` and ``max_logs`` outside their range fall back to the hard cap,
    a ``linger_ms`` below 100 falls back to the default. ``cap_bytes`` is the size
    at which a log is no longer added to a package it would overfill; only tests
    have a reason to lower it. ``run_secs`` goes into the package ids: without it every
    packing call takes a number of its own, so that ids never repeat; give it to a run
    that must reproduce its ids. ``partitions`` sets the number of ranges, which else
    follows the number of rows; a task takes ``slice_rows`` narrow rows at a time.
    """

    max_bytes: int = DEFAULT_PACKAGE_BYTES
    max_logs: int = DEFAULT_PACKAGE_LOGS
    linger_ms: int = DEFAULT_LINGER_MS
    cap_bytes: int = MAX_PACKAGE_BYTES
    source: str = ""
    hostname: str = ""
    run_secs: int | None = None
    partitions: int | None = None
    slice_rows: int = 262_144

    def __post_init__(self) -> None:
        if not 0 < self.max_bytes <= MAX_PACKAGE_BYTES:
            object.__setattr__(self, "max_bytes", MAX_PACKAGE_BYTES)
        if not 0 < self.max_logs <= MAX_PACKAGE_LOGS:
            object.__setattr__(self, "max_logs", MAX_PACKAGE_LOGS)
        if self.linger_ms < MIN_LINGER_MS:
            object.__setattr__(self, "linger_ms", DEFAULT_LINGER_MS)


@dataclass(frozen=True)
class DeliveryOptions:
    """Retry and accounting settings; out-of-range values fall back to the defaults.

    At most ``workers`` tasks send at a time; each takes about ``task_bytes`` of payload.
    """

    retries: int = DEFAULT_RETRIES
    backoff_ms: int = DEFAULT_BACKOFF_MS
    max_backoff_ms: int = DEFAULT_MAX_BACKOFF_MS
    kept_attempts: int = DEFAULT_KEPT_ATTEMPTS
    total_bytes: int = DEFAULT_TOTAL_BYTES
    workers: int = DEFAULT_SEND_WORKERS
    task_bytes: int = DEFAULT_TASK_BYTES

    def __post_init__(self) -> None:
        fallbacks = {
            "backoff_ms": DEFAULT_BACKOFF_MS,
            "max_backoff_ms": DEFAULT_MAX_BACKOFF_MS,
            "kept_attempts": DEFAULT_KEPT_ATTEMPTS,
            "total_bytes": DEFAULT_TOTAL_BYTES,
            "workers": DEFAULT_SEND_WORKERS,
            "task_bytes": DEFAULT_TASK_BYTES,
        }
        for name, fallback in fallbacks.items():
            if getattr(self, name) <= 0:
                object.__setattr__(self, name, fallback)
