"""Byte sizes of logs, packages and requests, as SQL expressions.

Every function takes the names (or expressions) of columns as text and returns an
expression for ``F.expr``, ``selectExpr`` or a SQL query. Two measures exist side by
side. The *accounting* size is what limits are tested against: four bytes per log plus
the bytes of every key and value. The *wire* size is the exact length of the encoded
message.
"""

from __future__ import annotations

LOG_OVERHEAD = 4
ID_BYTES = 41


def log_size(contents: str = "contents") -> str:
    """Accounting size of a log."""
    pair = "coalesce(octet_length(c.key), 0) + coalesce(octet_length(c.value), 0)"
    total = f"aggregate({contents}, {LOG_OVERHEAD}L, (acc, c) -> acc + {pair})"
    return f"coalesce({total}, {LOG_OVERHEAD}L)"


def varint_size(number: str, bits: int = 63) -> str:
    """Bytes a number takes in base 128; negative numbers take ten.

    ``bits`` is how many a number may have: 63 for a bigint, up to 126 for a decimal.
    """
    most = -(-bits // 7)
    widths = " ".join(f"WHEN {number} < {1 << 7 * w}{'L' if w < 9 else ''} THEN {w}L" for w in range(1, most))
    return f"(CASE WHEN {number} < 0 THEN 10L {widths} ELSE {most}L END)"


def field_size(length: str) -> str:
    """Bytes of a length-prefixed field with a one-byte tag."""
    return f"(1L + {varint_size(length)} + {length})"


def text_field_size(text: str) -> str:
    """Bytes of a text field: nothing when absent, two when present but empty."""
    return f"(CASE WHEN {text} IS NULL THEN 0L ELSE {field_size(f'octet_length({text})')} END)"


def number_field_size(number: str) -> str:
    """Bytes of a number field, nothing when absent."""
    return f"(CASE WHEN {number} IS NULL THEN 0L ELSE 1L + {varint_size(number)} END)"


def content_wire_size(pair: str) -> str:
    """Encoded size of one key/value pair of a log."""
    return f"({text_field_size(f'{pair}.key')} + {text_field_size(f'{pair}.value')})"


def tag_wire_size(tag: str) -> str:
    """Encoded size of one tag of a package."""
    return content_wire_size(tag)


def nested_size(sizes: str) -> str:
    """Bytes of messages of the given sizes (an array), each nested as a field."""
    return f"coalesce(aggregate({sizes}, 0L, (acc, n) -> acc + {field_size('n')}), 0L)"


def log_wire_size(
    time: str = "time", contents: str = "contents", collect_time: str = "collect_time"
) -> str:
    """Encoded size of a log."""
    pairs = nested_size(f"transform({contents}, p -> {content_wire_size('p')})")
    return f"({number_field_size(time)} + {pairs} + {number_field_size(collect_time)})"


def metadata_wire_size(
    source: str = "source",
    hostname: str = "hostname",
    filename: str = "filename",
    context: str = "context_flow",
    tags: str = "tags",
) -> str:
    """Encoded size of everything in a package but its logs."""
    texts = " + ".join(text_field_size(t) for t in (context, filename, source, hostname))
    return f"({texts} + {nested_size(f'transform({tags}, g -> {tag_wire_size("g")})')})"


def logs_wire_size(logs: str = "logs") -> str:
    """Encoded size of an array of logs inside their package."""
    log = log_wire_size("log.time", "log.contents", "log.collect_time")
    return nested_size(f"transform({logs}, log -> {log})")


def list_size(logs: str = "logs") -> str:
    """Accounting size of an array of logs."""
    each = f"transform({logs}, log -> {log_size('log.contents')})"
    return f"aggregate({each}, 0L, (acc, n) -> acc + n)"


def group_wire_size(logs: str = "logs", **metadata: str) -> str:
    """Encoded size of a package held as one row."""
    return f"({logs_wire_size(logs)} + {metadata_wire_size(**metadata)})"


def request_wire_size(group_sizes: str) -> str:
    """Encoded size of a request, from an array of its package sizes."""
    return nested_size(group_sizes)


def opening_metadata_size(source: str, hostname: str) -> int:
    """Metadata bytes of a new package: id, source and host are always present."""

    def field(length: int) -> int:
        return 1 + max(1, -(-length.bit_length() // 7)) + length

    return field(ID_BYTES) + field(len(source.encode())) + field(len(hostname.encode()))


def ns_to_ms(nanoseconds: str) -> str:
    """Nanoseconds to milliseconds, cutting toward zero."""
    return f"(({nanoseconds}) div 1000000L)"
