"""Encoding logs and packages to their wire form, as SQL expressions.

A log is built as hexadecimal text by linear joins and turned to bytes where it is; a
package is the concatenation of its logs. No row crosses into Python to be encoded. Like
the functions in ``sizes``, these take and return expressions as text.
"""

from __future__ import annotations

from logfreight.functions.sizes import varint_size

# Field tags of the messages, in hexadecimal.
LOG_TIME = "08"
LOG_CONTENT = "12"
LOG_COLLECT_TIME = "18"
PAIR_KEY = "0A"
PAIR_VALUE = "12"
GROUP_LOG = "0A"
GROUP_CONTEXT = "12"
GROUP_FILENAME = "1A"
GROUP_SOURCE = "22"
GROUP_TAG = "2A"
GROUP_HOSTNAME = "32"
REQUEST_GROUP = "0A"


def _byte(number: str) -> str:
    return f"lpad(hex({number}), 2, '0')"


def varint_hex(number: str) -> str:
    """A number in base 128, low digits first, high bit set on all but the last."""
    last = f"cast({varint_size(number)} AS int) - 1"
    digit = f"shiftrightunsigned(cast({number} AS bigint), 7 * i) & 127"
    digits = f"transform(sequence(0, {last}), i -> {_byte(f'({digit}) | if(i < {last}, 128, 0)')})"
    two = f"concat(hex({number} & 127 | 128), {_byte(f'shiftright({number}, 7)')})"
    return (
        f"(CASE WHEN {number} BETWEEN 0 AND 127 THEN {_byte(number)} "
        f"WHEN {number} BETWEEN 128 AND 16383 THEN {two} ELSE array_join({digits}, '') END)"
    )


def nest_hex(tag: str, body: str) -> str:
    """A length-prefixed field around an encoded body, which should be a plain column."""
    return f"concat('{tag}', {varint_hex(f'(octet_length({body}) div 2)')}, {body})"


def _text_hex(tag: str, text: str) -> str:
    body = f"concat('{tag}', {varint_hex(f'octet_length({text})')}, hex({text}))"
    return f"(CASE WHEN {text} IS NULL THEN '' ELSE {body} END)"


def _number_hex(tag: str, number: str) -> str:
    body = f"concat('{tag}', {varint_hex(number)})"
    return f"(CASE WHEN {number} IS NULL THEN '' ELSE {body} END)"


def _join(parts: str) -> str:
    return f"coalesce(array_join({parts}, ''), '')"


def _pairs_hex(tag: str, pairs: str) -> str:
    body = f"concat({_text_hex(PAIR_KEY, 'p.key')}, {_text_hex(PAIR_VALUE, 'p.value')})"
    return _join(f"transform(transform({pairs}, p -> {body}), body -> {nest_hex(tag, 'body')})")


def log_hex(
    time: str = "time", contents: str = "contents", collect_time: str = "collect_time"
) -> str:
    """One encoded log."""
    return (
        f"concat({_number_hex(LOG_TIME, time)}, {_pairs_hex(LOG_CONTENT, contents)}, "
        f"{_number_hex(LOG_COLLECT_TIME, collect_time)})"
    )


def metadata_hex(context: str, group: str = "") -> str:
    """Everything in an encoded package after its logs; ``group`` is a prefix like ``g.``."""
    return (
        f"concat({_text_hex(GROUP_CONTEXT, context)}, "
        f"{_text_hex(GROUP_FILENAME, f'{group}filename')}, "
        f"{_text_hex(GROUP_SOURCE, f'{group}source')}, "
        f"{_pairs_hex(GROUP_TAG, f'{group}tags')}, "
        f"{_text_hex(GROUP_HOSTNAME, f'{group}hostname')})"
    )


def group_log_bytes(log_body: str) -> str:
    """A log as it stands inside its package; ``log_body`` is a column of ``log_hex``."""
    return f"unhex({nest_hex(GROUP_LOG, log_body)})"


def group_hex(group: str) -> str:
    """One encoded package held as a struct with its logs in an array."""
    log = log_hex("log.time", "log.contents", "log.collect_time")
    bodies = f"transform({group}.logs, log -> {log})"
    logs = _join(f"transform({bodies}, body -> {nest_hex(GROUP_LOG, 'body')})")
    return f"concat({logs}, {metadata_hex(f'{group}.context_flow', f'{group}.')})"


def request_of(group: str) -> str:
    """The bytes of a request with a single package, a column of bytes."""
    length = varint_hex(f"length({group})")
    return f"concat(unhex(concat('{REQUEST_GROUP}', {length})), {group})"


def request_bytes(groups: str) -> str:
    """The bytes of a request from an array of packages as structs."""
    bodies = f"transform({groups}, g -> {group_hex('g')})"
    return f"unhex({_join(f'transform({bodies}, body -> {nest_hex(REQUEST_GROUP, "body")})')})"
