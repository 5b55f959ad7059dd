"""Compressing and expanding payloads, one Arrow batch at a time."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Names under which a payload states its compression.
NONE, LZ4, ZSTD, DEFLATE = "none", "lz4", "zstd", "deflate"
CODECS = (NONE, LZ4, ZSTD, DEFLATE)


def known(compress_type: str) -> str:
    if compress_type not in CODECS:
        raise ValueError(f"unknown compress_type {compress_type!r}, expected one of {CODECS}")
    return compress_type


def compressor(compress_type: str) -> Callable[[bytes], bytes]:
    if known(compress_type) == NONE:
        return bytes
    if compress_type == DEFLATE:

        def deflate(data: bytes) -> bytes:
            stream = zlib.compressobj(wbits=-zlib.MAX_WBITS)
            return stream.compress(data) + stream.flush()

        return deflate
    codec = pa.Codec("lz4_raw") if compress_type == LZ4 else pa.Codec("zstd", 3)
    return lambda data: codec.compress(data, asbytes=True)


def lz4_length(block: bytes) -> int:
    """Length of an LZ4 block once expanded; the format does not state it."""

    def extended(length: int, at: int) -> tuple[int, int]:
        if length == 15:
            while block[at] == 255:
                length, at = length + 255, at + 1
            length, at = length + block[at], at + 1
        return length, at

    at = total = 0
    while at < len(block):
        token = block[at]
        literals, at = extended(token >> 4, at + 1)
        at += literals
        total += literals
        if at >= len(block):
            break
        match, at = extended(token & 15, at + 2)
        total += match + 4
    return total


def expand(compress_type: str, payload: bytes) -> bytes:
    if known(compress_type) == NONE:
        return payload
    if compress_type == DEFLATE:
        stream = zlib.decompressobj(wbits=-zlib.MAX_WBITS)
        data = stream.decompress(payload) + stream.flush()
        if not stream.eof:
            raise ValueError("deflate stream is cut off")
        return data
    if compress_type == ZSTD:
        with pa.input_stream(pa.py_buffer(payload), compression="zstd") as stream:
            return stream.read()
    return pa.Codec("lz4_raw").decompress(payload, lz4_length(payload), asbytes=True)


def compress(data: Column, compress_type: str) -> Column:
    """Compressed bytes of a binary column."""
    known(compress_type)

    @F.pandas_udf("binary")
    def run(bodies: pd.Series) -> pd.Series:
        pack = compressor(compress_type)
        return bodies.map(pack, na_action="ignore")

    return data if compress_type == NONE else run(data)
