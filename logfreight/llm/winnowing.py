"""Document fingerprints by winnowing.

Every run of ``K`` code points is hashed; of each window of ``W`` neighbouring hashes the least
is kept, the rightmost of equal ones, with its position. Two texts that share a passage of at
least ``W + K - 1`` code points share a hash. Short texts take smaller windows, so that they
keep about ``SHORT`` hashes or more: the least of a window is also the least of the smaller
windows around it, so the guarantee holds between short and long texts too. A text shorter than
``K`` is one hash of its whole. Likeness is the Jaccard index of the sets of hashes; two empty sets are alike (1).

The edited text and the next document need neighbours in doc_id order. Documents are cut into
ranges of doc_id, each sorted; the first document of each range is also sent to the range that
ends just before it, so every pair of neighbours meets and every text moves once.

Null text is an empty text, whose fingerprint is the empty string. Of documents with the same
doc_id, the order is that of their texts; null doc_id comes last. A single document is its own
next. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.rolling import code_points, gram_hashes, winnowed
from logfreight.llm.texts import batches_of, bounds_of, in_parts, partitions_of

K, W, SHORT = 12, 45, 16


def fingerprint(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and positions that winnowing keeps of a text."""
    points = code_points(text)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes = gram_hashes(points, min(k, len(points)))
    return winnowed(hashes, min(w, max(1, len(hashes) // SHORT)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sorted sets of hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    """A fingerprint as text: hex of 32-bit hashes, a colon, and the gaps of positions."""
    gaps = np.diff(places, prepend=0)
    return hashes.astype(">u4").tobytes().hex() + ":" + ",".join(map(str, gaps.tolist())) if len(hashes) else ""


def fingerprints(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """doc_id, n_chars and fingerprint of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, 1000):
            texts = [x or "" for x in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                pa.array([len(x) for x in texts], type=pa.int64()),
                pa.array([written(*fingerprint(x, k, w)) for x in texts], type=pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "fingerprint"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def with_next(docs: DataFrame, partitions: int | None = None) -> tuple[DataFrame, int]:
    """Documents in ranges of descending doc_id, each range followed by the next one's first.

    ``guest`` marks such a first document; it is no row of the range it was sent to. Only ids
    are read to learn which documents these are: one per range.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("bigint"))
    parts = partitions_of(spark, partitions)
    bounds = bounds_of(ids, "doc_id", parts)
    rows = in_parts(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")), "doc_id", bounds)
    # Ranges are numbered upwards; nulls are in range 0, behind its ids.
    firsts = in_parts(ids, "doc_id", bounds).groupBy("part").agg(F.max("doc_id").alias("first_id"))
    known = sorted((r["part"], r["first_id"]) for r in firsts.collect())  # one row per range
    before = {part: known[(i + 1) % len(known)][0] for i, (part, _) in enumerate(known)}
    sends = [(part, first, before[part]) for part, first in known]
    first = spark.createDataFrame(sends, "part int, first_id bigint, to_part int")
    joined = rows.join(
        F.broadcast(first),
        (rows["part"] == first["part"]) & rows["doc_id"].eqNullSafe(first["first_id"]),
        "left",
    ).select(rows["part"], "doc_id", "text", "to_part")
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("to_part").alias("part"), F.lit(1).alias("guest"))
    places = F.when(F.col("to_part").isNull(), F.array(own)).otherwise(F.array(own, guest))
    sent = joined.select(F.explode(places).alias("at"), "doc_id", "text")
    dealt = sent.select("at.part", "at.guest", "doc_id", "text").repartitionById(parts, F.col("part"))
    return dealt.sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "text"), parts


def edited_fingerprints(
    docs: DataFrame, k: int = K, w: int = W, partitions: int | None = None
) -> DataFrame:
    """Fingerprints of documents and of their edited texts, and how alike neighbours are.

    The edited text is the document with its last floor(n / 2) code points replaced by the
    first as many (or all) of the next document in descending doc_id.
    """
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Each row of a range with the one behind it."""
        last = None
        for batch in batches_of(batches, 500):
            for guest, doc_id, text in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                text = text or ""
                now = (guest, doc_id, text, *fingerprint(text, k, w))
                if last is not None and not last[0]:
                    yield last, now
                last = now

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for (_, doc_id, text, hashes, places), (_, _, following, following_hashes, _) in pairs(batches):
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            found, at = fingerprint(edited, k, w)
            own = np.unique(hashes)
            marks = written(hashes, places), written(found, at)
            out.append(
                (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks,
                 likeness(own, np.unique(found)), likeness(own, np.unique(following_hashes)))
            )
            size += len(marks[0]) + len(marks[1])
            if len(out) >= 1000 or size > 1 << 24:
                yield as_batch(out)
                out, size = [], 0
        if out:
            yield as_batch(out)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        ]
        columns = [pa.array(values, type=kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return with_next(docs, partitions)[0].mapInArrow(run, schema)
