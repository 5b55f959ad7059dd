"""Removal of passages that an earlier document has, by longest-previous-factor arrays.

A byte goes if some ``LENGTH``-byte string that covers it also starts in a document with a
smaller doc_id. No task can hold a suffix array of the corpus, so places where such a string can
lie are brought together first:

1. Anchors. Every run of ``GRAM`` bytes is hashed, and each string of ``LENGTH`` bytes has as
   anchor its least run (the rightmost of equal ones). Equal strings have the same anchor at
   the same place, so a repeat shows up under its anchor. About one byte in sixteen is an
   anchor's begin. An anchor's context is what any such string around it can reach.
2. Anchors meet by hash. Of equal contexts all but those of the least doc_id are covered whole.
   Where an anchor has several contexts, the first of each needs a closer look, if it has
   the ``SIDE`` bytes before or behind the anchor in common with another: of a repeat, at
   least half of what lies around the anchor is on one side.
3. Those contexts are cut from the texts, brought together by anchor, and a suffix array over
   them with previous and next smaller owners (``suffixes``) gives each start its longest
   previous factor: from ``LENGTH`` on, the string is covered.
4. Covered spans go back to the documents, which are joined with them once more.

Within a task only the least doc_id of each context is sent on; the others are known to be
covered and go straight to their documents' group, as do whole copies. An anchor with many
contexts in one task is hot: its contexts are dealt out by their own hash, a mark tells the
task of that anchor, and step 3 takes them string by string, dealt out by string. Each group
of documents sends a string for its least doc_id only, the others are covered; so a common
passage or phrase gives a task as many pieces as there are groups, not as many as documents.
Work is dealt out in ranges of about ``RANGE_BYTES``.

Anchors, facts and spans travel packed. What steps 2 and 3 find is written as tables, after which
their shuffle files go; the texts are in one shuffle at a time.

Texts are judged as UTF-8 bytes of the input. Null text is empty. Rows of the same doc_id do not
cover each other; rows with a null doc_id keep all and cover none. Every row gives one row.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logfreight.llm.rolling import BASE, _powers, mixed, window_minima
from logfreight.llm.suffixes import repeats_of_earlier
from logfreight.llm.texts import as_rows, for_worker, give_back, without
from logfreight.session import shuffles_freed, written_table

LENGTH, GRAM = 50, 20
REACH = LENGTH - GRAM
SIDE = REACH // 2
RANGE_BYTES = 12 << 20
FLUSH = 300_000
# Texts are looked at in lots, and results go back in batches, of about so many bytes.
LOT_BYTES = 32 << 10
BLOB_BYTES = 2 << 20
HOT = 500
FACT, QUESTION, SPANS = range(3)
PLAIN, COVERED, MARK, COPY, SPREAD, LOOK, LOOK_EACH = range(7)
# left and right: hashes of the bytes on either side, 0 where the text ends before.
ENTRY = np.dtype(
    [("h1", "<u8"), ("h2", "<u4"), ("left", "<u2"), ("right", "<u2"), ("doc", "<i8"), ("kind", "u1")]
)
# A context (or one string of it) on its way to the suffix array, at a fixed width.
WIDTH = LENGTH + REACH
PIECE = np.dtype(
    [("key", "<u8"), ("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("offset", "u1"), ("size", "u1"), ("bytes", "u1", (WIDTH,))]
)
LOT = 4_000
SPAN = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("doc", "<i8"), ("lo", "u1"), ("hi", "u1")])


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums that give the polynomial hash of any run, and the powers that place it."""
    up, down = _powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


def anchors_of(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of texts of ``LENGTH`` bytes and more that lie one after the other, cut at ``edges``.

    The number of the text, the place, hashes of run and context, where the context begins and
    ends, hashes of the ``SIDE`` bytes before and behind (0 where the text ends before).
    """
    sums, down = _sums(data)
    hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) - GRAM + 1])
    low = np.uint64(0xFFFFFFFF)
    keys = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    least = window_minima(keys, REACH + 1)
    if len(edges) > 2:
        # Strings that go across two texts are none.
        many = np.full(2 * len(edges) - 3, LENGTH - 1)
        many[::2] = np.diff(edges) - LENGTH + 1
        least = least[np.repeat(np.arange(len(many)) % 2 == 0, many)]
    least = least[np.concatenate(([True], least[1:] != least[:-1]))]
    at = (low - (least & low)).astype(np.int64)
    which = np.searchsorted(edges, at, side="right") - 1
    first, last = edges[which], edges[which + 1]
    begin, end = np.maximum(at - REACH, first), np.minimum(at + LENGTH, last)
    context = (sums[end] - sums[begin]) * down[begin]
    context = mixed(context + (at - begin).astype(np.uint64) * BASE + (end - at).astype(np.uint64))
    left, right = np.zeros((2, len(at)), np.uint16)
    for side, start, inside in ((left, at - SIDE, at - SIDE >= first), (right, at + GRAM, at + GRAM + SIDE <= last)):
        start = start[inside]
        hashed = mixed((sums[start + SIDE] - sums[start]) * down[start]) >> np.uint64(48)
        side[inside] = np.maximum(hashed, np.uint64(1))
    return which, at, hashes[at], (context >> np.uint64(32)).astype(np.uint32), begin, end, left, right


def anchors(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places of anchors of one text, hashes of their runs and contexts, and where contexts begin and end."""
    return anchors_of(data, np.array([0, len(data)]))[1:6]


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts and where each begins, and the last ends; null is empty."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, values = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    return data[edges[0] : edges[-1]], edges - edges[0]


def _lots(edges: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows from and to of lots of texts of at most ``LOT_BYTES`` (or of one text)."""
    first = 0
    while first < len(edges) - 1:
        last = max(first + 1, int(np.searchsorted(edges, edges[first] + LOT_BYTES, side="right")) - 1)
        yield first, last
        first = last


def _together(data: np.ndarray, edges: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some texts, one after the other, and their edges."""
    if len(rows) and rows[-1] - rows[0] == len(rows) - 1:
        return data[edges[rows[0]] : edges[rows[-1] + 1]], edges[rows[0] : rows[-1] + 2] - edges[rows[0]]
    parts = [data[edges[r] : edges[r + 1]] for r in rows.tolist()]
    return np.concatenate(parts) if parts else data[:0], np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _digest(data: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(data.tobytes(), digest_size=8).digest(), "little")


def group_of(doc: np.ndarray, groups: int) -> np.ndarray:
    return np.mod(np.mod(doc, 1_000_003) * 7919, groups).astype(np.int32)


def _group_column(groups: int) -> Column:
    hashed = F.pmod(F.pmod(F.col("doc_id").cast("bigint"), F.lit(1_000_003)) * 7919, F.lit(groups))
    return F.coalesce(hashed, F.lit(0)).cast("int")


def _packed(entries: np.ndarray) -> bytes:
    """Entries by columns of bytes, compressed; of a column in ascending order, the differences."""
    entries, ascending = entries.copy(), []
    for name in ("h1", "doc"):
        own = entries[name].copy()
        ascending.append(bool((own[1:] >= own[:-1]).all()))
        if ascending[-1]:
            entries[name][1:] = own[1:] - own[:-1]
    columns = np.ascontiguousarray(entries.view(np.uint8).reshape(len(entries), -1).T)
    return np.array([len(entries), *ascending], "<u4").tobytes() + pa.compress(columns, "zstd", asbytes=True)


def _unpacked(blob: bytes, kind: np.dtype) -> np.ndarray:
    many, *ascending = np.frombuffer(blob, "<u4", 3).tolist()
    columns = pa.decompress(memoryview(blob)[12:], many * kind.itemsize, "zstd")
    entries = np.frombuffer(columns, np.uint8).reshape(-1, many).T.copy().view(kind).ravel()
    for name, differences in zip(("h1", "doc"), ascending):
        if differences:
            entries[name] = np.cumsum(entries[name], dtype=entries[name].dtype)
    return entries


def _dealt(entries: np.ndarray, to: np.ndarray, pack: bool = True) -> Iterator[tuple[int, bytes]]:
    order = _order(to.astype(np.uint64) << np.uint64(32))
    to = to[order]
    edges = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]]) if len(to) else [0]
    for a, b in zip(edges, edges[1:]):
        own = entries[order[a:b]]
        yield int(to[a]), _packed(own) if pack else own.tobytes()


def _batches(rows: Iterable[tuple[int, bytes]], key: str, what: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``BLOB_BYTES``, made as the rows come."""
    held, many = [], 0
    for row in rows:
        held.append(row)
        many += len(row[1])
        if many >= BLOB_BYTES:
            yield _blobs(held, key, what)
            held, many = [], 0
    if held:
        yield _blobs(held, key, what)


def _blobs(rows: list[tuple[int, bytes]], key: str, what: int | None = None) -> pa.RecordBatch:
    columns = [pa.array([k for k, _ in rows], type=pa.int32()), pa.array([b for _, b in rows], type=pa.binary())]
    names = [key, "blob"]
    if what is not None:
        columns.append(pa.array([what] * len(rows), type=pa.int32()))
        names.append("what")
    return pa.RecordBatch.from_arrays(columns, names=names)


def _order(keys: np.ndarray) -> np.ndarray:
    """An order that brings equal keys together, by their upper bits beside the place: sorted as one integer."""
    bits = np.uint64(len(keys).bit_length())
    packed = (keys >> bits << bits) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _tied(keys: np.ndarray) -> np.ndarray:
    """Which keys have an equal neighbour."""
    tied = np.zeros(len(keys), bool)
    same = keys[1:] == keys[:-1]
    tied[1:] |= same
    tied[:-1] |= same
    return tied


def _least_first(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by (h1, h2, doc), and which of them begin a context."""
    h1 = np.ascontiguousarray(entries["h1"])
    order = _order(h1)
    # Few have the upper bits of h1 in common with another; only these need h2 and doc.
    among = np.flatnonzero(_tied(h1[order] >> np.uint64(len(h1).bit_length())))
    few = order[among]
    order[among] = few[np.lexsort((entries["doc"][few], entries["h2"][few], h1[few]))]
    entries = entries[order]
    begins = np.ones(len(entries), bool)
    begins[1:] = (entries["h1"][1:] != entries["h1"][:-1]) | (entries["h2"][1:] != entries["h2"][:-1])
    return entries, begins


def _named(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """One integer for a context, enough to find it in its text."""
    return mixed(h1 + h2.astype(np.uint64) * BASE)


def _facts(covered: np.ndarray) -> np.ndarray:
    """Covered contexts by doc, each under one integer, without what is not asked of them any more."""
    covered = covered[np.argsort(covered["doc"], kind="stable")]
    covered["h1"], covered["kind"] = _named(covered["h1"], covered["h2"]), COVERED
    for name in ("h2", "left", "right"):
        covered[name] = 0
    return covered


def _sent(entries: np.ndarray, ranges: int, groups: int, many: int) -> Iterator[tuple[int, bytes]]:
    """What a task sends on of its anchors: the first of each context, marks, covered ones."""
    entries, begins = _least_first(entries)
    owner = np.maximum.accumulate(np.where(begins, np.arange(len(entries)), 0))
    later = entries["doc"] > entries["doc"][owner]
    covered = _facts(entries[later])
    first = entries[begins].copy()
    fresh = np.ones(len(first), bool)
    fresh[1:] = first["h1"][1:] != first["h1"][:-1]
    number = np.cumsum(fresh) - 1
    hot = np.bincount(number, minlength=1)[number] > many if len(first) else fresh
    first["kind"][hot] = SPREAD
    marks = first[hot & fresh].copy()
    marks["kind"] = MARK
    to = np.where(hot, _named(first["h1"], first["h2"]), first["h1"]) % np.uint64(ranges)
    yield from _dealt(first, to.astype(np.int32))
    yield from _dealt(marks, (marks["h1"] % np.uint64(ranges)).astype(np.int32))
    yield from _dealt(covered, ranges + group_of(covered["doc"], groups))


def anchor_table(docs: DataFrame, ranges: int, groups: int, hot: int = HOT) -> DataFrame:
    """to, blob: anchors for the range of their hash (below ``ranges``) or for a group of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for_worker("suffix_dedup", lambda: None)
        held: list[np.ndarray] = []
        copies: list[tuple] = []
        seen: dict[int, int] = {}
        many = 0

        def flush() -> Iterator[pa.RecordBatch]:
            copied = np.array(copies, ENTRY)
            copies.clear()
            entries = np.concatenate(held) if held else copied[:0]
            held.clear()
            yield from _batches(_sent(entries, ranges, groups, hot), "to")
            del entries
            yield from _batches(_dealt(copied, ranges + group_of(copied["doc"], groups)), "to")
            give_back()

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, edges = _texts(batch.column(1))
            for first, last in _lots(edges):
                rows = []
                for row in range(first, last):
                    if edges[row + 1] - edges[row] < LENGTH:
                        continue
                    digest, doc_id = _digest(data[edges[row] : edges[row + 1]]), int(ids[row])
                    if seen.get(digest, doc_id) < doc_id:
                        copies.append((digest, 0, 0, 0, doc_id, COPY))
                        continue
                    seen[digest] = doc_id
                    rows.append(row)
                if rows:
                    rows = np.array(rows)
                    which, _, h1, h2, _, _, left, right = anchors_of(*_together(data, edges, rows))
                    entries = np.empty(len(h1), ENTRY)
                    entries["h1"], entries["h2"], entries["doc"], entries["kind"] = h1, h2, ids[rows][which], PLAIN
                    entries["left"], entries["right"] = left, right
                    held.append(entries)
                    many += len(entries)
                if many > FLUSH:
                    yield from flush()
                    many = 0
                if len(seen) > 1_000_000:
                    seen = {}
        yield from flush()

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).mapInArrow(run, "to int, blob binary")


def _alike(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts with a side in common with one of another document, and how many these are."""
    look, most = np.zeros(len(first), bool), np.zeros(len(first), np.int64)
    # By h1 as they are; an anchor with one context has none to share a side with.
    shared = np.flatnonzero(_tied(first["h1"]))
    for side in ("left", "right"):
        have = shared[first[side][shared] > 0]
        order = have[np.lexsort((first[side][have], first["h1"][have]))]
        if not len(order):
            continue
        h1, own, doc = first["h1"][order], first[side][order], first["doc"][order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (h1[1:] != h1[:-1]) | (own[1:] != own[:-1])
        edges, number = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        several = np.minimum.reduceat(doc, edges) < np.maximum.reduceat(doc, edges)
        look[order] |= several[number]
        most[order] = np.maximum(most[order], np.bincount(number)[number])
    return look, most


def judged(sent: DataFrame, ranges: int, groups: int, hot: int = HOT) -> DataFrame:
    """_grp, blob, what: what is known of shared anchors, by group of documents.

    ``what`` is ``FACT`` for covered contexts and copies, ``QUESTION`` for contexts to look at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            for to, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if to >= ranges:
                    yield _blobs([(to - ranges, blob)], "_grp", FACT)
                else:
                    parts.append(_unpacked(blob, ENTRY))
        if not parts:
            return
        entries = np.concatenate(parts)
        parts.clear()
        give_back()
        marked = np.unique(entries["h1"][entries["kind"] == MARK])
        entries, begins = _least_first(entries[entries["kind"] != MARK])
        owner = np.maximum.accumulate(np.where(begins, np.arange(len(entries)), 0))
        later = entries["doc"] > entries["doc"][owner]
        first = entries[begins]
        everywhere = (first["kind"] == SPREAD) | np.isin(first["h1"], marked)
        look, many = _alike(first)
        # All contexts of an anchor go the same way, else they would not meet in step 3.
        each = everywhere | np.isin(first["h1"], first["h1"][many > 4 * hot])
        first["kind"] = np.where(each, LOOK_EACH, LOOK)
        covered = _facts(entries[later])
        first = first[everywhere | look]
        first = first[np.argsort(first["doc"], kind="stable")]
        first["left"] = first["right"] = 0
        for what, out in ((FACT, covered), (QUESTION, first)):
            yield from _batches(_dealt(out, group_of(out["doc"], groups)), "_grp", what)

    # Groups' own rows go past the ranges, to as many tasks.
    tasks = ranges + groups
    return sent.repartitionById(tasks, F.col("to")).mapInArrow(run, "_grp int, blob binary, what int")


def _known(table: pa.Table, kind: np.dtype) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *(_unpacked(b.as_py(), kind) for b in table["blob"])])


class _Lookup:
    """Entries of one group of documents, found by document and anchor."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries[np.argsort(entries["doc"], kind="stable")]
        self.docs = np.ascontiguousarray(self.entries["doc"])

    def of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of each of some documents, and the place of the document among these."""
        left, right = (np.searchsorted(self.docs, docs, side=side) for side in ("left", "right"))
        which, at = _spread(right - left)
        return self.entries[left[which] + at], which

    def has(self, docs: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.docs, docs, side="left") < np.searchsorted(self.docs, docs, side="right")


def _spread(many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of several numbers n, its place n times, beside 0 to n - 1."""
    return np.repeat(np.arange(len(many)), many), np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _pick(own: np.ndarray, place: np.ndarray, which: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (anchor, entry of ``own``) with the same hashes, of the same text (``which``, ``place``)."""
    if not len(own) or not len(h1):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = lambda h1, h2, text: (h1 ^ (h2.astype(np.uint64) * BASE)) + mixed(text.astype(np.uint64))
    a, b = key(h1, h2, which), key(own["h1"], own["h2"], place)
    order = np.argsort(b, kind="stable")
    b = b[order]
    left = np.searchsorted(b, a, side="left")
    anchor, offset = _spread(np.searchsorted(b, a, side="right") - left)
    entry = order[left[anchor] + offset]
    same = (own["h1"][entry] == h1[anchor]) & (own["h2"][entry] == h2[anchor]) & (place[entry] == which[anchor])
    return anchor[same], entry[same]


def _grouped(docs: DataFrame, groups: int) -> DataFrame:
    return docs.select("*", _group_column(groups).alias("_grp"))


def contexts(docs: DataFrame, known: DataFrame, ranges: int, groups: int) -> DataFrame:
    """to, blob: contexts that need a closer look, by the hash of their anchor (or string).

    From ``ranges`` on, spans of strings that an earlier document of the same group has.
    """

    def run(rows: pa.Table, entries: pa.Table) -> pa.Table:
        give_back()
        lookup = _Lookup(_known(entries, ENTRY))
        made: list[np.ndarray] = []
        for batch in rows.to_batches():
            for _, texts, edges, docs in _long_texts(batch, lookup):
                own, place = lookup.of(docs)
                which, _, h1, h2, begin, end, _, _ = anchors_of(texts, edges)
                anchor, entry = _pick(own, place, which, h1, h2)
                # A context that a text has twice is looked at once.
                entry, first = np.unique(entry, return_index=True)
                made.append(_cut(texts, own[entry], begin[anchor[first]], end[anchor[first]]))
        pieces = np.concatenate(made) if made else np.empty(0, PIECE)
        made.clear()
        pieces, spans = _least_strings(pieces)
        sent = itertools.chain(
            _dealt(pieces, (pieces["key"] % np.uint64(ranges)).astype(np.int32), pack=False),
            _dealt(spans, ranges + group_of(spans["doc"], groups)),
        )
        return pa.Table.from_batches([*_batches(sent, "to"), _blobs([], "to")])

    grouped = _grouped(as_rows(docs).drop("row"), groups)
    return grouped.groupBy("_grp").cogroup(known.groupBy("_grp")).applyInArrow(run, "to int, blob binary")


def _long_texts(batch: pa.RecordBatch, *lookups: _Lookup) -> Iterator[tuple[np.ndarray, ...]]:
    """Lots of the texts of ``LENGTH`` bytes and more that a lookup has entries for.

    Their rows in the batch, their bytes one after the other, the edges, their doc_ids.
    """
    ids = batch.column("doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    ids = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
    data, edges = _texts(batch.column("text"))
    known &= np.logical_or.reduce([lookup.has(ids) for lookup in lookups])
    known &= np.diff(edges) >= LENGTH
    for first, last in _lots(edges):
        rows = first + np.flatnonzero(known[first:last])
        if len(rows):
            yield rows, *_together(data, edges, rows), ids[rows]


def _cut(data: np.ndarray, own: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Contexts as pieces of fixed width; of hot anchors, each string of a context."""
    each = own["kind"] == LOOK_EACH
    starts, sizes, of, offsets = [begin[~each]], [(end - begin)[~each]], [np.flatnonzero(~each)], [np.zeros((~each).sum(), np.int64)]
    many = np.maximum(end - begin - LENGTH + 1, 0)[each]
    if many.sum():
        owner, offset = _spread(many)
        owner = np.flatnonzero(each)[owner]
        starts.append(begin[owner] + offset)
        sizes.append(np.full(len(owner), LENGTH))
        of.append(owner)
        offsets.append(offset)
    start, size, owner = np.concatenate(starts), np.concatenate(sizes), np.concatenate(of)
    out = np.zeros(len(start), PIECE)
    for name in ("h1", "h2", "doc"):
        out[name] = own[name][owner]
    out["offset"], out["size"] = np.concatenate(offsets), size
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    out["bytes"] = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[start]
    short = np.flatnonzero(size < WIDTH)
    out["bytes"][short] *= np.arange(WIDTH) < size[short, None]
    out["key"] = out["h1"]
    strings = each[owner]
    if strings.any():
        text = out["bytes"][strings][:, :LENGTH].astype(np.uint64) + np.uint64(1)
        out["key"][strings] = mixed((text * _powers(LENGTH)[0]).sum(axis=1, dtype=np.uint64))
    return out


def _least_strings(pieces: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces without strings of which an earlier document has one here, and the spans of these."""
    strings = np.flatnonzero((pieces["size"] == LENGTH) & (pieces["key"] != pieces["h1"]))
    order = strings[np.lexsort((pieces["doc"][strings], pieces["key"][strings]))]
    key = pieces["key"][order]
    begins = np.ones(len(order), bool)
    begins[1:] = key[1:] != key[:-1]
    first = order[np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))]
    later = pieces["doc"][order] > pieces["doc"][first]
    order, first = order[later], first[later]
    # Of equal keys the bytes decide; a string that only has the key of another is sent on.
    order = order[(pieces["bytes"][order] == pieces["bytes"][first]).all(axis=1)]
    spans = np.empty(len(order), SPAN)
    for name in ("h1", "h2", "doc"):
        spans[name] = pieces[name][order]
    spans["lo"] = pieces["offset"][order]
    spans["hi"] = spans["lo"] + LENGTH
    stay = np.ones(len(pieces), bool)
    stay[order] = False
    return pieces[stay], spans


def _of_several(text: np.ndarray, starts: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Starts of strings of ``LENGTH`` bytes whose hash strings of several owners have: no others repeat."""
    sums, down = _sums(text)
    hashed = mixed((sums[starts + LENGTH] - sums[starts]) * down[starts])
    order = _order(hashed)
    hashed, owner = hashed[order] >> np.uint64(len(order).bit_length()), owners[order]
    # Equal hashes (of their upper bits) lie together; a run of several owners has two that are neighbours.
    same = hashed[1:] == hashed[:-1]
    run = np.concatenate([[0], np.cumsum(~same)]) if len(order) else order
    several = np.zeros(len(order), bool)
    several[run[1:][same & (owner[1:] != owner[:-1])]] = True
    shared = np.zeros(len(order), bool)
    shared[order] = several[run]
    return shared


def covered_spans(pieces: np.ndarray) -> np.ndarray:
    """Of each piece, what strings of earlier documents cover; the lot of a key must be whole."""
    found = []
    lots = -(-len(pieces) // LOT)
    lot = mixed(pieces["key"].copy()) % np.uint64(max(lots, 1))
    for number in range(lots):
        own = pieces[lot == number]
        piece, offset = _spread(np.maximum(own["size"].astype(np.int64) - LENGTH + 1, 0))
        text = own["bytes"].ravel()
        shared = _of_several(text, piece * WIDTH + offset, own["doc"][piece])
        piece, offset = piece[shared], offset[shared]
        which, place = np.unique(piece, return_inverse=True)
        hit = repeats_of_earlier(own["bytes"][which].ravel(), place * WIDTH + offset, own["doc"][piece], LENGTH)
        piece, offset = piece[hit], offset[hit]
        if not len(piece):
            continue
        # Starts of one context lie less than a string apart, so what they cover is one span.
        which, first = np.unique(piece, return_index=True)
        last = np.concatenate([first[1:], [len(piece)]]) - 1
        spans = np.empty(len(which), SPAN)
        for name in ("h1", "h2", "doc"):
            spans[name] = own[name][which]
        spans["lo"] = own["offset"][which] + offset[first]
        spans["hi"] = own["offset"][which] + offset[last] + LENGTH
        found.append(spans)
    return np.concatenate(found) if found else np.empty(0, SPAN)


def factors(looks: DataFrame, ranges: int, groups: int) -> DataFrame:
    """_grp, blob: covered spans of contexts, by group of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = []
        for batch in batches:
            for to, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if to >= ranges:
                    yield _blobs([(to - ranges, blob)], "_grp")
                else:
                    blobs.append(blob)
        if blobs:
            pieces = np.frombuffer(b"".join(blobs), PIECE)
            blobs.clear()
            give_back()
            spans = covered_spans(pieces)
            yield from _batches(_dealt(spans, group_of(spans["doc"], groups)), "_grp")

    return looks.repartitionById(ranges + groups, F.col("to")).mapInArrow(run, "_grp int, blob binary")


def _covered(texts: np.ndarray, edges: np.ndarray, docs: np.ndarray, known: _Lookup, spans: _Lookup) -> np.ndarray:
    """Which bytes of some texts are covered."""
    (own, place), (own_spans, span_place) = known.of(docs), spans.of(docs)
    which, _, h1, h2, begin, end, _, _ = anchors_of(texts, edges)
    facts = own["kind"] == COVERED
    anchor, _ = _pick(own[facts], place[facts], which, _named(h1, h2), np.zeros_like(h2))
    span_anchor, entry = _pick(own_spans, span_place, which, h1, h2)
    lows = np.concatenate([begin[anchor], begin[span_anchor] + own_spans["lo"][entry]])
    highs = np.concatenate([end[anchor], begin[span_anchor] + own_spans["hi"][entry]])
    # Texts that are copies as a whole, told by their digest.
    copies = own["kind"] == COPY
    for text in np.unique(place[copies]).tolist():
        if _digest(texts[edges[text] : edges[text + 1]]) in own["h1"][copies & (place == text)].tolist():
            lows, highs = np.append(lows, edges[text]), np.append(highs, edges[text + 1])
    change = np.bincount(lows, minlength=len(texts) + 1) - np.bincount(highs, minlength=len(texts) + 1)
    return np.cumsum(change)[: len(texts)] > 0


def _removed(batch: pa.RecordBatch, known: _Lookup, spans: _Lookup) -> pa.StructArray:
    """n_bytes, n_removed, n_spans and kept of each row of a batch."""
    data, edges = _texts(batch.column("text"))
    gone = np.zeros(len(data), bool)
    for rows, texts, own_edges, docs in _long_texts(batch, known, spans):
        covered = _covered(texts, own_edges, docs, known, spans)
        for i, row in enumerate(rows.tolist()):
            gone[edges[row] : edges[row + 1]] = covered[own_edges[i] : own_edges[i + 1]]
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    inner = edges[:-1][edges[:-1] < len(data)]
    begins[inner] = gone[inner]
    sizes = np.diff(edges)

    def many(flags: np.ndarray) -> np.ndarray:
        """How many flags of each text are set; running sums of a lot at a time."""
        found = np.zeros(len(sizes), np.int64)
        for first, last in _lots(edges):
            own = edges[first : last + 1]
            found[first:last] = np.diff(np.concatenate([[0], np.cumsum(flags[own[0] : own[-1]])])[own - own[0]])
        return found

    removed = many(gone)
    offsets = pa.py_buffer(np.concatenate([[0], np.cumsum(sizes - removed)]).astype(np.int32))
    kept = pa.Array.from_buffers(pa.binary(), len(sizes), [None, offsets, pa.py_buffer(data[~gone])])
    numbers = [pa.array(n.astype(np.int64)) for n in (sizes, removed, many(begins))]
    return pa.StructArray.from_arrays([*numbers, kept], names=["n_bytes", "n_removed", "n_spans", "kept"])


def without_repeats(docs: DataFrame, task_bytes: int = RANGE_BYTES, hot: int = HOT, name: str = "_removal") -> DataFrame:
    """The columns of ``docs`` and ``name`` (added or replaced): n_bytes, n_removed, n_spans, kept (bytes).

    ``task_bytes`` is how much text a task gets (about), ``hot`` how many contexts of an anchor
    in one task make it one to spread.
    """
    with shuffles_freed(docs.sparkSession):
        total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        ranges = groups = int(total // task_bytes) + 1
        known = written_table(judged(anchor_table(docs, ranges, groups, hot), ranges, groups, hot))
        questions = known.filter(F.col("what") == QUESTION).select("_grp", "blob")
        spans = written_table(factors(contexts(docs, questions, ranges, groups), ranges, groups))
    told = known.filter(F.col("what") == FACT).union(spans.withColumn("what", F.lit(SPANS)))
    held = as_rows(docs)
    # A text that is a string goes beside the row, not in it too.
    texts = [f.name for f in docs.schema if f.name.lower() == "text"]
    if len(texts) == 1 and docs.schema[texts[0]].dataType == T.StringType():
        held = held.withColumn("row", F.col("row").dropFields(texts[0]))
    else:
        texts = []
    removal = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")] + [T.StructField("kept", T.BinaryType())]
    )
    schema = T.StructType([held.schema["row"], held.schema["text"], T.StructField("_removal", removal)])
    kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])

    def run(rows: pa.Table, facts: pa.Table) -> pa.Table:
        give_back()
        what = facts["what"].to_numpy() if facts.num_rows else np.empty(0, int)
        known = _Lookup(_known(facts.filter(pa.array(what == FACT)), ENTRY))
        found = _Lookup(_known(facts.filter(pa.array(what == SPANS)), SPAN))
        made = [_removed(batch, known, found) for batch in rows.select(["doc_id", "text"]).to_batches()]
        return rows.select(["row", "text"]).append_column("_removal", pa.chunked_array(made, type=kind))

    grouped = _grouped(held, groups)
    done = grouped.groupBy("_grp").cogroup(told.groupBy("_grp")).applyInArrow(run, schema)
    kept = [F.col("text").alias(c) if c in texts else F.col(f"row.`{c}`") for c in without(docs, name)]
    return done.select(*kept, F.col("_removal").alias(name))
