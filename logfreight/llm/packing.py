"""Best-fit packing of token sequences, improved by swaps between bins that are not full.

Documents are encoded and followed by an end id; only those longer than a sequence are cut.
Pieces get a key and are written once; placing reads keys and lengths alone. Full pieces are
sequences already. The others are dealt out evenly by a hash of their key, so that a task has
``shard`` pieces at most (about); it packs them best-fit, longest first, and then searches:
between bins that are not full it moves a piece, exchanges one for one, or two for one, when
that makes the fuller bin fuller (the sum of squared fills grows), until bins run empty. Pieces
of bins that stay under ``keep`` go to the next round, dealt to fewer tasks, until one task has
them all. So no task ever holds more than its shard, and what one shard wastes others can fill.

Null text is an empty text: one piece with the end id alone. Repeated rows are packed each on
its own. Null doc_id is kept as it is. An empty table gives no pieces.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.texts import (
    LETTER_END,
    PieceIds,
    batches_of_bytes,
    for_worker,
    id_lists,
    library_tokenizer,
    with_end,
)
from logfreight.session import written_table

CAPACITY = 2048


class WordTexts:
    """Ids of texts for a tokenizer that drops white space: a text may be cut at any blank."""

    def __init__(self, path: str):
        tokenizer = library_tokenizer(path)
        self.added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.pieces = PieceIds(
            lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        )

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        # The tokenizer lowers letters itself and drops blanks; strings of added tokens stay whole.
        lowered = pc.ascii_lower(texts)
        apart = pc.replace_substring_regex(lowered, LETTER_END, r"\1 \2")
        for token in self.added:
            apart = pc.if_else(pc.match_substring(lowered, token.lower()), texts, apart)
        return self.pieces.of(pc.split_pattern(apart, " "), {})


def _word_texts(path: str) -> WordTexts:
    return for_worker(("packing", path), lambda: WordTexts(path))


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """piece_key, doc_id, piece, start, length and token_ids, written once as a table."""
    schema = "piece_key bigint, doc_id bigint, piece int, start bigint, length bigint, token_ids array<int>"
    names = [field.split()[0] for field in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        texts, key = _word_texts(tokenizer_path), TaskContext.get().partitionId() << 33
        for batch in batches_of_bytes(batches, 1):
            ids, many = with_end(*texts.ids(batch.column(1)), end_id)
            cuts = -(-many // capacity)
            owners = np.repeat(np.arange(len(many)), cuts)
            pieces = np.arange(len(owners)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            starts = pieces * capacity
            lengths = np.minimum(capacity, many[owners] - starts)
            keys = key + np.arange(len(owners), dtype=np.int64)
            key += len(owners)
            columns = [
                pa.array(keys), batch.column(0).take(pa.array(owners)), pa.array(pieces.astype(np.int32)),
                pa.array(starts), pa.array(lengths), id_lists(ids, lengths),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return written_table(narrow.mapInArrow(cut, schema))


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indexes: longest first, each into the fullest bin that has room.

    Open bins stand in a list per free space; a bit mask of the lists that hold any finds the
    least sufficient space at once.
    """
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                mask &= ~(1 << free)
            bins[at].append(i)
        else:
            at, free = len(bins), capacity
            bins.append([i])
        left = free - length
        if left:
            by_free[left].append(at)
            mask |= 1 << left
    return bins


class _Donors:
    """Pieces of the emptier bins by length."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.where: dict[int, list[tuple[int, int]]] = {}

    def add(self, length: int, bin_: int, piece: int) -> None:
        if not self.where.get(length):
            bisect.insort(self.sizes, length)
            self.where[length] = []
        self.where[length].append((bin_, piece))

    def drop(self, length: int, bin_: int, piece: int) -> None:
        held = self.where[length]
        held.remove((bin_, piece))
        if not held:
            self.sizes.pop(bisect.bisect_left(self.sizes, length))

    def at_most(self, length: int) -> int:
        i = bisect.bisect_right(self.sizes, length)
        return self.sizes[i - 1] if i else 0

    def pick(self, taken: list[int]) -> list[tuple[int, int]]:
        """Bin and piece for each length; two of the same length are two pieces."""
        return [self.where[t][-1 - taken[:k].count(t)] for k, t in enumerate(taken)]


def _best_exchange(donors: _Donors, own: list[int], gap: int) -> tuple[int, int, list[int]]:
    """What fills a gap most: the gain, the length given (0 for a move) and the lengths taken."""
    best = donors.at_most(gap), 0, [donors.at_most(gap)]
    for given in sorted(set(own)):
        if best[0] == gap:
            break
        room = gap + given
        one = donors.at_most(room)
        if one - given > best[0]:
            best = one - given, given, [one]
        for first in donors.sizes:
            second = donors.at_most(room - first)
            if not second or first > second:
                break
            if second == first and len(donors.where[first]) < 2:
                continue
            if first + second - given > best[0]:
                best = first + second - given, given, [first, second]
    return best


def swap_search(bins: list[list[int]], lengths: np.ndarray, capacity: int, sweeps: int = 20) -> list[list[int]]:
    """Local search over bins that are not full; every step raises the sum of squared fills.

    Fuller bins take, the emptier half gives: a piece, a longer piece for a shorter one, or
    two pieces for one, whichever fills the taker most. A bin that has given all is gone.
    """
    size = lengths.tolist()
    done = [b for b in bins if sum(size[i] for i in b) == capacity]
    held = [list(b) for b in bins if sum(size[i] for i in b) < capacity]
    for _ in range(sweeps):
        held = sorted((b for b in held if b), key=lambda b: -sum(size[i] for i in b))
        fill = [sum(size[i] for i in b) for b in held]
        half = max(1, len(held) // 2)
        donors = _Donors()
        for at in range(half, len(held)):
            for i in held[at]:
                donors.add(size[i], at, i)
        changed = False
        for taker in range(half):
            while (gap := capacity - fill[taker]) and donors.sizes:
                gain, given, taken = _best_exchange(donors, [size[i] for i in held[taker]], gap)
                if not gain:
                    break
                givers = donors.pick(taken)
                back = None
                if given:
                    rooms = [(fill[g] - sum(t for t, (h, _) in zip(taken, givers) if h == g) + given, g) for g, _ in givers]
                    room, back = min(rooms)
                    if room > min(capacity, fill[taker]):
                        break
                for length, (giver, piece) in zip(taken, givers):
                    donors.drop(length, giver, piece)
                    held[giver].remove(piece)
                    fill[giver] -= length
                    held[taker].append(piece)
                if back is not None:
                    piece = next(i for i in held[taker] if size[i] == given)
                    held[taker].remove(piece)
                    held[back].append(piece)
                    fill[back] += given
                    donors.add(given, back, piece)
                fill[taker] += gain
                changed = True
        full = [at for at in range(len(held)) if fill[at] == capacity]
        done += [held[at] for at in full]
        held = [b for at, b in enumerate(held) if b and fill[at] < capacity]
        if not changed or len(held) < 2:
            break
    return done + held


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of the indexes of ``lengths``."""
    return swap_search(best_fit(lengths, capacity), lengths, capacity)


def place_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, shard: int = 200_000, keep: float = 0.995
) -> DataFrame:
    """piece_key, sequence_id and offset of every piece, from its key and length.

    Sequence ids: a full piece has its own key; others the round, task and number of the bin.
    """
    narrow = pieces.select("piece_key", "length")
    full = narrow.filter(F.col("length") >= capacity).select(
        "piece_key", F.col("piece_key").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    schema = "piece_key bigint, length bigint, sequence_id bigint, offset bigint"
    placed, rest, turn, last = [full], narrow.filter(F.col("length") < capacity), 0, False
    while not last:
        turn += 1
        shards = -(-rest.count() // shard)
        last = shards <= 1

        def pack(batches: Iterator[pa.RecordBatch], turn: int = turn, last: bool = last) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            for_worker("placing", lambda: None)
            given = list(batches)
            if not any(batch.num_rows for batch in given):
                return
            held = pa.Table.from_batches(given).sort_by("piece_key")
            keys, lengths = held["piece_key"].to_numpy(), held["length"].to_numpy()
            base = (turn << 56) | (TaskContext.get().partitionId() << 32)
            rows: list[tuple] = []
            for number, members in enumerate(pack_lengths(lengths, capacity)):
                fill = int(lengths[members].sum())
                offset = 0
                for i in members:
                    sequence = base + number if last or fill >= keep * capacity else None
                    rows.append((int(keys[i]), int(lengths[i]), sequence, offset))
                    offset += int(lengths[i])
            columns = [pa.array(values, type=pa.int64()) for values in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["piece_key", "length", "sequence_id", "offset"])

        # A hash of the key in a given number of tasks: even, and the same when a task is lost.
        dealt = rest.repartition(max(shards, 1), F.xxhash64("piece_key", F.lit(turn)))
        packed = written_table(dealt.mapInArrow(pack, schema))
        placed.append(packed.filter("sequence_id IS NOT NULL").select("piece_key", "sequence_id", "offset"))
        left = packed.filter("sequence_id IS NULL").select("piece_key", "length")
        # Where little was placed, a further round of the same tasks would not end.
        if not last and left.count() > 0.9 * rest.count():
            keep = 0.0
        rest = left
    out = placed[0]
    for part in placed[1:]:
        out = out.union(part)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Every piece with its ids, its sequence and its place there."""
    pieces = cut_documents(docs, tokenizer_path, capacity, end_id)
    return pieces.join(place_pieces(pieces, capacity), "piece_key").drop("piece_key")
