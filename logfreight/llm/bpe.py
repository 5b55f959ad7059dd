"""Byte-level BPE by a contiguous rank array, and its decoding.

A word is held as a list of part boundaries and a list of the ranks of adjacent pairs. The
lowest rank is found by a scan, its inner boundary is deleted, and the ranks on both sides are
refreshed. That is the fastest way for short words, where a scan costs less than a heap. Long
runs without a break would cost the square of their length, so words over ``LONG`` bytes keep
the same pairs in a heap over linked parts; both take the leftmost of equal ranks.

Null text is an empty text (no ids). Every input row gives one row, repeated rows and rows with
a null doc_id too; an empty table gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.bytelevel import ByteLevelTexts
from logfreight.llm.texts import batches_of, batches_of_bytes, for_worker, id_lists

DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
DIGEST_NAMES = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
LONG = 200
NEVER = 1 << 40
# Words whose ids are kept until there are so many.
KNOWN_WORDS = 50_000
# White space as Unicode's property has it.
SPACE = r"\t-\r \x85\xa0  -     　"
# The pre-tokenizer's pattern, with that class written out.
WORDS = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_names() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """A byte-level BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        names = byte_names()
        as_bytes = lambda name: bytes(map(names.__getitem__, name))
        vocabulary = told["model"]["vocab"]
        ids = {as_bytes(name): i for name, i in vocabulary.items() if all(c in names for c in name)}
        pairs = [p.split(" ") if isinstance(p, str) else p for p in told["model"]["merges"]]
        # Ranks of pairs of ids, and the id that each rank's pair becomes.
        self.ranks = {vocabulary[a] << 20 | vocabulary[b]: r for r, (a, b) in enumerate(pairs)}
        self.merged = [vocabulary[a + b] for a, b in pairs]
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = 1 + max([*ids.values(), *self.added.values()])
        self.bytes_of = [b""] * size
        for token, i in ids.items():
            self.bytes_of[i] = token
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
        self.known: dict[str, list[int]] = {}
        self.words = regex.compile(WORDS)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None

    def encode_word(self, word: bytes) -> list[int]:
        if len(word) > LONG:
            return self._encode_long(word)
        # A boundary lies between neighbours in ``parts``, and its rank at the same index.
        parts = [self.byte_ids[b] for b in word]
        get, merged = self.ranks.get, self.merged
        ranks = [get(a << 20 | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) != NEVER:
            at = ranks.index(lowest)
            part = parts[at] = merged[lowest]
            del parts[at + 1], ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] << 20 | part, NEVER)
            if at < len(ranks):
                ranks[at] = get(part << 20 | parts[at + 1], NEVER)
        return parts

    def _encode_long(self, word: bytes) -> list[int]:
        n, get = len(word), self.ranks.get
        part = [self.byte_ids[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def rank(i: int) -> int:
            return get(part[i] << 20 | part[after[i]], NEVER) if after[i] < n else NEVER

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) < NEVER]
        heapq.heapify(heap)
        while heap:
            lowest, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != lowest:
                continue
            gone = after[i]
            alive[gone], after[i], part[i] = False, after[gone], self.merged[lowest]
            if after[i] < n:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (r := rank(j)) < NEVER:
                    heapq.heappush(heap, (r, j))
        return [part[i] for i in range(n) if alive[i]]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.added:
                out.append(self.added[part])
            else:
                for word in self.words.findall(part):
                    out += self.known.get(word) or self._learn(word)
        return out

    def _learn(self, word: str) -> list[int]:
        ids = self.encode_word(word.encode())
        if len(word) <= 40:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(text) for text in texts]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _kept(path: str) -> tuple[Bpe, ByteLevelTexts, list[str]]:
    def make() -> tuple[Bpe, ByteLevelTexts, list[str]]:
        bpe = Bpe(path)
        texts = ByteLevelTexts(bpe.encode_many, list(bpe.added), 48_000_000)
        return bpe, texts, [str(i) for i in range(len(bpe.bytes_of))]

    return for_worker(("bpe", path), make)


def _lists(column: pa.ListArray) -> list[list[int]]:
    """A list column as Python lists, by way of one flat list."""
    flat = column.flatten().to_numpy().tolist()
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy()).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def encode_texts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and token_ids of every text."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = _kept(tokenizer_path)[1]
        for batch in batches_of_bytes(batches, 1):
            lists = id_lists(*texts.ids(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "token_ids"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(encode, "doc_id bigint, token_ids array<int>")


def decode_texts(tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """Add the decoded text of ``token_ids``; bytes that are no UTF-8 become U+FFFD."""
    schema = "doc_id bigint, token_ids array<int>, decoded string"

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _kept(tokenizer_path)[0]
        for batch in batches_of(batches, 500):
            texts = [bpe.decode(ids) for ids in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, type=pa.string())],
                names=["doc_id", "token_ids", "decoded"],
            )

    return tokens.select("doc_id", "token_ids").mapInArrow(decode, schema)


def _digest_columns(lists: list[list[int]], texts: list[str], decimals: list[str]) -> list[pa.Array]:
    hexed = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return [
        pa.array([len(ids) for ids in lists], type=pa.int64()),
        pa.array([hexed(",".join(map(decimals.__getitem__, ids))) for ids in lists], type=pa.string()),
        pa.array(map(hexed, texts), type=pa.string()),
    ]


def round_trip(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``digests`` of what ``decode_texts`` makes of ``encode_texts``, in one pass over each text.

    Ids and decoded texts stay in the task, so a core runs one Python worker, not three.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, texts, decimals = _kept(tokenizer_path)
        for batch in batches_of_bytes(batches, 1):
            lists = _lists(id_lists(*texts.ids(batch.column(1))))
            columns = _digest_columns(lists, [bpe.decode(ids) for ids in lists], decimals)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=DIGEST_NAMES)

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, DIGESTS)


def digests(decoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of decoded rows."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimals = _kept(tokenizer_path)[2]
        for batch in batches_of(batches, 500):
            columns = _digest_columns(_lists(batch.column(1)), batch.column(2).to_pylist(), decimals)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=DIGEST_NAMES)

    return decoded.select("doc_id", "token_ids", "decoded").mapInArrow(digest, DIGESTS)
