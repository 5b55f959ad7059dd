"""ORC token files, byte-level BPE and packing against the tokenizers library."""

import functools
import hashlib
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

from logfreight.llm import packing, token_files
from logfreight.llm.bpe import LONG, Bpe
from logfreight.llm.queries import QUERIES
from logfreight.llm.texts import batches_of_bytes, library_tokenizer
from tests.llm import corpus

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["a", " ", " ", "\n", "\n", "\t", "é", "foo", "'s", "1", "23", "\xa0", "　", "<|endoftext|>",
         "!", "?!", "\x1c", "́", "日本", "\U0001f600", "the", "\r", "aaaaaaaaaa", "\x00", "<|ENDOFTEXT|>", "Foo", "é,", "K,", "ſ.", "İ"]


tokenizer_of = functools.lru_cache(library_tokenizer)


def ids_of(path, text):
    return tokenizer_of(path).encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def random_texts(many, parts):
    dice = random.Random(4)
    return ["".join(dice.choice(PARTS) for _ in range(dice.randint(0, parts))) for _ in range(many)]


@pytest.fixture(scope="module")
def cases(folder):
    return [*corpus.odd_documents(), *[(1000 + i, t, "en") for i, t in enumerate(random_texts(300, 14))],
            *[(5000 + i, t, lang) for i, t, lang in corpus.given(folder)]]


@pytest.fixture(scope="module")
def place(spark, cases, tmp_path_factory):
    return corpus.written(spark, tmp_path_factory.mktemp("tokens"), cases)


def test_bpe_equals_the_library():
    own, library = Bpe(BYTES), library_tokenizer(BYTES)
    texts = [*random_texts(2000, 14), "ab" * LONG, "".join(random.Random(1).choices("abcdeé", k=3 * LONG))]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_decodes_any_ids():
    own, library, dice = Bpe(BYTES), library_tokenizer(BYTES), random.Random(2)
    for _ in range(300):
        ids = [dice.randrange(50257) for _ in range(9)]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_kept_pieces_are_dropped_and_met_again():
    from logfreight.llm.bytelevel import ByteLevelTexts

    library = library_tokenizer(BYTES)
    texts = ByteLevelTexts(lambda many: [e.ids for e in library.encode_batch_fast(many, add_special_tokens=False)], ["<|endoftext|>"], limit=2000)
    for seed in range(5):
        batch = [None, *random_texts(40, 9), "a b c a b c", "  ", "x" * 3000 + " y", ""]
        random.Random(seed).shuffle(batch)
        ids, many = texts.ids(pa.array(batch, pa.string()))
        want = [ids_of(BYTES, text) for text in batch]
        assert many.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert texts.ids(pa.array([], pa.string()))[0].tolist() == []


def test_pieces_encoded_many_in_one_string():
    from logfreight.llm.bytelevel import ByteLevelTexts, JoinedPieces

    library, strings = library_tokenizer(BYTES), []

    def encode_many(many):
        strings.extend(many)
        return [e.ids for e in library.encode_batch_fast(many, add_special_tokens=False)]

    vocabulary = library.get_vocab(with_added_tokens=False)
    joined = JoinedPieces(encode_many, vocabulary, ["<|endoftext|>"])
    dice, odd = random.Random(6), [c for c in map(chr, range(0x3100)) if c.isspace()]
    ends = [*PARTS, *odd, "", "x", "'", "'s", "12", "\x00"]
    pieces = [dice.choice(["", " ", "\n", " ", "\n"]) + dice.choice(ends) + dice.choice(ends) for _ in range(30_000)]
    pieces = [p for p in pieces if "<|endoftext|>" not in p]
    ids, many = joined(pieces)
    want = [e.ids for e in library.encode_batch_fast(pieces, add_special_tokens=False)]
    assert many.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert len(strings) < len(pieces)
    assert [x.tolist() for x in joined([])] == [[], []]

    del strings[:]
    text = " ".join(f"word{i} of a text" for i in range(5000))
    for words in (vocabulary, {**vocabulary, "a": 50_000}):  # the second has lengths that do not fit
        ids, many = ByteLevelTexts(encode_many, ["<|endoftext|>"], vocabulary=words).ids(pa.array([text, None]))
        assert ids.tolist() == ids_of(BYTES, text) and many.tolist() == [len(ids), 0]
        if words is vocabulary:
            assert len(strings) < 50  # 5,003 pieces
    wrong = JoinedPieces(encode_many, {t: i for i, t in enumerate(["ab", "c"])}, [])
    assert wrong([" one", " two"])[0].tolist() == ids_of(BYTES, " one two")


def test_batches_by_bytes_lose_nothing():
    table = pa.table({"n": list(range(30)), "t": [None, "", "abc" * 9] * 10}).to_batches(max_chunksize=11)
    for most in (1, 20, 60, 10_000):
        parts = list(batches_of_bytes(iter(table), 1, most))
        assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(30))
        assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= most for p in parts)


def test_bpe_steps_equal_one_pass(spark, cases, place):
    from logfreight.llm import bpe

    docs = spark.read.parquet(f"{place}/documents.parquet")
    steps = bpe.digests(bpe.decode_texts(bpe.encode_texts(docs, BYTES), BYTES), BYTES)
    assert sorted(map(tuple, steps.collect()), key=repr) == sorted(map(tuple, bpe.round_trip(docs, BYTES).collect()), key=repr)


def test_bpe_query(spark, cases, place):
    hexed = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for doc_id, text, _ in cases:
        ids = ids_of(BYTES, text)
        want.append((doc_id, len(ids), hexed(",".join(map(str, ids))), hexed(text or "")))
    got = [tuple(r) for r in QUERIES["op3_bpe"](spark, place).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_token_files_query(spark, cases, place):
    order = sorted(cases, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for doc_id, text, _ in order:
        ids = [*ids_of(BYTES, text), 0]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = [tuple(r) for r in QUERIES["op1_token_files"](spark, place).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_token_files_are_pruned(spark, cases, tmp_path):
    docs = corpus.frame(spark, cases)
    token_files.write_token_files(docs, f"{tmp_path}/t", BYTES, partitions=3)
    rows = token_files.read_token_files(spark, f"{tmp_path}/t").filter("doc_id = 9")
    plan = rows._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "EqualTo(doc_id,9)" in plan
    assert [r["token_ids"] for r in rows.collect()] == [[*ids_of(BYTES, cases[8][1]), 0]]
    files = [f for f in os.listdir(f"{tmp_path}/t") if f.endswith(".orc")]
    assert len(files) > 1


def test_empty_tables(spark, tmp_path):
    place = corpus.written(spark, tmp_path, [])
    for name in ("op1_token_files", "op3_bpe", "op5_packing"):
        assert QUERIES[name](spark, place).count() == 0


def test_packing_query(spark, cases, place):
    want = defaultdict(int)
    for doc_id, text, _ in cases:
        ids = [*ids_of(WORDS, text), 0]
        for i in range(0, len(ids), 2048):
            want[doc_id, i // 2048, i, len(ids[i : i + 2048]), crc(ids[i : i + 2048])] += 1
    rows, got, bins = QUERIES["op5_packing"](spark, place).collect(), defaultdict(int), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


@pytest.mark.parametrize("seed", range(5))
def test_search_keeps_pieces_and_saves_bins(seed):
    dice = np.random.default_rng(seed)
    lengths = dice.integers(1, 100, 400)
    bins = packing.best_fit(lengths, 100)
    # A poor packing: each piece in a bin of its own.
    loose = packing.swap_search([[i] for i in range(400)], lengths, 100, sweeps=60)
    for packed in (bins, packing.swap_search(bins, lengths, 100), loose):
        assert sorted(i for b in packed for i in b) == list(range(400))
        assert all(lengths[b].sum() <= 100 for b in packed)
    assert len(loose) < 400 and len(packing.pack_lengths(lengths, 100)) <= len(bins)


def test_packing_rounds(spark):
    dice = random.Random(0)
    rows = [(i, dice.randint(1, 99)) for i in range(2000)]
    pieces = spark.createDataFrame(rows, "piece_key long, length long")
    placed = packing.place_pieces(pieces, capacity=100, shard=150).collect()
    fills = defaultdict(int)
    sizes = dict(rows)
    for r in placed:
        fills[r["sequence_id"]] += sizes[r["piece_key"]]
    assert len(placed) == 2000 and max(fills.values()) <= 100
    assert len(fills) <= 1.05 * sum(sizes.values()) / 100 + 1
