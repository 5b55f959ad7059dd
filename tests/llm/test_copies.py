"""Near copies, repeated passages and fingerprints against brute force."""

import hashlib
import math
import pathlib
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from logfreight import session
from logfreight.llm import components, probminhash, rolling, suffix_dedup, suffixes, winnowing
from logfreight.llm.queries import QUERIES
from tests.llm import corpus


def copies_and_families():
    dice = random.Random(7)
    word = lambda: "".join(dice.choices("abcdefgh", k=5))
    rows = []
    for family in range(12):
        words = [word() for _ in range(150)]
        for copy in range(8):
            own = list(words)
            for _ in range(copy):
                own[dice.randrange(150)] = word()
            rows.append((family * 100 + copy, " ".join(own), "en"))
        rows.append((family * 100 + 50, " ".join(words), "en"))
    return rows


@pytest.fixture(scope="module")
def cases(folder):
    return [*corpus.odd_documents(), *[(10_000 + i, t, lang) for i, t, lang in copies_and_families()],
            *[(50_000 + i, t, lang) for i, t, lang in corpus.given(folder)]]


@pytest.fixture(scope="module")
def place(spark, cases, tmp_path_factory):
    return corpus.written(spark, tmp_path_factory.mktemp("copies"), cases)


def brute_classes(rows):
    """Class and component of each row by comparing all pairs that share a run of words."""
    docs = [probminhash.shingles(text) for _, text, _ in rows]
    where = {}
    for i, (hashes, _) in enumerate(docs):
        for h in hashes.tolist():
            where.setdefault(h, []).append(i)
    above = list(range(len(rows)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, (hashes, _) in enumerate(docs):
        for j in {j for h in hashes.tolist() for j in where[h] if j < i}:
            if probminhash.linked(docs[i], docs[j]) and top(i) != top(j):
                above[top(i)] = top(j)
    least = {}
    for i, (doc_id, _, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), math.inf), math.inf if doc_id is None else doc_id)
    return [(None if math.isinf(least[top(i)]) else least[top(i)], top(i)) for i in range(len(rows))]


def test_near_duplicates(spark, cases, place):
    want = Counter((doc_id, c) for (doc_id, _, _), (c, _) in zip(cases, brute_classes(cases)))
    rows = QUERIES["op4_probminhash"](spark, place).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in rows) == want
    assert all(r["is_kept"] == (r["doc_id"] == r["class_id"]) for r in rows)


def test_one_of_each(spark, cases):
    kept = probminhash.one_of_each(corpus.frame(spark, cases)).collect()
    classes = brute_classes(cases)
    worded = {c for r, (_, c) in zip(cases, classes) if (r[1] or "").split()}
    assert len(kept) == len(worded) + sum(not (r[1] or "").split() for r in cases)
    assert all(set(r.asDict()) == set(corpus.SCHEMA.names) for r in kept)


def test_near_copies_under_null_ids(spark):
    words = [f"word{i}" for i in range(200)]
    rows = [(None, " ".join(words), "en"), (7, " ".join(words[:-1]), "en"), (None, " ".join(words[1:]), "en"), (8, "another text", "en")]
    docs = corpus.frame(spark, rows)
    found = probminhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in found) == Counter((i, c) for (i, _, _), (c, _) in zip(rows, brute_classes(rows)))
    assert sorted(r["doc_id"] for r in probminhash.one_of_each(docs).collect()) == [7, 8]


def test_copies_with_a_run_repeated_often(spark):
    rows = []
    for pair in range(60):
        words = [f"w{pair}x{i}" for i in range(32)]
        line = [f"line{pair}x{i}" for i in range(5)]
        rows += [(2 * pair, " ".join(line * 1000 + words), "en"), (2 * pair + 1, " ".join(line + words), "en")]
    assert all(probminhash.linked(*(probminhash.shingles(t) for _, t, _ in rows[i : i + 2])) for i in range(0, 120, 2))
    found = probminhash.near_duplicates(corpus.frame(spark, rows)).collect()
    assert all(r["class_id"] == r["doc_id"] // 2 * 2 for r in found)


def test_estimate_of_probability_jaccard():
    dice = np.random.default_rng(3)
    elements = dice.integers(0, 2**63, 300).astype(np.uint64)
    a, b = np.sort(elements[:200]), np.sort(elements[60:])
    wa, wb = dice.integers(1, 5, 200).astype(float), dice.integers(1, 5, 240).astype(float)
    exact = probminhash.probability_jaccard(a, wa, b, wb)
    x = dict(zip(a.tolist(), wa))
    y = dict(zip(b.tolist(), wb))
    brute = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())
    assert abs(exact - brute) < 1e-9
    agree = probminhash.prob_min_hash(a, wa, 4096) == probminhash.prob_min_hash(b, wb, 4096)
    assert abs(agree.mean() - exact) < 4 * math.sqrt(exact * (1 - exact) / 4096)


def test_sketches_of_few_elements_fill_all_slots():
    for n in (1, 2, 7):
        owner = probminhash.prob_min_hash(np.arange(1, n + 1).astype(np.uint64), np.ones(n))
        assert set(owner.tolist()) <= set(range(1, n + 1))


def test_odd_classes_bound_what_only_one_document_has():
    dice = np.random.default_rng(8)
    for _ in range(300):
        base = np.unique(dice.integers(0, 2**32, dice.integers(1, 6000)).astype(np.uint32))
        a, b = (np.unique(base[dice.random(len(base)) < dice.uniform(0.5, 1)]) for _ in range(2))
        bits = [np.unpackbits(probminhash.odd_classes(h).view(np.uint8)) for h in (a, b)]
        apart = int((bits[0] != bits[1]).sum())
        assert apart <= len(np.setxor1d(a, b)) and len(bits[0]) == probminhash.CLASSES
        if len(a) and len(b):
            most = int(dice.choice([2, 3, 1000]))
            wa, wb = (probminhash.weights_of(np.where(dice.random(len(h)) < 0.2, dice.integers(1, most, len(h)), 1)) for h in (a, b))
            alike = probminhash.probability_jaccard(a, wa, b, wb)
            shares = wa[~np.isin(a, b)].sum() / wa.sum() + wb[~np.isin(b, a)].sum() / wb.sum()
            assert apart <= shares * max(wa.sum(), wb.sum()) + 1e-9
            assert shares <= 2 * (1 - alike) / (1 + alike) + 1e-9


def variants_of_one_text(n, often):
    """n texts with some words of one text changed, some near copies of each other, most a little too far."""
    dice = random.Random(12)
    word = lambda: "".join(dice.choices("abcdefgh", k=6))
    base, line, rows = [word() for _ in range(150)], [word() for _ in range(6)], []
    for i in range(n):
        words = list(base)
        for place in dice.sample(range(150), 3):
            words[place] = word()
        rows.append((i, " ".join(words + line * often), "en"))
    return rows


@pytest.mark.parametrize("often", [0, 3])
def test_variants_a_little_too_far_leave_few_pairs_to_verify(spark, monkeypatch, often):
    rows, left, across = variants_of_one_text(150, often), [], probminhash._across

    def counted(*tables):
        left.append(across(*tables).count())
        return across(*tables)

    monkeypatch.setattr(probminhash, "_across", counted)
    found = probminhash.near_duplicates(corpus.frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in found) == Counter((i, c) for (i, _, _), (c, _) in zip(rows, brute_classes(rows)))
    assert len({r["class_id"] for r in found}) > len(rows) / 2
    assert left[0] < len(rows)


def test_components_of_a_long_path(spark):
    edges = [(bytes([i // 256, i % 256]), bytes([(i + 1) // 256, (i + 1) % 256])) for i in range(300) if i != 150]
    found = components.components(spark.createDataFrame(edges, "a binary, b binary")).collect()
    sizes = Counter(bytes(r["component"]) for r in found)
    assert sorted(sizes.values()) == [150, 151] and len(found) == 301


def brute_removal(rows):
    data = [(doc_id, (text or "").encode()) for doc_id, text, _ in rows]
    first = {}
    for doc_id, b in data:
        if doc_id is not None:
            for k in range(len(b) - 49):
                first[b[k : k + 50]] = min(first.get(b[k : k + 50], doc_id), doc_id)
    out = Counter()
    for doc_id, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if doc_id is not None and first[b[k : k + 50]] < doc_id:
                gone[k : k + 50] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_suffix_dedup_query(spark, cases, place):
    rows = QUERIES["op10_suffix_dedup"](spark, place).collect()
    assert Counter(tuple(r) for r in rows) == brute_removal(cases)


@pytest.mark.parametrize("hot", [1, 3])
def test_suffix_dedup_in_many_ranges_with_hot_anchors(spark, cases, hot):
    docs = corpus.frame(spark, cases).repartition(5, "doc_id")
    kept = suffix_dedup.without_repeats(docs, task_bytes=60_000, hot=hot)
    rows = kept.select("doc_id", "_removal.*").collect()
    got = Counter((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in map(tuple, rows))
    assert got == brute_removal(cases)


def around_one_anchor(n):
    """n documents with 15 bytes before an anchor in common, one of which shares what follows with one more."""
    dice = random.Random(11)
    letters = lambda k: "".join(dice.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    found = lambda text: suffix_dedup.anchors(np.frombuffer(text.encode(), np.uint8))
    while found(passage := letters(suffix_dedup.LENGTH))[0][0] != 0:
        pass
    anchor, before = passage[: suffix_dedup.GRAM], letters(suffix_dedup.SIDE)

    def text(left, right):
        """No other anchor's context has all of the passage."""
        place = 60 + len(left)
        while True:
            made = letters(60) + left + right + letters(60)
            at = found(made)[0] - place
            if 0 in at and (right == anchor or not ((at > 0) & (at <= suffix_dedup.REACH)).any()):
                return made

    rows = [(i, text(before, anchor), "en") for i in range(n)]
    return [*rows, (n, text(before, passage), "en"), (n + 1, text("", passage), "en")]


@pytest.mark.parametrize("task_bytes", [50, 120, 400])
def test_suffix_dedup_of_an_anchor_in_many_flushes(spark, task_bytes):
    rows = around_one_anchor(20)
    full = [(i, t, lang, None, None, *corpus.EXTRA) for i, t, lang in rows]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(full, len(full)), corpus.SCHEMA)
    assert docs.rdd.getNumPartitions() == len(rows)  # one context of the anchor in each flush
    kept = suffix_dedup.without_repeats(docs, task_bytes=task_bytes, hot=1).select("doc_id", "_removal.*").collect()
    got = Counter((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in map(tuple, kept))
    assert got == brute_removal(rows)
    assert sum(r["n_removed"] for r in kept) >= suffix_dedup.LENGTH


def test_a_common_line_gives_a_task_one_piece_of_each_group(spark):
    dice = random.Random(4)
    letters = lambda k: "".join(dice.choices("abcdefghijklmnopqrstuvwxyz ", k=k))
    line = letters(60)
    rows = [(i, letters(80) + line + letters(80), "en") for i in range(200)]
    docs, ranges, groups = corpus.frame(spark, rows), 5, 4
    known = suffix_dedup.judged(suffix_dedup.anchor_table(docs, ranges, groups, 1), ranges, groups, 1)
    asked = known.filter(known["what"] == suffix_dedup.QUESTION).select("_grp", "blob")
    sent = suffix_dedup.contexts(docs, asked, ranges, groups).filter(f"to < {ranges}").collect()
    pieces = np.frombuffer(b"".join(bytes(r["blob"]) for r in sent), suffix_dedup.PIECE)
    owners = {}
    for p in pieces:
        owners.setdefault(p["bytes"].tobytes()[:50], set()).add(p["doc"])
    assert line[:50].encode() in owners and max(map(len, owners.values())) <= groups
    kept = suffix_dedup.without_repeats(docs, task_bytes=10_000, hot=1).select("doc_id", "_removal.*").collect()
    got = Counter((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in map(tuple, kept))
    assert got == brute_removal(rows)


def shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for folder in folders for f in pathlib.Path(str(folder)).rglob("shuffle_*.data")}


def test_suffix_dedup_frees_the_shuffles_of_its_steps(spark, cases):
    docs, before = corpus.frame(spark, cases), shuffle_files(spark)
    kept = suffix_dedup.without_repeats(docs, task_bytes=60_000)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(session.FREED) == "false"
    rows = kept.select("doc_id", "_removal.*").collect()
    assert Counter((*r[:4], hashlib.sha256(bytes(r[4])).hexdigest()) for r in map(tuple, rows)) == brute_removal(cases)


def test_suffix_dedup_keeps_texts_of_any_name_and_type(spark, cases):
    docs = corpus.frame(spark, cases)
    for given in (docs.withColumnRenamed("text", "Text"), docs.withColumn("text", docs["text"].cast("binary"))):
        kept, given = suffix_dedup.without_repeats(given), given.drop("_removal")
        assert kept.schema.fields[:-1] == given.schema.fields and kept.columns[-1] == "_removal"
        same = lambda rows: Counter(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in rows)
        assert same(kept.drop("_removal").collect()) == same(given.collect())


def test_packed_entries_are_small_and_come_back():
    dice = np.random.default_rng(31)
    for kind in (suffix_dedup.ENTRY, suffix_dedup.SPAN):
        for n in (1, 2, 300, 5000):
            entries = np.frombuffer(dice.bytes(n * kind.itemsize), kind).copy()
            for order in (["h1"], ["doc"], ["lo" if "lo" in kind.names else "kind"]):
                own = np.sort(entries, order=order)
                assert suffix_dedup._unpacked(suffix_dedup._packed(own), kind).tobytes() == own.tobytes()
    entries = np.zeros(100_000, suffix_dedup.ENTRY)
    for name, most in (("h1", 1 << 64), ("h2", 1 << 32), ("left", 1 << 16), ("right", 1 << 16)):
        entries[name] = dice.integers(0, most, len(entries), entries[name].dtype)
    entries["doc"] = np.arange(len(entries)) // 200
    sent = [blob for _, blob in suffix_dedup._sent(entries, 40, 40, 500)]
    assert sum(map(len, sent)) <= 19 * len(entries)
    # Covered contexts need not be told apart but in their texts.
    copies = np.concatenate([entries, entries])
    copies["doc"][len(entries) :] += 1000
    assert sum(len(blob) for _, blob in suffix_dedup._sent(copies, 40, 40, 500)) - sum(map(len, sent)) <= 11 * len(entries)


def test_anchors_of_a_lot_are_those_of_each_text():
    dice = np.random.default_rng(21)
    texts = [dice.integers(97, 97 + span, n).astype(np.uint8) for span, n in zip([1, 2, 26, 26, 3] * 8, dice.integers(50, 400, 40))]
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    which, at, h1, h2, begin, end, left, right = suffix_dedup.anchors_of(np.concatenate(texts), edges)
    for i, text in enumerate(texts):
        own = which == i
        got = at[own] - edges[i], h1[own], h2[own], begin[own] - edges[i], end[own] - edges[i]
        for a, b in zip(got, suffix_dedup.anchors(text)):
            assert a.tolist() == b.tolist()
        assert (left[own] > 0).tolist() == (got[0] >= suffix_dedup.SIDE).tolist()
        assert (right[own] > 0).tolist() == (got[0] + suffix_dedup.GRAM + suffix_dedup.SIDE <= len(text)).tolist()


def test_repeats_are_found_without_ranking_strings_that_one_owner_has(monkeypatch):
    dice, ranked = np.random.default_rng(22), []
    pieces = np.zeros(300, suffix_dedup.PIECE)
    pieces["bytes"] = dice.integers(97, 123, (300, suffix_dedup.WIDTH))
    pieces["doc"], pieces["key"], pieces["size"] = np.arange(300), 7, suffix_dedup.WIDTH
    pieces["bytes"][200, 10:65] = pieces["bytes"][100, 5:60]
    found = suffix_dedup.repeats_of_earlier
    monkeypatch.setattr(suffix_dedup, "repeats_of_earlier", lambda data, *rest: ranked.append(len(data)) or found(data, *rest))
    spans = suffix_dedup.covered_spans(pieces)
    assert spans[["doc", "lo", "hi"]].tolist() == [(200, 10, 65)]
    assert ranked == [2 * suffix_dedup.WIDTH]


def test_a_flush_of_anchors_and_a_batch_of_texts_take_little_memory():
    dice = np.random.default_rng(23)
    entries = np.zeros(suffix_dedup.FLUSH, suffix_dedup.ENTRY)
    entries["h1"] = dice.integers(0, 1 << 63, len(entries))
    none = suffix_dedup._Lookup(entries[:0])
    table = pa.table({"doc_id": np.arange(1000), "text": [chr(97 + i % 26) * 4000 for i in range(1000)]})
    tracemalloc.start()
    try:
        most = max(b.nbytes for b in suffix_dedup._batches(suffix_dedup._sent(entries, 40, 40, 500), "to"))
        sent = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        made = suffix_dedup._removed(table.to_batches()[0], none, none)
        removed = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most <= 2 * suffix_dedup.BLOB_BYTES and sent <= 60 << 20
    assert removed <= 24 << 20
    assert made.field("kept").to_pylist() == [t.encode() for t in table["text"].to_pylist()]


def test_nearest_smaller_values():
    dice = np.random.default_rng(1)
    for _ in range(100):
        n = int(dice.integers(1, 50))
        values, runs = dice.integers(0, 6, n), np.sort(dice.integers(0, 4, n))
        before, after = suffixes.previous_smaller(values, runs), suffixes.next_smaller(values, runs)
        for i in range(n):
            low = [j for j in range(n) if runs[j] == runs[i] and values[j] < values[i]]
            assert before[i] == max([j for j in low if j < i], default=-1)
            assert after[i] == min([j for j in low if j > i], default=-1)


def test_suffix_ranks():
    data = np.random.default_rng(1).integers(97, 99, 3000).astype(np.uint8)
    data[2000:2200] = data[100:300]
    starts = np.arange(2950)
    texts = [data[i : i + 50].tobytes() for i in starts]
    order = {t: i for i, t in enumerate(sorted(set(texts)))}
    assert [order[t] for t in texts] == suffixes.suffix_ranks(data, starts, 50).tolist()


def brute_winnow(text, k, w):
    points = rolling.code_points(text)
    hashes = [int(h) >> 32 for h in rolling.gram_hashes(points, min(k, len(points)))]
    w = min(w, max(1, len(hashes) // winnowing.SHORT))
    chosen = {max(range(i, min(i + w, len(hashes))), key=lambda j: (-hashes[j], j)) for i in range(max(1, len(hashes) - w + 1))}
    return [(hashes[j], j) for j in sorted(chosen)]


def test_fingerprints(cases):
    for _, text, _ in cases[:80]:
        if text and len(text) < 5000:
            hashes, places = winnowing.fingerprint(text)
            assert list(zip(hashes.tolist(), places.tolist())) == brute_winnow(text, winnowing.K, winnowing.W)


def test_shared_passages_share_a_hash():
    dice = random.Random(5)
    letters = lambda n: "".join(dice.choices("abcdefghij ", k=n))
    for _ in range(50):
        passage = letters(winnowing.K + winnowing.W - 1)
        a, b = (letters(dice.randint(0, 900)) + passage + letters(dice.randint(0, 900)) for _ in range(2))
        assert set(winnowing.fingerprint(a)[0].tolist()) & set(winnowing.fingerprint(b)[0].tolist())


def test_gram_hashes_tell_equal_grams():
    text = "abcabcabcxabcabc"
    hashes = rolling.gram_hashes(rolling.code_points(text), 3)
    for i in range(len(hashes)):
        for j in range(len(hashes)):
            assert (hashes[i] == hashes[j]) == (text[i : i + 3] == text[j : j + 3])


def test_winnowing_query(spark, cases, place):
    order = sorted(cases, key=lambda r: ((r[0] is None), -(r[0] or 0), (r[1] or "").encode()))
    want = Counter()
    for i, (doc_id, text, _) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        sets = [set(winnowing.fingerprint(t)[0].tolist()) for t in (text, edited, following)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *(round(x, 9) for x in near)] += 1
    rows = QUERIES["op8_winnowing"](spark, place).collect()
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in rows)
    assert got == want
    marks = {}
    texts = {r[0]: r[1] for r in cases if [c[0] for c in cases].count(r[0]) == 1}
    for r in rows:
        if r["doc_id"] in texts:
            assert marks.setdefault(texts[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]


def test_winnowing_loses_no_row_of_many_ranges(spark):
    from pyspark.sql import functions as F

    ids = spark.range(0, 300_000, 1, 16).select((F.xxhash64("id") % 10**12).alias("doc_id"))
    docs = ids.withColumn("text", F.concat(F.lit("text "), F.col("doc_id").cast("string")))
    rows = winnowing.edited_fingerprints(docs, partitions=40).select("doc_id", "edited_sha256", "n_chars")
    order = sorted((r["doc_id"] for r in docs.select("doc_id").collect()), reverse=True)
    got = {r["doc_id"]: r["edited_sha256"] for r in rows.collect()}
    assert len(got) == len(order) == 300_000
    for i in [0, 299_999, *range(0, 300_000, 97)]:
        text, following = f"text {order[i]}", f"text {order[(i + 1) % 300_000]}"
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[order[i]] == hashlib.sha256(edited.encode()).hexdigest()


def test_empty_and_single_tables(spark, tmp_path):
    none = corpus.written(spark, tmp_path / "none", [])
    one = corpus.written(spark, tmp_path / "one", [(5, "alone " * 30, "en")])
    for name in ("op4_probminhash", "op8_winnowing", "op10_suffix_dedup"):
        assert QUERIES[name](spark, none).count() == 0
        assert QUERIES[name](spark, one).count() == 1
    row = QUERIES["op8_winnowing"](spark, one).first()
    assert row["near_next"] == 1.0
