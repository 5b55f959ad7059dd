"""Language, toxicity and the language model: held-out quality, and brute-force recursions."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from logfreight.llm import hmm, language, toxicity
from logfreight.llm.queries import QUERIES
from logfreight.llm.texts import held_out
from tests.llm import corpus


def remainder(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    rows = corpus.odd_documents()
    labels = [(1, 1, 0), (2, None, 0), (3, 1, None), (9, 0, 1), (10, 1, 0), (10, 1, 1), (None, 1, 1), (77, 1, 1), (12, 0, 7)]
    return corpus.written(spark, tmp_path_factory.mktemp("models"), rows, labels)


def test_language_of_held_out_documents(spark, folder):
    told = {i: lang for i, _, lang in corpus.given(folder)}
    rows = [r for r in QUERIES["op2_language"](spark, folder).collect() if r["held_out"]]
    assert rows and all(remainder(r["doc_id"], 5) == 0 for r in rows)
    assert sum(told[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)


def test_language_of_odd_documents(spark, place):
    rows = QUERIES["op2_language"](spark, place).collect()
    assert len(rows) == len(corpus.odd_documents())
    assert all(0 <= r["score"] <= 1 for r in rows)
    letterless = {4, 5, 6, 15}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (r["doc_id"] in letterless) == (r["score"] == 0 and r["rejected"])
    known = {lang for _, _, lang in corpus.odd_documents()} | {"und"}
    assert {r["lang_pred"] for r in rows} <= known
    assert all(r["held_out"] for r in rows if r["doc_id"] is None)


def test_language_rejects_by_distance(spark, folder):
    model = language.train(spark.read.parquet(f"{folder}/documents.parquet"))
    texts = [(1, "zzqx xqzj wvkq zxqv qqzx jjxw vvzq " * 40, None), (2, corpus.given(folder)[0][1], None)]
    told = language.with_language(corpus.frame(spark, texts), model).orderBy("doc_id").collect()
    assert [r["lang_rejected"] for r in told] == [True, False]
    assert set(corpus.EXTRA) <= set(told[0].asDict())


def test_several_centroids_of_far_groups():
    rows = language.unit_rows(np.repeat(np.eye(4), 5, axis=0) + 0.01)
    middles = language.centroids_of(rows, 4)
    assert sorted(np.argmax(middles, axis=1).tolist()) == [0, 1, 2, 3]


def test_models_without_training_rows(spark, tmp_path):
    place = corpus.written(spark, tmp_path, [(None, "some text", None), (None, None, "en")])
    assert {(r["lang_pred"], r["score"]) for r in QUERIES["op2_language"](spark, place).collect()} == {("und", 0.0)}
    assert {(r["score"], r["predicted"]) for r in QUERIES["op6_toxicity"](spark, place).collect()} == {(0.0, 0)}
    rows = QUERIES["op9_hmm"](spark, place).collect()
    assert {(r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(3, 0, 0), (1, 0, 0)}


def test_empty_tables(spark, tmp_path):
    place = corpus.written(spark, tmp_path, [])
    for name in ("op2_language", "op6_toxicity", "op9_hmm"):
        assert QUERIES[name](spark, place).count() == 0


def brute_segments(scores):
    """Every maximal scoring subsequence by their definition, taken out best first."""
    found = []

    def search(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best and best[0] > 0:
            i, j = best[3], best[4]
            found.append((i, j, best[0]))
            search(a, i)
            search(j, b)

    search(0, len(scores))
    return sorted(found)


@pytest.mark.parametrize("seed", range(40))
def test_segments(seed):
    scores = np.random.default_rng(seed).normal(-0.2, 1, 24)
    got = toxicity.segments(scores)
    want = brute_segments(scores.tolist())
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_decay_solves_its_equation():
    values, weights = np.array([-2.0, 1.0]), np.array([0.8, 0.2])
    rate = toxicity._decay(values, weights)
    assert abs((weights * np.exp(rate * values)).sum() - 1) < 1e-6


def test_toxicity_of_planted_documents(spark, tmp_path):
    clean = [(i, f"{corpus.PROSE} number {i} " * 3, "en") for i in range(200)]
    bad = [(1000 + i, f"{corpus.PROSE} you vile grubnak {i} " * 2, "en") for i in range(60)]
    labels = [(i, 1, int(i >= 1000)) for i, *_ in clean + bad]
    place = corpus.written(spark, tmp_path, clean + bad, labels)
    rows = QUERIES["op6_toxicity"](spark, place).collect()
    assert all((r["predicted"] == 1) == (r["doc_id"] >= 1000) for r in rows)
    docs, marks = (spark.read.parquet(f"{place}/{n}.parquet") for n in ("documents", "labels"))
    found = toxicity.passages(docs, toxicity.train(docs, marks))
    assert {r["doc_id"] for r in found.collect()} == {i for i, *_ in bad}
    assert all("grubnak" in r["passage"] and r["e_value"] <= toxicity.PASSAGE_E for r in found.collect())


def test_toxicity_of_odd_documents(spark, place):
    rows = QUERIES["op6_toxicity"](spark, place).collect()
    assert len(rows) == len(corpus.odd_documents())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def small_model(states=3, symbols=6, seed=0):
    dice = np.random.default_rng(seed)
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    return hmm.Hmm(norm(dice.random(states), 0), norm(dice.random(states), 0),
                   norm(dice.random((states, states)), 1), norm(dice.random((symbols, states)), 0))


def path_sums(model, sequence, start):
    """Probability of every path of states."""
    for path in itertools.product(range(len(start)), repeat=len(sequence)):
        p = start[path[0]] * model.emit[sequence[0], path[0]]
        for t in range(1, len(sequence)):
            p *= model.move[path[t - 1], path[t]] * model.emit[sequence[t], path[t]]
        yield path, p


def test_forward_equals_the_sum_over_paths():
    model = small_model()
    sequences = [np.array(s) for s in ([0], [1, 2, 3], [5, 5, 0, 1, 4], [2, 1])]
    want = [math.log10(sum(p for _, p in path_sums(model, s, model.start))) for s in sequences]
    assert np.allclose(hmm.log_likelihoods(model, sequences), want)


def test_expected_counts_equal_sums_over_paths():
    model, sequences = small_model(), [np.array([1, 2, 3]), np.array([5, 0]), np.array([4])]
    first = np.array([True, False, True])
    begin, moves, emitted = np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))
    for s, opens in zip(sequences, first):
        paths = list(path_sums(model, s, model.start if opens else model.middle))
        whole = sum(p for _, p in paths)
        for path, p in paths:
            begin[path[0]] += opens * p / whole
            for t, state in enumerate(path):
                emitted[s[t], state] += p / whole
                if t:
                    moves[path[t - 1], state] += p / whole
    got = hmm.expected_counts(model, sequences, first)
    for a, b in zip(got, (begin, moves, emitted)):
        assert np.allclose(a, b, atol=1e-5)


def test_language_model_query(spark, tmp_path):
    options = hmm.HmmOptions(states=2, head=20, classes=4, start_docs=8, start_passes=2, passes=2, longest=50)
    rows = [r for r in corpus.odd_documents() if len(r[1] or "") < 10_000]
    docs = corpus.frame(spark, rows)
    model = hmm.train(docs, options)
    got = hmm.score(docs, model, options).collect()
    kept = [r for r in rows if r[0] is not None and remainder(r[0], 7) != 2]
    counts = Counter(w for _, text, _ in kept for w in hmm.words_of(text))
    n, v = sum(counts.values()) + len(kept), len(counts) + 1
    assert len(got) == len(rows) and len(model.alphabet.head) <= 20

    def base(words):
        known = [counts[w] for w in words] + [len(kept)]
        return len(known), sum(c > 0 for c in known), sum(math.log10((c + 1) / (n + v + 1)) for c in known)

    want = sorted((repr(i), *[round(x, 6) for x in base(hmm.words_of(t))]) for i, t, _ in rows)
    assert sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n}
    assert all(r["held_out"] == (r["doc_id"] is None or remainder(r["doc_id"], 7) == 2) for r in got)
    # The chain with the share of each word within its class is a distribution over texts.
    alphabet, chain = model.alphabet, model.hmm
    within = alphabet.class_counts + alphabet.class_words + 1.0
    offset = len(alphabet.head)
    whole = chain.emit.copy()
    whole[offset : offset + len(within)] *= within[:, None]
    assert np.allclose(whole.sum(axis=0), 1) and np.allclose(chain.move.sum(axis=1), 1)
    symbols = hmm.Symbols(alphabet)
    expected = []
    for i, text, _ in rows:
        words = hmm.words_of(text)
        known = np.array([symbols[w] for w in words] + [alphabet.symbols - 1])
        rare = sum(math.log10(counts[w] + 1) for w in words if w not in symbols)
        expected.append((repr(i), round(float(hmm.log_likelihoods(chain, [known])[0]) + rare, 5)))
    assert sorted((repr(r["doc_id"]), round(r["score"], 5)) for r in got) == sorted(expected)


def test_every_iteration_of_training_reads_all_documents(spark):
    rows = [(i, f"text number {'abcdefghij'[i % 10] * 3} of many {'klmnop'[i % 6] * 4} " * (1 + i % 5), "en") for i in range(300)]
    options = hmm.HmmOptions(states=2, head=20, classes=4, start_docs=8, start_passes=2, passes=2, tolerance=0)
    told = hmm.train(corpus.frame(spark, rows), options).likelihoods
    assert len(told) == 4 and told == sorted(told)
    kept = [r for r in rows if remainder(r[0], 7) != 2]
    assert told[0] < -0.3 * sum(len(hmm.words_of(text)) for _, text, _ in kept)


def test_language_model_beats_its_base_on_held_out_texts(spark, folder):
    rows = [r for r in QUERIES["op9_hmm"](spark, folder).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_language_frequencies_count_all_training_documents(spark):
    rows = [(i, f"text number {'abcdefghij'[i % 10] * 3} of many {'klmnop'[i % 6] * 4}", "en" if i % 9 else "fr") for i in range(300)]
    docs = corpus.frame(spark, rows)
    held = {r["doc_id"] for r in docs.filter(held_out(docs["doc_id"], language.FOLDS, 0)).collect()}
    training = [language.gram_counts(text)[0] > 0 for i, text, _ in rows if i not in held]
    want = np.log((1 + len(training)) / (1 + np.sum(training, axis=0))) + 1
    assert np.allclose(language.train(docs, bound=5).weights, want)
