"""A hidden Markov language model: Baum-Welch counts from all partitions, exact likelihoods.

Tokens are the words of a text (A-Z in lower case, cut at ASCII white space) and one end. The
alphabet of the chain is bounded: the most frequent words (at most ``head``) each have a symbol
of their own, all others share ``classes`` symbols by their last three bytes, and the end has
one. A word of a class has probability (c + 1) / (N_t + V_t + 1) within it, from the counts of
its class over the whole corpus; what is left is that of any unknown word. So the model gives a
probability to every text, the counts it needs grow with the corpus, and only tables of a fixed
size (head, classes, states) are sent to tasks. Counts of rarer words are joined.

Training begins with every document in a state by chance, and every iteration (``start_passes``
and ``passes``, one after the other) reads all training documents: their symbols are written once
as a table. Training ends earlier where an iteration gains less than ``tolerance`` of the log
likelihood. Each task sends the expected counts of its own documents. Training
cuts sequences after ``longest`` tokens and lets the next piece begin from the mean state;
scoring never cuts: its scaled forward recursion runs over the whole text.

Null text is an empty text: one token, the end. Null doc_id is held out. Repeated rows count
and are scored each on their own. With no training rows every count is 0 and N is 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.texts import batches_of, held_out
from logfreight.session import written_table

SUFFIX = 3


@dataclass(frozen=True)
class HmmOptions:
    states: int = 8
    head: int = 65_536
    classes: int = 1024
    # Without effect: no iteration reads a sample.
    start_docs: int = 1024
    start_passes: int = 8
    passes: int = 2
    tolerance: float = 0.01
    prior: float = 500.0
    longest: int = 2048
    chunk_tokens: int = 2_000_000
    folds: int = 7
    held_out_fold: int = 2


@dataclass
class Hmm:
    """Parameters, and the symbols of words. ``emit`` is (symbols, states)."""

    start: np.ndarray
    middle: np.ndarray
    move: np.ndarray
    emit: np.ndarray


@dataclass
class Alphabet:
    """The head with its counts, and per class the count and the number of its words."""

    head: dict[bytes, int]
    head_counts: np.ndarray
    class_counts: np.ndarray
    class_words: np.ndarray
    documents: int

    @property
    def symbols(self) -> int:
        return len(self.head) + len(self.class_counts) + 1

    @property
    def tokens(self) -> int:
        return int(self.head_counts.sum() + self.class_counts.sum()) + self.documents

    @property
    def words(self) -> int:
        return len(self.head) + int(self.class_words.sum()) + (self.documents > 0)

    def masses(self) -> np.ndarray:
        """How often each symbol occurs in the training documents."""
        return np.concatenate([self.head_counts, self.class_counts, [self.documents]]).astype(float)


class Symbols(dict):
    """Symbols of words; those not in the head are told by their ending."""

    def __init__(self, alphabet: Alphabet):
        super().__init__(alphabet.head)
        self.offset, self.classes = len(alphabet.head), len(alphabet.class_counts)

    def __missing__(self, word: bytes) -> int:
        return self.offset + zlib.crc32(word[-SUFFIX:]) % self.classes


def words_of(text: str | None) -> list[bytes]:
    """``bytes.lower`` changes A-Z alone; ``bytes.split`` cuts at bytes 20 and 09 to 0D."""
    return (text or "").encode().lower().split()


def word_counts(texts: DataFrame) -> DataFrame:
    """word, c: counts over all texts, added up within tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches_of(batches, 2000):
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
            if len(counts) > 400_000:
                yield made(counts)
                counts = Counter()
        if counts:
            yield made(counts)

    def made(counts: Counter[bytes]) -> pa.RecordBatch:
        columns = [pa.array(counts.keys(), type=pa.binary()), pa.array(counts.values(), type=pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "c"])

    counted = texts.select(F.col("text").cast("string")).mapInArrow(count, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def alphabet_of(counts: DataFrame, documents: int, options: HmmOptions) -> tuple[Alphabet, DataFrame]:
    """The alphabet, and the counts of words outside the head.

    The head is the words above the lowest count for which they number ``head`` at most, found
    in sixteenths of a doubling, so no sort of the vocabulary is needed.
    """
    binned = counts.withColumn("bin", F.floor(F.log2("c") * 16).cast("int"))
    sizes = binned.groupBy("bin").count().collect()  # at most 64 * 16 rows
    floor, held = 64 * 16, 0
    for row in sorted(sizes, key=lambda r: -r["bin"]):
        # Words met once stay in their classes: they tell how likely words are that were never met.
        if row["bin"] == 0 or held + row["count"] > options.head:
            break
        floor, held = row["bin"], held + row["count"]
    head = sorted((bytes(r["word"]), r["c"]) for r in binned.filter(F.col("bin") >= floor).select("word", "c").collect())
    rest = binned.filter(F.col("bin") < floor).select("word", "c")
    ending = F.expr(f"substring(word, greatest(length(word) - {SUFFIX - 1}, 1))")
    by_class = rest.groupBy((F.crc32(ending) % options.classes).alias("k")).agg(
        F.sum("c").alias("c"), F.count("*").alias("n")
    )
    class_counts = np.zeros(options.classes, np.int64)
    class_words = np.zeros(options.classes, np.int64)
    for row in by_class.collect():  # one row per class
        class_counts[row["k"]], class_words[row["k"]] = row["c"], row["n"]
    words = {word: i for i, (word, _) in enumerate(head)}
    head_counts = np.array([c for _, c in head], dtype=np.int64)
    return Alphabet(words, head_counts, class_counts, class_words, documents), rest


def _sorted(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Longest first: the order, all symbols, where each begins, and how many reach each step."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([sequences[i] for i in order])
    begins = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
    reach = len(sequences) - np.searchsorted(lengths[order][::-1], np.arange(lengths.max()), side="right")
    return order, flat, begins, reach


def log_likelihoods(hmm: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 likelihood of each sequence by the scaled forward recursion."""
    order, flat, begins, reach = _sorted(sequences)
    total = np.zeros(len(sequences))
    state = np.tile(hmm.start, (len(sequences), 1))
    for t, n in enumerate(reach):
        state = state if t == 0 else state[:n] @ hmm.move
        state = state * hmm.emit[flat[begins[:n] + t]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log10(scale)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(hmm: Hmm, sequences: list[np.ndarray], first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward-backward over sequences: start, middle, moves and emissions, and log likelihood.

    ``first`` tells which sequences begin a document; the others begin from ``middle``.
    """
    order, flat, begins, reach = _sorted(sequences)
    steps, states = len(reach), len(hmm.start)
    ends = np.concatenate([[0], np.cumsum(reach)])
    # Symbols in the order of steps, and how likely each is in each state.
    step = np.repeat(np.arange(steps), reach)
    symbols = flat[begins[np.arange(len(flat)) - ends[step]] + step]
    weights = hmm.emit.astype(np.float32)[symbols]
    move = hmm.move.astype(np.float32)
    kept = np.empty_like(weights)
    scales = np.empty(len(flat), np.float32)
    state = np.where(first[order][:, None], hmm.start, hmm.middle).astype(np.float32)
    for t, n in enumerate(reach):
        now = slice(ends[t], ends[t + 1])
        state = state if t == 0 else state[:n] @ move
        state = np.multiply(state, weights[now], out=kept[now])
        scales[now] = scale = state.sum(axis=1)
        state /= scale[:, None]
    weights /= scales[:, None]
    moves = np.zeros((states, states))
    after = np.ones((reach[-1], states), np.float32)
    for t in range(steps - 1, -1, -1):
        alpha = kept[ends[t] : ends[t + 1]]
        if t + 1 < steps:
            inward = weights[ends[t + 1] : ends[t + 2]]
            inward *= after
            moves += alpha[: reach[t + 1]].T @ inward
            after = np.ones((reach[t], states), np.float32)
            after[: reach[t + 1]] = inward @ move.T
        alpha *= after
    moves *= hmm.move
    opening = kept[: reach[0]].astype(float)
    begin = opening[first[order]].sum(axis=0)
    emitted = np.stack(
        [np.bincount(symbols, kept[:, s], minlength=len(hmm.emit)) for s in range(states)], axis=1
    )
    return begin, moves, emitted, np.log10(scales, dtype=float).sum()


def maximised(alphabet: Alphabet, begin, moves, emitted, options: HmmOptions) -> Hmm:
    """Parameters from expected counts, smoothed by Dirichlet priors (the corpus for emissions)."""
    states = options.states
    masses = alphabet.masses() + 1
    prior = options.prior * masses / masses.sum()
    emit = emitted + prior[:, None]
    emit = emit / emit.sum(axis=0)
    move = moves + 0.1
    middle = emitted.sum(axis=0) + 1
    offset, classes = len(alphabet.head), len(alphabet.class_counts)
    within = alphabet.class_counts + alphabet.class_words + 1.0
    emit[offset : offset + classes] /= within[:, None]
    start = begin + 1.0 / states
    return Hmm(start / start.sum(), middle / middle.sum(), move / move.sum(axis=1, keepdims=True), emit)


def _cut(symbols: np.ndarray, longest: int) -> list[np.ndarray]:
    return [symbols[i : i + longest] for i in range(0, len(symbols), longest)]


def symbols_of(texts: DataFrame, alphabet: Alphabet) -> DataFrame:
    """The symbols of every text, with the end, as little-endian 32-bit numbers: a table."""
    shared = texts.sparkSession.sparkContext.broadcast(alphabet)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, end = Symbols(shared.value), shared.value.symbols - 1
        for batch in batches_of(batches, 500):
            out = []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                known = np.empty(len(words) + 1, "<i4")
                known[:-1] = np.fromiter(map(symbols.__getitem__, words), "<i4", len(words))
                known[-1] = end
                out.append(known.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["symbols"])

    told = written_table(texts.select(F.col("text").cast("string")).mapInArrow(run, "symbols binary"))
    shared.unpersist()
    return told


def baum_welch(told: DataFrame, alphabet, hmm: Hmm | None, options: HmmOptions) -> tuple[Hmm, float]:
    """One iteration over all of ``symbols_of``; without a model, every document gets a state by chance."""
    many = alphabet.symbols
    shared = told.sparkSession.sparkContext.broadcast(hmm)
    names = [f"s{i}" for i in range(options.states)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = shared.value
        begin, moves = np.zeros(options.states), np.zeros((options.states, options.states))
        emitted, log_likelihood = np.zeros((many, options.states)), 0.0
        chunk: list[np.ndarray] = []
        first: list[bool] = []

        def take() -> float:
            found = expected_counts(hmm, chunk, np.array(first))
            for total, part in zip((begin, moves, emitted), found):
                total += part
            chunk.clear()
            first.clear()
            return float(found[3])

        held = 0
        for batch in batches_of(batches, 500):
            for symbols in batch.column(0).to_pylist():
                known = np.frombuffer(symbols, "<i4")
                if hmm is None:
                    state = zlib.crc32(symbols[:200]) % options.states
                    np.add.at(emitted[:, state], known, 1.0)
                    begin[state] += 1
                    moves[state, state] += len(known) - 1
                    continue
                pieces = _cut(known, options.longest)
                chunk += pieces
                first += [i == 0 for i in range(len(pieces))]
                held += len(known)
                if held > options.chunk_tokens:
                    log_likelihood, held = log_likelihood + take(), 0
        if chunk:
            log_likelihood += take()
        # Rows: -1 is the start, -2 the log likelihood, -3 and below the moves of each state.
        used = np.flatnonzero(emitted.sum(axis=1))
        likelihood_row = np.zeros(options.states)
        likelihood_row[0] = log_likelihood
        keys = np.concatenate([used, [-1, -2], -3 - np.arange(options.states)])
        table = np.concatenate([emitted[used], [begin, likelihood_row], moves])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, type=pa.int64()), *map(pa.array, np.ascontiguousarray(table.T))], names=["k", *names]
        )

    schema = "k bigint, " + ", ".join(f"{n} double" for n in names)
    counted = told.mapInArrow(count, schema)
    rows = counted.groupBy("k").agg(*[F.sum(n).alias(n) for n in names]).collect()  # one per symbol
    shared.unpersist()
    keys = np.array([r["k"] for r in rows], dtype=np.int64)
    table = np.array([[r[n] for n in names] for r in rows]).reshape(-1, options.states)
    emitted = np.zeros((alphabet.symbols, options.states))
    emitted[keys[keys >= 0]] = table[keys >= 0]
    moves = np.zeros((options.states, options.states))
    moves[-3 - keys[keys <= -3]] = table[keys <= -3]
    begin = table[keys == -1].sum(axis=0)
    likelihood = float(table[keys == -2].sum())
    return maximised(alphabet, begin, moves, emitted, options), likelihood


@dataclass
class LanguageModel:
    alphabet: Alphabet
    hmm: Hmm
    rest: DataFrame
    likelihoods: list[float]


def train(docs: DataFrame, options: HmmOptions = HmmOptions()) -> LanguageModel:
    """Count words and run Baum-Welch over the documents that are not held out."""
    kept = docs.filter(~held_out(F.col("doc_id"), options.folds, options.held_out_fold)).select("doc_id", "text")
    counts = written_table(word_counts(kept))
    documents = kept.count()
    alphabet, rest = alphabet_of(counts, documents, options)
    told = symbols_of(kept, alphabet)
    hmm, _ = baum_welch(told, alphabet, None, options)
    likelihoods = []
    for _ in range(options.start_passes + options.passes):
        hmm, likelihood = baum_welch(told, alphabet, hmm, options)
        likelihoods.append(likelihood)
        gained = likelihood - likelihoods[-2] if len(likelihoods) > options.passes else math.inf
        if gained < options.tolerance * abs(likelihood):
            break
    return LanguageModel(alphabet, hmm, rest, likelihoods)


def score(docs: DataFrame, model: LanguageModel, options: HmmOptions = HmmOptions()) -> DataFrame:
    """n_tokens, n_known, base_score and score of every document.

    A task gives each document a row with what the head decides, and a row for each of its other
    words; these meet the counts of words in a join, and the rows of a document are summed.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.alphabet, model.hmm))
    alphabet = model.alphabet
    per_token = math.log10(alphabet.tokens + alphabet.words + 1)
    end_base = math.log10(alphabet.documents + 1)
    schema = (
        "row_id bigint, doc_id bigint, word binary, times bigint, n_tokens bigint, n_known bigint,"
        " head_base double, chain double"
    )
    names = ["row_id", "doc_id", "word", "times", "n_tokens", "n_known", "head_base", "chain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, hmm = shared.value
        symbols, end = Symbols(alphabet), alphabet.symbols - 1
        logs = np.log10(alphabet.head_counts + 1.0)
        held: list[tuple] = []
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            chains = log_likelihoods(hmm, [known for *_, known in held])
            out = []
            for (row_id, doc_id, words, known), chain in zip(held, chains):
                own = known[known < symbols.offset]
                known_tokens = len(own) + (alphabet.documents > 0)
                # A blank never occurs in a word, so this row meets no count.
                mark = b" %d" % row_id
                base = float(logs[own].sum()) + end_base
                out.append((row_id, doc_id, mark, 0, len(known), known_tokens, base, float(chain)))
                rarer = Counter(w for w in words if w not in symbols)
                out += [(row_id, None, w, n, None, 0, 0.0, None) for w, n in rarer.items()]
                if len(out) > 100_000:
                    yield made(out)
                    out = []
            if out:
                yield made(out)

        def made(out: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(values, type=kind) for values, kind in zip(zip(*out), kinds)], names=names
            )

        for batch in batches_of(batches, 1000):
            for row_id, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = words_of(text)
                known = np.fromiter(map(symbols.__getitem__, words), np.int64, len(words))
                held.append((row_id, doc_id, words, np.append(known, end)))
                size += len(words) + 1
            if size > options.chunk_tokens:
                yield from rows()
                held, size = [], 0
        if held:
            yield from rows()

    narrow = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("bigint"), F.col("text").cast("string")
    )
    met = narrow.mapInArrow(run, schema).join(model.rest, "word", "left")
    rare = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)
    summed = met.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0))).alias("n_known"),
        F.sum("head_base").alias("head_base"),
        F.sum(rare).alias("rare"),
        F.max("chain").alias("chain"),
    )
    return summed.select(
        "doc_id",
        held_out(F.col("doc_id"), options.folds, options.held_out_fold).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(alphabet.tokens).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.col("rare") - F.col("n_tokens") * F.lit(per_token)).alias("base_score"),
        (F.col("chain") + F.col("rare")).alias("score"),
    )
