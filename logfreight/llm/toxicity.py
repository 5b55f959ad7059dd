"""Toxic passages by maximum-scoring segments over token log-odds.

A token's score is the log ratio of its rates in toxic and in clean documents under Dirichlet
priors: a word's prior leans as its first letters do, theirs as the corpus does. A drift is
taken off, so that ordinary text scores below zero. A linear scan (maximal scoring
subsequences) finds every passage that no extension improves. How high the best passage of a
clean text of n tokens gets by chance follows an extreme-value law: P(M >= x) = 1 - exp(-K n
exp(-lambda x)); lambda solves E[exp(lambda s)] = 1 over clean tokens, K is fitted to clean
documents. Passages with an E-value of at most ``PASSAGE_E`` are significant; a document's
evidence is the E-value of its significant passages taken together, turned into a probability by a logistic
curve on the labelled sample, weighted to the true share of labels. Drift and priors are chosen
from ``SETTINGS`` by cross-validation inside the sample: K, the curve and the loss come from
about ``FITS`` documents of each class, told by counts of the other inner folds, over all their
significant passages.

The model is fitted on a bounded sample: at most ``SAMPLE`` labelled documents of each class.
Word and prefix counts are held by hash in tables of a fixed size. A document with several
labels is toxic if one says so; null and other labels are not used, nor are null ids.

Null and empty texts have no passage and the score that belongs to none. Every row gives one
row, repeated rows too, and keeps the other columns but those of the two names it adds. An empty
table gives no rows. Without both classes in the sample the score is the share of toxic labels.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logfreight.llm.sampling import bounded_sample
from logfreight.llm.texts import batches_of, for_worker, fresh, held_out, without
from logfreight.session import written_table

SAMPLE = 16_384
WORD_BITS, PREFIX_BITS, PREFIX = 18, 16, 4
# (drift, word prior, prefix prior): the one that tells unseen training documents best is taken.
SETTINGS = ((2.0, 10.0, 20.0), (1.0, 10.0, 20.0), (2.0, 2.0, 5.0), (1.0, 2.0, 5.0))
INNER_FOLDS = 4
FITS = 2048
PASSAGE_E = 0.05
FOLDS = 5
_WORD = re.compile(r"\w+")


def _slots(word: str) -> tuple[int, int]:
    whole, head = word.encode(), word[:PREFIX].encode()
    prefix = (1 << WORD_BITS) + zlib.crc32(head) % (1 << PREFIX_BITS)
    return zlib.crc32(whole) % (1 << WORD_BITS), prefix


@dataclass
class ToxicityModel:
    word_counts: np.ndarray
    prefix_share: np.ndarray
    share: float
    rates: tuple[float, float]
    drift: float = SETTINGS[0][0]
    word_prior: float = SETTINGS[0][1]
    decay: float = 1.0
    scale: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)
    constant: float | None = None


class Scores(dict):
    """Scores of words, made when first met."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        model, (slot, prefix) = self.model, _slots(word)
        toxic, clean = model.word_counts[slot]
        lean = model.prefix_share[prefix - (1 << WORD_BITS)]
        odds = math.log((toxic + model.word_prior * lean) / model.rates[0])
        odds -= math.log((clean + model.word_prior * (1 - lean)) / model.rates[1])
        if len(self) > 100_000:
            self.clear()
        self[word] = odds - model.drift
        return odds - model.drift


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring subsequences as (begin, end, score), left to right, in linear time.

    Only positive tokens open a candidate. A candidate joins the nearest earlier one that
    begins lower (in running totals), if that one also ends lower; else it stands.
    """
    totals = np.cumsum(scores, dtype=float)
    stack: list[list] = []  # [left total, right total, begin, end, nearest with a lower left]
    for i in np.flatnonzero(scores > 0).tolist():
        right = float(totals[i])
        now = [right - float(scores[i]), right, i, i + 1, -1]
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][0] >= now[0]:
                at = stack[at][4]
            if at < 0 or stack[at][1] >= now[1]:
                now[4] = at
                stack.append(now)
                break
            before = stack[at]
            now = [before[0], now[1], before[2], now[3], -1]
            del stack[at:]
            at = before[4]
    return [(begin, end, right - left) for left, right, begin, end, _ in stack]


def _e_value(model: ToxicityModel, tokens: int, score: float) -> float:
    """How many passages of such a score a clean text of that length has by chance."""
    return model.scale * max(tokens, 1) * math.exp(-min(model.decay * score, 700.0))


def evidence(model: ToxicityModel, tokens: int, found: list[tuple[int, int, float]]) -> float:
    """Minus the log of the E-value of the significant passages together (0 without any)."""
    total = sum(s for *_, s in found if _e_value(model, tokens, s) <= PASSAGE_E)
    return max(0.0, -math.log(_e_value(model, tokens, total))) if total else 0.0


def chance(model: ToxicityModel, x: float) -> float:
    if model.constant is not None:
        return model.constant
    a, b = model.curve
    return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, a + b * x))))


def _decay(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(r s)] = 1."""
    low, high = 1e-6, 1.0
    mean = lambda r: float((weights * np.exp(np.minimum(r * values, 600))).sum() / weights.sum())
    if values.max() <= 0:
        return 1.0
    while mean(high) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Newton's method for one variable, with a small penalty on the slope."""
    x = np.minimum(x, 50.0)
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a + b * x)))
        w = weight * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(weight * (y - p)).sum(), (weight * (y - p) * x).sum() - 0.1 * b])
        hessian = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 0.1]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + float(np.clip(step[0], -2, 2)), b + float(np.clip(step[1], -2, 2))
        if abs(step).max() < 1e-6:
            break
    return a, max(b, 0.0)


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, folds: int = FOLDS) -> ToxicityModel:
    """Fit on labelled documents outside the held-out fold."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), folds, 0))
    marked = usable.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marked = written_table(marked)
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = bounded_sample(marked, "toxic", bound).select("doc_id", "toxic")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most twice ``bound`` rows of two integers are sent to all tasks.
    inner = F.pmod(F.xxhash64(F.lit("inner"), "doc_id"), F.lit(INNER_FOLDS)).cast("int").alias("inner")
    sample = written_table(texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", inner))
    slots = (1 << WORD_BITS) + (1 << PREFIX_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for_worker("toxicity counts", lambda: None)
        table = np.zeros((INNER_FOLDS, 2, slots))
        slot_of: dict[str, tuple[int, int]] = {}
        documents = np.zeros((INNER_FOLDS, 2))
        for batch in batches_of(batches, 500):
            for text, toxic, part in zip(*(column.to_pylist() for column in batch.columns)):
                documents[part, toxic] += 1
                counts = table[part, toxic]
                for word in words_of(text):
                    if (at := slot_of.get(word)) is None:
                        if len(slot_of) > 200_000:
                            slot_of.clear()
                        at = slot_of[word] = _slots(word)
                    counts[at[0]] += 1
                    counts[at[1]] += 1
        for part in range(INNER_FOLDS):
            used = np.flatnonzero(table[part].sum(axis=0))
            rows = np.concatenate([table[part][:, used], documents[part][:, None]], axis=1)
            columns = [np.append(used, -1), np.full(len(used) + 1, part, np.int32), rows[1], rows[0]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["k", "inner", "t", "c"])

    counted = sample.mapInArrow(count, "k bigint, inner int, t double, c double").groupBy("k", "inner")
    rows = counted.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).toArrow()  # one per slot and fold
    tables, seen = np.zeros((INNER_FOLDS, slots, 2)), np.zeros(2)
    keys, parts = rows["k"].to_numpy(), rows["inner"].to_numpy()
    values = np.stack([rows["t"].to_numpy(), rows["c"].to_numpy()], axis=1)
    tables[parts[keys >= 0], keys[keys >= 0]] = values[keys >= 0]
    seen = values[keys == -1].sum(axis=0)
    known = sum(totals.values())
    whole = tables.sum(axis=0)
    if not (seen > 0).all() or not (whole[: 1 << WORD_BITS].sum(axis=0) > 0).all():
        constant = totals.get(1, 0) / known if known else 0.0
        return ToxicityModel(whole[: 1 << WORD_BITS], np.zeros(1 << PREFIX_BITS), 0.0, (1.0, 1.0), constant=constant)
    # For each setting a model per inner fold, from the documents of the other folds.
    others = [_counts_of(whole - table) for table in tables]
    models = [[_model_of(table, setting) for table in others] for setting in SETTINGS]
    # Fitting scores each document under every setting, so it takes about ``FITS`` of each class.
    shares = [min(1.0, FITS / n) for n in seen]
    part = F.pmod(F.xxhash64(F.lit("fits"), "text"), F.lit(1_000_000))
    fits = written_table(sample.filter(part < F.when(F.col("toxic") == 1, shares[0] * 1e6).otherwise(shares[1] * 1e6)))
    tops = _over(fits, models, lambda model, n, found: max((s for *_, s in found), default=0.0))
    clean = [row for row in tops if not row["toxic"]]
    for at, group in enumerate(models):
        chances = [max(r["n"], 1) * math.exp(-min(group[r["inner"]].decay * r["x"][at], 700.0)) for r in clean]
        for model in group:
            model.scale = float(1.0 / max(np.mean(chances), 1e-12))
    weighed = _over(fits, models, evidence)
    x = np.array([r["x"] for r in weighed])
    y = np.array([float(r["toxic"]) for r in weighed])
    weight = np.where(y > 0, totals[1] / y.sum(), totals[0] / max((1 - y).sum(), 1)) * len(y) / known
    curves = [_logistic(x[:, at], y, weight) for at in range(len(SETTINGS))]
    losses = [_loss(curve, x[:, at], y, weight) for at, curve in enumerate(curves)]
    best = int(np.argmin(losses))
    model = _model_of(_counts_of(whole), SETTINGS[best])
    model.scale, model.curve = models[best][0].scale, curves[best]
    return model


def _counts_of(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of word slots and of prefix slots (toxic, clean); models of one fold share them."""
    return table[: 1 << WORD_BITS].astype(np.float32), table[1 << WORD_BITS :]


def _model_of(counts: tuple[np.ndarray, np.ndarray], setting: tuple[float, float, float]) -> ToxicityModel:
    """The scores that counts give under a setting."""
    drift, word_prior, prefix_prior = setting
    word_counts, prefix_counts = counts
    tokens = np.maximum(word_counts.sum(axis=0, dtype=float), 1.0)
    share = tokens[0] / tokens.sum()
    prefix_share = (prefix_counts[:, 0] + prefix_prior * share) / (prefix_counts.sum(axis=1) + prefix_prior)
    model = ToxicityModel(word_counts, prefix_share.astype(np.float32), share, (tokens[0], tokens[1]), drift, word_prior)
    # Clean tokens by slot: scores of words that fall into it, with the corpus prior.
    rough = np.log((word_counts[:, 0] + word_prior * share) / tokens[0])
    rough -= np.log((word_counts[:, 1] + word_prior * (1 - share)) / tokens[1])
    model.decay = _decay(rough - drift, word_counts[:, 1] + 1e-9)
    return model


def _over(sample: DataFrame, models: list[list[ToxicityModel]], value) -> list[dict]:
    """toxic, inner, n and, per setting, ``value`` of the passages that the fold's model finds.

    A row per document of the bounded sample, each told by models that have not seen it.
    """
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for_worker("toxicity fits", lambda: None)
        scores = [[Scores(model) for model in group] for group in shared.value]
        for batch in batches_of(batches, 500):
            many, told = [], []
            for text, part in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                words, row = words_of(text), []
                for group in scores:
                    kept = group[part]
                    found = segments(np.fromiter(map(kept.__getitem__, words), np.float64, len(words)))
                    row.append(float(value(kept.model, len(words), found)))
                many.append(len(words))
                told.append(row)
            columns = [batch.column(1), batch.column(2), pa.array(many, pa.int64()), pa.array(told, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "inner", "n", "x"])

    found = sample.mapInArrow(run, "toxic int, inner int, n bigint, x array<double>").toArrow().to_pylist()
    shared.destroy()
    return found


def _loss(curve: tuple[float, float], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Mean log loss of a curve."""
    p = 1 / (1 + np.exp(-(curve[0] + curve[1] * np.minimum(x, 50.0))))
    return float(-(weight * np.log(np.clip(np.where(y > 0, p, 1 - p), 1e-9, 1))).sum() / weight.sum())


def passages(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, begin and end (in words), passage, score and e_value of every significant passage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, begin_word bigint, end_word bigint, passage string, score double, e_value double"
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in schema.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = _scores_of(model)
        for batch in batches_of(batches, 500):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if model.constant is not None or not words:
                    continue
                found = segments(np.fromiter(map(scores.__getitem__, words), np.float64, len(words)))
                kept = [(b, e, s, _e_value(model, len(words), s)) for b, e, s in found]
                kept = [row for row in kept if row[3] <= PASSAGE_E]
                for b, e, s, chance_of in kept:
                    out.append((doc_id, b, e, " ".join(words[b:e]), s, chance_of))
            if out:
                columns = [pa.array(values, type=kind) for values, kind in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(find, schema)


def with_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The columns of ``docs`` (which has text) with toxicity and toxic_passages added or replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rated = F.pandas_udf(_rater(shared), "toxicity double, toxic_passages int")
    added, name = ("toxicity", "toxic_passages"), fresh(docs, "_rated")
    both = docs.withColumn(name, rated(F.col("text").cast("string")))
    return both.select(*without(docs, *added), *[F.col(f"{name}.{n}") for n in added])


def _rater(shared):
    def rate(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        kept = _scores_of(model)
        out = []
        for text in texts:
            words = words_of(text)
            found = segments(np.fromiter(map(kept.__getitem__, words), np.float64, len(words))) if words and model.constant is None else []
            many = sum(_e_value(model, len(words), s) <= PASSAGE_E for *_, s in found)
            out.append((chance(model, evidence(model, len(words), found)), many))
        return pd.DataFrame(out, columns=["toxicity", "toxic_passages"])

    return rate


def _scores_of(model: ToxicityModel) -> Scores:
    """The scores of the model in use; they hold the model, so its id is no other's."""
    return for_worker(("toxicity", id(model)), lambda: Scores(model))
