"""Operator 6, toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. The labels of the learning rows give a sample of at most SAMPLE_TOXIC and SAMPLE_CLEAN ids by a hash; their whole
   texts go to a durable table.
2. Spark counts the sample texts that hold each n-gram, by label, and keeps the FEATURES n-grams that tell the labels
   apart best (likelihood ratio). These and their log-count ratios are all that the model knows of a text.
3. One executor task fits the weights: at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of at most FEATURES numbers each. For the
   bias it scores each of FOLDS parts of the rows by a model, n-grams included, that was made of the others, so that the
   threshold stands where rows that weren't learnt from put it.
4. One Arrow map scores all whole texts; the broadcast model has FEATURES weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import discard, durable, held_out, key_rows, slices, table
from varloom.llm.ngrams import folded, gram_bins

SIZES, BITS, FEATURES = (4, 5, 6), 20, 2_000
#: The sample that the classifier is fitted on: rows of label 1 and rows of label 0.
SAMPLE_TOXIC, SAMPLE_CLEAN = 2_000, 4_000
ROUNDS, RATE, DECAY, SMOOTH = 200, 0.1, 1e-2, 0.5
FOLDS, THRESHOLD = 4, 0.7
#: The bias puts the threshold at a quantile of the clean rows, as models that haven't seen them score them, and up from there
#: by a part of the way to a quantile of the toxic ones; the part shrinks where there are more clean rows than so many.
CLEAN_BELOW, TOXIC_BELOW, UP, FEW_CLEAN = 0.998, 0.2, 0.3, 250


class Features:
    """Numbers of the chosen bins that a text has."""

    def __init__(self, bins: np.ndarray):
        self._number = np.full(1 << BITS, -1, np.int16)
        self._number[bins] = np.arange(len(bins))

    def __call__(self, text: str | None) -> np.ndarray:
        out = [np.empty(0, np.int16)]
        for b in gram_bins(folded(text), SIZES, BITS):
            k = self._number[b]
            out.append(np.unique(k[k >= 0]))
        return np.unique(np.concatenate(out))


class Model:
    """bins: chosen n-grams; weights: of each, ratio included; base: share of toxic rows learnt from, for texts without
    any n-gram at all."""

    def __init__(self, bins: np.ndarray, weights: np.ndarray, bias: float, base: float):
        self.bins, self.weights, self.bias, self.base = bins, weights, bias, base

    def scorer(self):
        features = Features(self.bins)

        def score(text: str | None) -> float:
            if len(folded(text)) < min(SIZES):
                return self.base
            z = self.weights[features(text)].sum() + self.bias
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def fit(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Weights, ratios included, of a logistic regression on features of value `ratio`, each label weighing a half; by
    AdaGrad."""
    n, pos, size = len(labels), int(labels.sum()), len(ratios)
    ind, doc = np.concatenate([*rows, np.empty(0, np.int16)]).astype(np.int64), np.repeat(np.arange(n), [len(r) for r in rows])
    balance = np.where(labels == 1, n / (2 * pos), n / (2 * (n - pos))) / n
    w, bias, g2, gb = np.zeros(size), 0.0, np.full(size, 1e-8), 1e-8
    for _ in range(ROUNDS):
        z = np.bincount(doc, (w * ratios)[ind], n) + bias
        err = (1 / (1 + np.exp(-z)) - labels) * balance
        grad = DECAY * w + np.bincount(ind, err[doc], size) * ratios
        g2 += grad * grad
        w -= RATE * grad / np.sqrt(g2)
        gb += err.sum() ** 2
        bias -= RATE * err.sum() / np.sqrt(gb)
    return w * ratios


def bias_of(z: np.ndarray, labels: np.ndarray) -> float:
    """The bias that puts the threshold at its place among the rows' sums of weights."""
    clean = z[labels == 0]
    low, high = np.quantile(clean, CLEAN_BELOW), np.quantile(z[labels == 1], TOXIC_BELOW)
    cut = low + UP * min(1.0, FEW_CLEAN / len(clean)) * max(0.0, high - low)
    return float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)


def _sample(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """Durable table (toxic, fold, text) of the rows that are learnt from."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id", modulus, remainder))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .join(docs.select("doc_id"), "doc_id", "left_semi")
    )
    order = F.xxhash64("doc_id")
    picked = known.filter("toxic = 1").orderBy(order, "doc_id").limit(SAMPLE_TOXIC).unionByName(known.filter("toxic = 0").orderBy(order, "doc_id").limit(SAMPLE_CLEAN))
    return durable(docs.join(F.broadcast(durable(picked, "toxic-ids")), "doc_id").select("toxic", F.pmod(F.hash("doc_id"), F.lit(FOLDS)).alias("fold"), "text"), "toxic-sample")


def _count(batches):
    """How many texts of each fold and label hold each bin."""
    counts, marks = np.zeros((FOLDS, 2, 1 << BITS), np.int32), np.zeros(1 << BITS, bool)
    for b in slices(batches):
        for toxic, fold, text in zip(*(b.column(c).to_pylist() for c in ("toxic", "fold", "text"))):
            for part in gram_bins(folded(text), SIZES, BITS):
                marks[part] = True
            held = np.flatnonzero(marks)
            counts[fold, int(toxic == 1), held] += 1
            marks[held] = False
    for fold in range(FOLDS):
        some = np.flatnonzero(counts[fold].sum(0))
        for i in range(0, len(some), 100_000):
            k = some[i : i + 100_000]
            yield pa.RecordBatch.from_pydict({"bin": pa.array(k, pa.int32()), "fold": pa.array(np.full(len(k), fold), pa.int32()), "clean": pa.array(counts[fold, 0, k], pa.int64()), "toxic": pa.array(counts[fold, 1, k], pa.int64())})


def _best(counts: DataFrame, without: int | None, pos: int, neg: int) -> tuple[np.ndarray, np.ndarray]:
    """(bins, log-count ratios) of the n-grams that tell pos toxic rows from neg clean ones best, a fold left out."""
    rows = counts.filter(F.col("fold") != (-1 if without is None else without)).groupBy("bin").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    due = lambda side, share: F.when(F.col(side) > 0, F.col(side) * F.ln(F.col(side) / ((F.col("clean") + F.col("toxic")) * share))).otherwise(0.0)
    gain = due("toxic", pos / (pos + neg)) + due("clean", neg / (pos + neg))
    best = np.array(rows.orderBy(F.round(gain, 9).desc(), "bin").limit(FEATURES).select("bin", "clean", "toxic").collect(), float).reshape(-1, 3)
    ratios = np.log((best[:, 2] + SMOOTH) / (pos + 2 * SMOOTH)) - np.log((best[:, 1] + SMOOTH) / (neg + 2 * SMOOTH))
    return best[:, 0].astype(np.int64), ratios


def fit_models(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, bins: np.ndarray, models: dict) -> tuple[np.ndarray, float]:
    """(weights, bias) of the model of all rows (key None). rows: numbers into bins; models: by the fold that each leaves out,
    its bins and ratios. Rows of a fold without a model are left out of the bias; without two labels there, it is taken on the
    rows learnt from."""
    z = np.full(len(labels), np.nan)
    for fold, (own, ratios) in models.items():
        number = np.full(len(bins), -1)
        number[np.searchsorted(bins, own)] = np.arange(len(own))
        mine = [(k := number[r])[k >= 0] for r in rows]
        learn = np.flatnonzero(folds != (-1 if fold is None else fold))
        weights = fit([mine[i] for i in learn], labels[learn], ratios)
        if fold is None:
            final, seen = weights, np.array([weights[r].sum() for r in mine])
        else:
            for i in np.flatnonzero(folds == fold):
                z[i] = weights[mine[i]].sum()
    apart = ~np.isnan(z)
    return final, bias_of(z[apart], labels[apart]) if len(set(labels[apart].tolist())) == 2 else bias_of(seen, labels)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic. Rows with the given remainder of crc32(doc_id) are never learnt from.

    Null labels and ids are left out; of repeated labels the greatest counts; a label without a document has no effect.
    With only one label the score is the share of label 1 everywhere, with one added to each label's count."""
    sample = _sample(docs, labels, modulus, remainder)
    n = {(f, t): c for f, t, c in map(tuple, sample.groupBy("fold", (F.col("toxic") == 1).cast("int")).count().collect())}  # two numbers a fold
    size = lambda t, without=None: sum(c for (f, label), c in n.items() if label == t and f != without)
    pos, neg = size(1), size(0)
    if not pos or not neg:
        base = (pos + 1) / (pos + neg + 2)
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(base / (1 - base))), base)
    counts = durable(sample.mapInArrow(_count, "bin int, fold int, clean long, toxic long").groupBy("bin", "fold").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-counts")
    models = {f: _best(counts, f, size(1, f), size(0, f)) for f in (None, *range(FOLDS)) if size(1, f) and size(0, f)}
    bins = np.unique(np.concatenate([b for b, _ in models.values()]))
    discard(counts)

    def describe(batches):
        features = Features(bins)
        for b in slices(batches):
            yield pa.RecordBatch.from_pydict({"toxic": b.column("toxic"), "fold": b.column("fold"), "held": pa.array([features(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())})

    def fit_all(batches):
        rows = sorted((x["held"], int(x["toxic"] == 1), x["fold"]) for b in batches for x in b.to_pylist())  # in one order, however they were dealt
        weights, bias = fit_models([np.frombuffer(h, np.int16) for h, _, _ in rows], np.array([t for _, t, _ in rows]), np.array([f for _, _, f in rows]), bins, models)
        yield pa.RecordBatch.from_pydict({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": pa.array([bias])})

    got = sample.mapInArrow(describe, "toxic int, fold int, held binary").repartition(1).mapInArrow(fit_all, "weights binary, bias double").first()
    discard(sample)
    return Model(models[None][0], np.frombuffer(got["weights"]), got["bias"], pos / (pos + neg))


def score_toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    A null text counts as empty; a text too short for an n-gram scores the share of toxic rows in the sample, below the
    threshold unless most of the sample is toxic. Without any label the score is 0.5. Repeated rows get equal scores; a
    null id isn't held out and its row is scored. Very long texts are read whole, part by part. An empty table gives an
    empty result; other columns of docs are not read."""
    rows = key_rows(docs, "doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels, modulus, remainder))

    def run(batches):
        score = model.value.scorer()
        for b in slices(batches):
            s = np.array([score(t) for t in b.column("text").to_pylist()], float)
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "score": pa.array(s, pa.float64()), "predicted": pa.array(s >= threshold).cast(pa.int32())})

    rows = rows.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs, all columns, without the rows that score at least the threshold (see score_toxicity() for nulls, empty and
    very long texts, ties and missing labels). Repeated rows go or stay alike; an empty table stays empty."""
    model = docs.sparkSession.sparkContext.broadcast(train(key_rows(docs, "doc_id", "text"), labels))

    def run(batches):
        score = model.value.scorer()
        for b in slices(batches):
            yield b.filter(pa.array([score(t) < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
