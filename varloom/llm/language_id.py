"""Operator 4, language identification: nearest centroid over TF-IDF character n-grams.

Document frequencies come from every learning text, added up in each task before the shuffle. Centroids are fitted on
a sample of about PER_LANGUAGE texts of each language, drawn by a hash of the id below a bound that follows from the
language's count, so no language's rows meet in a task before they are few; several clusters by spherical k-means, one
language in a task. Prediction is one Arrow map with the centroids as a broadcast of bounded size. Of centroids at the
same cosine the first counts, in order of language and centroid bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import held_out, table
from varloom.llm.ngrams import folded, gram_bins

SIZES, BITS = (1, 2, 3), 13
#: The sample that centroids are fitted on: about so many texts of each language. Languages: more than these are an error.
PER_LANGUAGE, LANGUAGES = 500, 1_000
CLUSTERS, ROUNDS = 4, 12
#: A text is rejected if its cosine is below this share of the one that 95 % of its language's sample reach.
REJECT = 0.5
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def counts(texts: list) -> np.ndarray:
    """Log-damped n-gram counts, a row for each text."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for row, t in zip(out, texts):
        for bins in gram_bins(folded(t), SIZES, BITS):
            row += np.bincount(bins, minlength=1 << BITS)
    return np.log1p(out, out=out)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def cluster(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids of spherical k-means, started at far points, and each row's best cosine."""
    centres = unit(x.mean(0, keepdims=True))
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(1))][None]])
    for _ in range(ROUNDS):
        near = (x @ centres.T).argmax(1)
        centres = np.vstack([unit(x[near == j].mean(0, keepdims=True)) if (near == j).any() else centres[j : j + 1] for j in range(len(centres))])
    return centres, (x @ centres.T).max(1)


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, floors: np.ndarray, usual: str | None):
        self.idf, self.langs, self.centroids, self.floors, self.usual = idf, langs, centroids, floors, usual

    def predict(self, texts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """Nearest language, its cosine, and whether it is too far. A text without letters is UNKNOWN, at 0."""
        pred, score, far = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at in range(0, len(texts), 128):
            part = texts[at : at + 128]
            if self.langs:
                cos = unit(counts(part) * self.idf) @ self.centroids.T
                best = cos.argmax(1)
                s = np.clip(cos[np.arange(len(part)), best], 0, 1)
            for j, t in enumerate(part):
                if not self.langs or not t or not _LETTER.search(t):
                    pred.append(UNKNOWN)
                    continue
                pred.append(self.langs[best[j]] if s[j] > 0 else self.usual)
                score[at + j], far[at + j] = s[j], s[j] < self.floors[best[j]]
        return pred, score, far


def train(rows: DataFrame) -> Model:
    """rows: doc_id, text, lang of the texts that may be learnt from."""

    def document_frequency(batches):
        df, marks, n = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, bool), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                for bins in gram_bins(folded(t), SIZES, BITS):
                    marks[bins] = True
                df += marks
                marks[:] = False
                n += 1
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"bin": pa.array([-1, *seen], pa.int32()), "n": pa.array([n, *df[seen]], pa.int64())})

    df = rows.select("text").mapInArrow(document_frequency, "bin int, n long").groupBy("bin").agg(F.sum("n")).collect()
    df = dict(map(tuple, df))
    total = df.pop(-1, 0)
    idf = np.full(1 << BITS, np.log(1 + total), np.float32)
    for k, v in df.items():
        idf[k] = np.log((1 + total) / (1 + v)) + 0.1
    sizes = rows.filter("lang is not null").groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    below = {lang: min(1.0, PER_LANGUAGE / n) for lang, n in sizes}  # the share of the language's ids that is drawn
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) < F.create_map(*[F.lit(x) for kv in below.items() for x in kv])[F.col("lang")] * (1 << 30) if below else F.lit(False)

    def centroids(t: pa.Table) -> pa.Table:
        c, cos = cluster(unit(np.vstack([counts(part) for part in (t["text"].to_pylist()[i : i + 128] for i in range(0, len(t), 128))]) * idf), CLUSTERS)
        return pa.table({"lang": [t["lang"][0].as_py()] * len(c), "centroid": pa.array([x.astype("<f4").tobytes() for x in c], pa.binary()), "floor": [REJECT * float(np.quantile(cos, 0.05))] * len(c), "rows": pa.array([len(t)] * len(c), pa.int64())})

    sample = rows.filter(F.col("lang").isNotNull() & drawn).select("lang", "text")
    got = sample.groupBy("lang").applyInArrow(centroids, "lang string, centroid binary, floor double, rows long").collect()
    got = sorted(got, key=lambda r: (r["lang"], r["centroid"]))
    usual = max(got, key=lambda r: (r["rows"], r["lang"]))["lang"] if got else None
    return Model(idf, [r["lang"] for r in got], np.vstack([np.frombuffer(r["centroid"], "<f4") for r in got]) if got else np.zeros((0, 1 << BITS)), np.array([r["floor"] for r in got]), usual)


def identify(docs: DataFrame, modulus: int = 5, remainder: int = 0, reject: bool = True) -> DataFrame:
    """One row per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score, rejected.

    score: cosine to the nearest centroid, 0 to 1. A null text or one without letters is `und` at 0. With reject, so is
    a text whose cosine is below its nearest centroid's floor; without, it gets the nearest language and only the flag,
    and a text that shares no n-gram with any centroid gets the language of the largest sample. Null languages aren't
    learnt from; without any language every text is `und`. Repeated rows get equal results."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), held_out("doc_id", modulus, remainder).alias("held_out"))
    model = docs.sparkSession.sparkContext.broadcast(train(rows.filter("not held_out and lang is not null")))

    def run(batches):
        for b in batches:
            pred, score, far = model.value.predict(b.column("text").to_pylist())
            if reject:
                pred = [UNKNOWN if f else p for p, f in zip(pred, far)]
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64()), "rejected": pa.array(far)})

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), reject=False)
