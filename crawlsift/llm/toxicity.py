"""Toxicity categories by a classifier chain of linear models.

Categories are predicted one after another. Each has a sparse logistic regression (FTRL-proximal,
L1) over hashed words, word beginnings and punctuation runs; all but the first also see the probabilities of the
categories before. Those must look in training as they will in use, so they are predicted out of
fold: a row's earlier probabilities come from models that did not see it. Final models, fitted on
all rows of the sample, do the predicting.

The chain is fitted on a sample of the labelled rows, expected to hold ``sample_rows`` of them,
whose hashed terms (not texts) go to the driver; that bound does not grow with the data. Every
document is scored over its whole text, in place.

Rows: null and empty texts have no terms and get the models' base rates. Null labels count as
unlabelled rows; of contradicting labels of one id the higher counts. Without any labelled row all
probabilities are 0. Repeated rows are scored each. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.llm.common import map_arrow, ready
from crawlsift.session import materialize

# Fixed values.
TERMS = 1 << 18
PREFIX_LETTERS = 4
SAMPLE_ROWS = 8_000
FOLDS = 3
SEED = 31
THRESHOLD = 0.3
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 0.01
_TERM = re.compile(r"[^\W\d_]+|[^\w\s]+")
_PIECE_CHARS = 1 << 20


def terms(text: str | None) -> np.ndarray:
    """Hashed distinct words and punctuation runs of a whole text, and first letters, sorted."""
    text = (text or "").lower()
    words: set[str] = set()
    at = 0
    while at < len(text):
        end = min(at + _PIECE_CHARS, len(text))
        while end < len(text) and not text[end].isspace():  # cut between words
            end += 1
        words.update(_TERM.findall(text[at:end]))
        at = end
    marked = [*words, *{"^" + w[:PREFIX_LETTERS] for w in words}]
    hashes = np.fromiter(map(xxhash.xxh32_intdigest, marked), dtype=np.int64, count=len(marked))
    return np.unique(hashes % TERMS)


def _sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -35.0), 35.0)))


@dataclass
class Linear:
    """Weights of terms, then of the earlier categories' probabilities, then the bias."""

    weights: np.ndarray

    def predict(self, found: np.ndarray, before: Sequence[float]) -> float:
        tail = self.weights[TERMS:]
        return _sigmoid(self.weights[found].sum() + tail[:-1] @ np.asarray(before, dtype=float) + tail[-1])


def fit_linear(rows: list[np.ndarray], before: np.ndarray, truth: np.ndarray, seed: int = SEED) -> Linear:
    """Sparse logistic regression; ``before`` has the earlier probabilities of each row."""
    width = TERMS + before.shape[1] + 1
    z, n = np.zeros(width), np.zeros(width)
    tail = np.arange(TERMS, width)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at = np.concatenate((rows[i], tail))
            value = np.ones(len(at))
            value[len(rows[i]) : -1] = before[i]
            w = _weights(z[at], n[at])
            slope = (_sigmoid(w @ value) - truth[i]) * value
            grown = n[at] + slope * slope
            z[at] += slope - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return Linear(_weights(z, n))


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


@dataclass
class Chain:
    """Categories in order and their models."""

    categories: list[str]
    models: list[Linear]

    def predict(self, text: str | None) -> list[float]:
        found = terms(text)
        out: list[float] = []
        for model in self.models:
            out.append(model.predict(found, out))
        return out or [0.0] * len(self.categories)


def fit_chain(rows: list[np.ndarray], truth: np.ndarray, folds: np.ndarray, categories: Sequence[str]) -> Chain:
    """Chain over rows of terms; ``truth`` has a column per category."""
    models: list[Linear] = []
    before = np.empty((len(rows), 0))
    for n in range(len(categories) if rows else 0):
        models.append(fit_linear(rows, before, truth[:, n]))
        if n + 1 == len(categories):
            break
        held = np.empty(len(rows))
        for fold in np.unique(folds):
            seen, unseen = np.nonzero(folds != fold)[0], np.nonzero(folds == fold)[0]
            part = fit_linear([rows[i] for i in seen], before[seen], truth[seen, n])
            held[unseen] = [part.predict(rows[i], before[i]) for i in unseen]
        before = np.column_stack((before, held))
    return Chain(list(categories), models)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    folds: int = FOLDS,
) -> Chain:
    """Chain in the order of ``categories``; each names a 0/1 column of ``labels``."""
    ready(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("id"), *[F.col(c).cast("int").alias(c) for c in categories])
    known = known.dropna().groupBy("id").agg(*[F.max(c).alias(c) for c in categories])
    share = min(1.0, sample_rows / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    known = materialize(known, "labels")  # about ``sample_rows`` rows
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    picked = texts.join(F.broadcast(known), "id").select("id", "text", F.array(*categories).alias("truth"))

    def run(batch: pa.RecordBatch) -> dict:
        return {
            "id": batch.column(0),
            "terms": [terms(t).astype(np.int32) for t in batch.column(1).to_pylist()],
            "truth": batch.column(2),
        }

    sample = map_arrow(picked, run, "id long, terms array<int>, truth array<int>").toArrow().sort_by("id")
    ids = sample.column("id").to_numpy()
    truth = np.array(sample.column("truth").to_pylist(), dtype=float).reshape(-1, len(categories))
    rows = [t.values.to_numpy().astype(np.int64) for t in sample.column("terms")]
    fold = np.array([xxhash.xxh32_intdigest(str(i), SEED) % folds for i in ids], dtype=np.int64)
    return fit_chain(rows, truth, fold, categories)


def score_toxicity(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and a probability ``p_<category>`` per category, for every row."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]

    def run(batch: pa.RecordBatch) -> dict:
        found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), **dict(zip(names, map(list, zip(*found))))}

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return map_arrow(slim, run, ", ".join(["doc_id long", *[f"{n} double" for n in names]]))


def flag_toxic(scores: DataFrame, category: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """Scored documents whose probability of ``category`` reaches ``threshold``."""
    return scores.where(F.col(f"p_{category}") >= threshold)
