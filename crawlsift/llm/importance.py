"""Quality selection by importance resampling over hashed n-grams.

Two bag-of-n-grams models over the same hash buckets: one of all raw documents, one of a target,
the documents labelled good. A document's log weight is its log likelihood under the target minus
that under the raw model. Adding seeded Gumbel noise to log weights and taking the ``k`` largest
draws ``k`` documents without replacement in proportion to their weights.

Features are words and punctuation runs, case kept, and pairs of neighbours; a token followed by
itself counts as one feature whichever it is. All documents enter the raw model. The target is a
sample of the labelled documents, expected to hold ``sample_rows`` of them. Where ``k`` is not
given, it is the number of documents whose weight is above the level that separates the good from
the bad of that sample best.

Rows: a null or empty text has no n-grams and weight one (log 0). Null labels and labels of
unknown documents say nothing; of contradicting labels the lower counts. Without good labels all
weights are one. Without labels of both kinds everything is drawn. Rows with equal ids and texts
have equal keys, so they are drawn together; ties at the last place are all drawn. Null ids share
one Gumbel number. Other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.llm.common import free_name, frugal, ready
from crawlsift.session import materialize

# Fixed values.
BUCKETS = 1 << 16
SAMPLE_ROWS = 20_000
SEED = 11
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_PIECE_CHARS = 1 << 20
_REPEATED = 1
_HISTOGRAM = 1024
_FEW = 4096


def _tokens(text: str) -> Iterator[list[str]]:
    """Tokens in lists of bounded size; a cut falls on white space, so it splits no token."""
    at = 0
    while at < len(text):
        end = min(at + _PIECE_CHARS, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        yield _TOKEN.findall(text[at:end])
        at = end


def features(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Hash buckets of a text's single tokens and pairs, with repeats."""
    parts = []
    last = np.empty(0, dtype=np.uint64)
    for tokens in _tokens(text or ""):
        if not tokens:
            continue
        single = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
        row = np.concatenate((last, single))
        pair = (row[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (row[1:] + np.uint64(_REPEATED))
        pair = (pair ^ (pair >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        pair[row[:-1] == row[1:]] = np.uint64(_REPEATED) << np.uint64(40)
        parts += [single, pair]
        last = single[-1:]
    hashes = np.concatenate(parts) if parts else last
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def label_sample(labels: DataFrame, id_col: str, label_col: str, sample_rows: int, seed: int = SEED) -> DataFrame:
    """``(label_id, label)`` of about ``sample_rows`` labelled ids, chosen by a hash of the id."""
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where("label_id IS NOT NULL AND label IS NOT NULL").groupBy("label_id").agg(F.min("label").alias("label"))
    share = min(1.0, sample_rows / max(1, known.count()))
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("label_id")), F.lit(1 << 30))
    return known.where(place < int(share * (1 << 30)))


def fit(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of the target to the raw model per bucket, from one pass over all documents."""
    marked = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).cast("string").alias("text")).join(
        F.broadcast(sample), "label_id", "left"
    )
    marked = marked.select("text", (F.coalesce("label", F.lit(0)) == 1).alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.bincount(features(text, buckets), minlength=buckets)
                raw += found
                if wanted:
                    target += found
        used = np.nonzero(raw)[0]
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "raw": raw[used], "target": target[used]})

    counts = marked.mapInArrow(frugal(count), "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    both = np.zeros((2, buckets))
    for bucket, *n in counts.collect():  # at most ``buckets`` rows
        both[:, bucket] = n
    if not both[1].any():
        return np.zeros(buckets)
    model = np.log(both + 1) - np.log(both.sum(axis=1, keepdims=True) + buckets)
    return model[1] - model[0]


def weigh(docs: DataFrame, ratio: np.ndarray, text_col: str, weight_col: str) -> DataFrame:
    """``docs`` with the log weight of each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)
    at = docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(weight_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            weights = [float(ratio[features(t, len(ratio))].sum()) for t in batch.column(at).cast(pa.large_string()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(weights, pa.float64())], names=[f.name for f in schema]
            )

    return docs.mapInArrow(frugal(run), schema)


def gumbel(seed: int, doc_id: Column) -> Column:
    """A standard Gumbel number per id."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """Exact ``k``-th largest value (1 is the largest), by histograms over ever smaller ranges."""
    values = values.where(F.col(column).isNotNull()).select(F.col(column).alias("x"))
    low, high = values.agg(F.min("x"), F.max("x")).first()
    above = 0
    while low < high:
        width = (high - low) / _HISTOGRAM
        bin_of = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(_HISTOGRAM - 1))
        bins = (
            values.where((F.col("x") >= low) & (F.col("x") <= high))
            .groupBy(bin_of.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
            .collect()
        )
        for b in sorted(bins, key=lambda b: -b.bin):
            if above + b.n >= k:
                break
            above += b.n
        low, high = b.low, b.high
        if b.n <= _FEW:
            inside = values.where((F.col("x") >= low) & (F.col("x") <= high)).collect()
            return sorted((r.x for r in inside), reverse=True)[k - above - 1]
    return low


def best_level(weights: np.ndarray, good: np.ndarray) -> float:
    """Level that separates good from bad weights with the fewest errors, each class counting
    as a whole; the middle of the gap around it. ``-inf`` when only one class is there."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    lost = np.concatenate(([0], np.cumsum(good))) / good.sum()
    stay = 1 - np.concatenate(([0], np.cumsum(~good))) / (~good).sum()
    free = np.concatenate(([True], weights[1:] > weights[:-1], [True]))
    error = np.where(free, lost + stay, np.inf)
    cut = int(error.argmin())
    if cut == 0:
        return -np.inf
    if cut == len(weights):
        return np.inf
    return float((weights[cut - 1] + weights[cut]) / 2)


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    weight_col: str = "log_weight",
    key_col: str = "sample_key",
    buckets: int = BUCKETS,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """The drawn rows of ``docs``, with log weight and Gumbel key.

    The weighed rows are written once to the shared work folder; the level and the last place
    are found on the two narrow columns. Columns of the new names are replaced.
    """
    ready(docs.sparkSession)
    docs = docs.drop(weight_col, key_col)
    sample = materialize(label_sample(labels, "doc_id", label_col, sample_rows, seed), "labels")
    ratio = fit(docs, sample, id_col, text_col, buckets)
    weighed = weigh(docs, ratio, text_col, weight_col)
    weighed = materialize(
        weighed.withColumn(key_col, F.col(weight_col) + gumbel(seed, F.col(id_col))), "weights"
    )
    if k is None:
        known = weighed.select(F.col(id_col).alias("label_id"), weight_col).join(F.broadcast(sample), "label_id")
        rows = known.select(weight_col, "label").collect()  # about ``sample_rows``
        level = best_level(
            np.array([r[0] for r in rows], dtype=float), np.array([r[1] == 1 for r in rows], dtype=bool)
        )
        k = weighed.where(F.col(weight_col) >= level).count() if np.isfinite(level) else weighed.count()
    if k <= 0 or weighed.isEmpty():
        return weighed.limit(0)
    if k >= weighed.count():
        return weighed
    return weighed.where(F.col(key_col) >= kth_largest(weighed, key_col, k))


def select_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The drawn rows of ``docs``, with its own columns only."""
    weight, key = free_name(docs, "_log_weight"), free_name(docs, "_sample_key")
    drawn = resample(docs, labels, id_col=id_col, text_col=text_col, weight_col=weight, key_col=key)
    return drawn.drop(weight, key)
