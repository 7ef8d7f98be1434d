"""Language identification by rank-order profiles.

A language's profile is the list of its most frequent letter n-grams (one to three letters, words
bounded by blanks), most frequent first. A document's own list, taken over its whole text, is
compared to each profile by the out-of-place distance: each of its n-grams adds the difference of
the two ranks, or the profile length where the profile lacks it. The nearest profile wins.

Profiles are learnt from a sample of the labelled rows, expected to hold ``sample_rows`` per
language; prediction uses nothing but the text.

Rows: a null text and one without letters (numerals of any kind are none) are ``und`` with score 0. Rows with a null language are
not learnt from. Ties between n-grams go by their letters, between languages by name. Repeated
rows are predicted each. More than ``MAX_LANGUAGES`` languages are an error. Without any labelled row every text is ``und``. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlsift.llm.common import frugal, map_arrow, ready
from crawlsift.session import materialize

# Fixed values.
PROFILE_GRAMS = 400
SAMPLE_ROWS = 2_000
SEED = 23
UNKNOWN = "und"
_NO_LETTER = regex.compile(r"\P{L}+")
#: Profiles are broadcast; more languages than this are refused.
MAX_LANGUAGES = 2_000
_PIECE_CHARS = 1 << 20
_BITS = 21  # a code point fits; three of them fit in a signed 64-bit number


def _counts(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of 1-3 letter n-grams and their counts. Letters come with 0 for a word boundary; an
    n-gram may begin and end with a boundary but not span one, and a bare boundary is none."""
    one = letters[letters > 0]
    left, right = letters[:-1], letters[1:]
    two = ((left << _BITS) | right)[(left > 0) | (right > 0)]
    middle = letters[1:-1]
    three = ((letters[:-2] << 2 * _BITS) | (middle << _BITS) | letters[2:])[middle > 0]
    # Lengths are kept apart by the top bits.
    return np.unique(np.concatenate((one, two | (1 << 62), three | np.int64(-1 << 63))), return_counts=True)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of a whole text and how often each occurs."""
    text = text or ""
    grams, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = 0
    while at < len(text):
        end = min(at + _PIECE_CHARS, len(text))
        while end < len(text) and text[end].isalpha():  # cut between words
            end += 1
        words = _NO_LETTER.sub("\0", "\0" + text[at:end].lower() + "\0")
        letters = np.frombuffer(words.encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
        found = _counts(letters)
        if len(grams):
            grams, place = np.unique(np.concatenate((grams, found[0])), return_inverse=True)
            counts = np.bincount(place, weights=np.concatenate((counts, found[1]))).astype(np.int64)
        else:
            grams, counts = found
        at = end
    return grams, counts


def top_grams(grams: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent n-grams, most frequent first; ties go by code."""
    if len(counts) > 4 * n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:n]]


class Profiles:
    """Ranks of n-grams in each language, and the comparison."""

    def __init__(self, ranked: dict[str, np.ndarray], size: int = PROFILE_GRAMS):
        self.languages = sorted(ranked)
        self.size = size
        self.grams = np.unique(np.concatenate([ranked[x] for x in self.languages])) if ranked else np.empty(0, np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.languages)), -1, dtype=np.int64)
        for i, language in enumerate(self.languages):
            self.ranks[np.searchsorted(self.grams, ranked[language]), i] = np.arange(len(ranked[language]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how much nearer the best profile is than the farthest possible."""
        own = top_grams(*gram_counts(text), self.size)
        if not len(own) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == own
        ranks = self.ranks[np.where(known, at, len(self.grams))]
        apart = np.abs(ranks - np.arange(len(own))[:, None])
        distance = np.where(ranks < 0, self.size, apart).sum(axis=0)
        best = int(distance.argmin())
        return self.languages[best], float(1 - distance[best] / (self.size * len(own)))


def learn(docs: DataFrame, text_col: str, lang_col: str, key: Column, sample_rows: int = SAMPLE_ROWS, size: int = PROFILE_GRAMS) -> Profiles:
    """Profiles from about ``sample_rows`` rows of each language, chosen by a hash of ``key``."""
    ready(docs.sparkSession)
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.lit(SEED), key), F.lit(1 << 30)).alias("place"),
    )
    sizes = materialize(known.groupBy("lang").count(), "languages")
    n_languages = sizes.count()
    if n_languages == 0:
        return Profiles({}, size)
    if n_languages > MAX_LANGUAGES:
        raise ValueError(f"{n_languages} languages are more than {MAX_LANGUAGES}")
    reach = F.least(F.lit(1.0), F.lit(sample_rows) / F.col("count")) * (1 << 30)
    picked = known.join(sizes, "lang").where(F.col("place") < reach).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(gram_counts(text))
            for lang, found in by_lang.items():
                grams, place = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                counts = np.bincount(place, weights=np.concatenate([c for _, c in found])).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(grams), "gram": grams, "n": counts})

    counts = picked.mapInArrow(frugal(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    top = W.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    ranked = counts.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= size)
    grams: dict[str, list[tuple[int, int]]] = {}
    for r in ranked.collect():  # ``size`` rows a language
        grams.setdefault(r.lang, []).append((r["rank"], r.gram))
    return Profiles({x: np.array([g for _, g in sorted(v)], dtype=np.int64) for x, v in grams.items()}, size)


def predict_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(profiles)

    def run(batch: pa.RecordBatch) -> dict:
        found = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return map_arrow(slim, run, "doc_id long, lang_pred string, score double")
