"""Language of a text by hashed character trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Size of the trigram table and the scale of the integer weights.
BUCKETS = 4096
WEIGHT_SCALE = 1_000_000
#: A profile holds at most this many languages times BUCKETS rows.
MAX_LANGUAGES = 256


def trigram_buckets(text: str) -> np.ndarray:
    """Bucket of every character trigram: (961 a + 31 b + c) mod BUCKETS on code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if len(codes) < 3:
        return np.empty(0, dtype=np.int64)
    return (961 * codes[:-2] + 31 * codes[1:-1] + codes[2:]) % BUCKETS


def language_profile(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``(lang, bucket, weight)`` learned from labelled texts.

    Each task reduces its texts to trigram counts before the shuffle, so at most languages x
    BUCKETS rows leave it however long the texts are. Every bucket is counted, also with 0, so
    totals and unseen buckets come from the counts themselves and texts are read once. The weight
    is the smoothed log frequency, scaled to an integer: sums are exact in any order.
    """

    def rows(totals: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for code, seen in totals.items():
            yield pd.DataFrame({"lang": code, "bucket": np.arange(BUCKETS), "n": seen})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for body, code in zip(batch["text"], batch["lang"]):
                if body is None or code is None:
                    continue
                seen = np.bincount(trigram_buckets(body), minlength=BUCKETS)
                totals[code] = totals[code] + seen if code in totals else seen
            if len(totals) > MAX_LANGUAGES:  # stray labels do not pile up
                yield from rows(totals)
                totals = {}
        yield from rows(totals)

    counts = (
        df.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
        .mapInPandas(count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    total = F.sum("n").over(W.partitionBy("lang"))  # BUCKETS rows a language
    weight = F.round(WEIGHT_SCALE * F.log((F.col("n") + 1.0) / (total + float(BUCKETS))))
    return counts.select("lang", "bucket", weight.cast("long").alias("weight"))


def language_detector(profile: DataFrame):
    """Function ``text column -> language code`` for a profile.

    The profile has a proven bound (MAX_LANGUAGES x BUCKETS integers, 8 MB), so it travels
    with the function and texts are scored where they lie, without a shuffle. Texts without
    any trigram get ``unknown``; equal scores go to the first code in order.
    """
    bound = MAX_LANGUAGES * BUCKETS
    rows = profile.select("lang", "bucket", "weight").limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"profile exceeds {MAX_LANGUAGES} languages")
    langs = sorted({r["lang"] for r in rows})
    index = {code: i for i, code in enumerate(langs)}
    weights = np.zeros((BUCKETS, len(langs)), dtype=np.int64)
    for r in rows:
        weights[r["bucket"], index[r["lang"]]] = r["weight"]

    def best(text: str | None) -> str | None:
        if text is None:
            return None
        seen = trigram_buckets(text)
        if not len(seen):
            return "unknown"
        counts = np.bincount(seen, minlength=BUCKETS)
        return langs[int(np.argmax(counts @ weights))]

    @F.pandas_udf(T.StringType())
    def detect(texts: pd.Series) -> pd.Series:
        return pd.Series([best(t) for t in texts], dtype=object)

    def detect_language(text: Column) -> Column:
        return detect(text)

    return detect_language
