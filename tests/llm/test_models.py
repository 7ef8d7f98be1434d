"""Importance resampling, language profiles and toxicity chains."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlsift.llm import importance, rank_order, toxicity
from crawlsift.llm.queries import queries

BIG = "/root/testdata/sf0.01"


def plain_features(text):
    tokens = re.findall(r"\w+|[^\w\s]+", text or "")
    return [importance.features(t)[0] for t in tokens], tokens


def test_features_are_tokens_and_pairs(monkeypatch):
    single, tokens = plain_features("Ab ab, ab ab!! cd")
    got = importance.features("Ab ab, ab ab!! cd")
    assert list(got[: len(tokens)]) == single and len(got) == 2 * len(tokens) - 1
    assert importance.features("x x")[2] == importance.features("yy yy")[2]
    text = " ".join(f"w{i % 17}, v" for i in range(500))
    whole = np.bincount(importance.features(text), minlength=importance.BUCKETS)
    monkeypatch.setattr(importance, "_PIECE_CHARS", 64)
    assert (np.bincount(importance.features(text), minlength=importance.BUCKETS) == whole).all()
    assert len(importance.features(None)) == len(importance.features("")) == 0


def test_weights_against_plain_counts(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    got = {r.doc_id: r for r in importance.resample(documents, labels, k=50).collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1}
    raw, target = collections.Counter(), collections.Counter()
    texts = {r.doc_id: importance.features(r.text) for r in documents.collect()}
    for d, f in texts.items():
        raw.update(f.tolist())
        if d in good:
            target.update(f.tolist())
    n, m, b = sum(raw.values()), sum(target.values()), importance.BUCKETS
    weight = {d: sum(math.log((target[x] + 1) / (m + b)) - math.log((raw[x] + 1) / (n + b)) for x in f.tolist()) for d, f in texts.items()}
    assert all(abs(r.log_weight - weight[d]) < 1e-6 * max(1, abs(weight[d])) for d, r in got.items())
    noise = {r.doc_id: r.g for r in documents.select("doc_id", importance.gumbel(importance.SEED, F.col("doc_id")).alias("g")).collect()}
    keys = sorted(((weight[d] + noise[d], d) for d in weight), reverse=True)
    assert len(got) == 50 and set(got) == {d for _, d in keys[:50]}


def test_gumbel_numbers_are_gumbel(spark):
    x = np.array([r[0] for r in spark.range(20_000).select(importance.gumbel(1, F.col("id"))).collect()])
    assert abs(x.mean() - 0.5772) < 0.05 and abs(x.std() - math.pi / math.sqrt(6)) < 0.05


def test_kth_largest(spark):
    values = [float(v) for v in [5, 5, 5, 1, -1e9, 2, 3, None, 7] if v is not None]
    frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    for k in range(1, len(values) + 1):
        assert importance.kth_largest(frame, "x", k) == sorted(values, reverse=True)[k - 1]
    many = spark.range(30_000).select(F.randn(1).alias("x"))
    exact = sorted((r.x for r in many.collect()), reverse=True)
    assert importance.kth_largest(many, "x", 12_345) == exact[12_344]


def test_best_level():
    level = importance.best_level(np.array([1.0, 2, 3, 10, 11]), np.array([False, False, False, True, True]))
    assert level == 6.5
    assert importance.best_level(np.array([1.0]), np.array([True])) == -np.inf
    assert importance.best_level(np.array([]), np.array([], dtype=bool)) == -np.inf


def test_importance_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (6, 0), (None, 1), (99, 1), (3, None)], "doc_id long, quality int")
    out = importance.select_quality(odd_docs, labels)
    assert out.columns == odd_docs.columns and 0 < out.count() <= odd_docs.count()
    assert importance.select_quality(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert importance.select_quality(no_docs, labels).collect() == []
    drawn = importance.resample(odd_docs, labels, k=3)
    assert "log_weight" in drawn.columns and "Log_Weight" not in drawn.columns and drawn.count() >= 3
    assert importance.resample(odd_docs, labels, k=0).collect() == []


def plain_profile_counts(text):
    counts = collections.Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        padded = f" {word} "
        counts.update(word)
        counts.update("2" + padded[i : i + 2] for i in range(len(padded) - 1))
        counts.update("3" + padded[i : i + 3] for i in range(len(padded) - 2))
    return counts


def test_gram_counts_are_the_plain_ones(texts, monkeypatch):
    for text in [*list(texts.values())[:20], "a", "Ab, ab 1c_d", "É\U0001f600ñ你", None, ""]:
        assert sorted(rank_order.gram_counts(text)[1]) == sorted(plain_profile_counts(text).values())
    text = "one two three four " * 50
    whole = [x.tolist() for x in rank_order.gram_counts(text)]
    monkeypatch.setattr(rank_order, "_PIECE_CHARS", 11)
    assert [x.tolist() for x in rank_order.gram_counts(text)] == whole


def test_out_of_place_distance():
    def grams(text):
        return rank_order.top_grams(*rank_order.gram_counts(text), 5)

    ranked = {"x": grams("aaa aab"), "y": grams("zzz zzy")}
    profiles = rank_order.Profiles(ranked, 5)
    own = grams("aab b")
    distance = {
        x: sum(abs(list(r).index(g) - i) if g in r else 5 for i, g in enumerate(own)) for x, r in ranked.items()
    }
    best = min(sorted(distance), key=distance.get)
    assert profiles.predict("aab b") == (best, 1 - distance[best] / (5 * len(own)))


def test_language_of_held_out_documents(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    rows = queries()["op5_language_id"](spark, BIG).collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [docs[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert np.mean(held) > 0.98


def test_language_odd_rows(odd_docs, no_docs):
    profiles = rank_order.learn(odd_docs, "text", "lang", F.col("doc_id"))
    rows = rank_order.predict_languages(odd_docs, profiles).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id for r in rows if r.lang_pred == "und" and r.score == 0} == {3, 4, 5, None}
    none = rank_order.learn(no_docs, "text", "lang", F.col("doc_id"))
    assert {r.lang_pred for r in rank_order.predict_languages(odd_docs, none).collect()} == {"und"}
    assert rank_order.predict_languages(no_docs, profiles).collect() == []


def test_numerals_are_no_letters(spark):
    texts = ["½ ² ①", "ⅷ", "12 ٣", "_ - !", "ª", "ʰ", "あ", "x ⅷ"]
    profiles = rank_order.Profiles({"en": rank_order.top_grams(*rank_order.gram_counts("the cat"), 50)})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in rank_order.predict_languages(docs, profiles).collect()}
    assert [got[i] for i in range(len(texts))] == ["und"] * 4 + ["en"] * 4


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(rank_order, "MAX_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        rank_order.learn(docs, "text", "lang", F.col("doc_id"))


def test_toxic_documents(spark):
    documents = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    seen = labels.where("doc_id % 4 <> 0").withColumn("low_quality", 1 - F.col("quality"))
    chain = toxicity.learn(documents, seen, ["low_quality", "toxic"])
    scores = {r.doc_id: r for r in toxicity.score_toxicity(documents, chain).collect()}
    assert len(scores) == documents.count()
    unseen = labels.where("doc_id % 4 = 0").collect()
    flagged = {r.doc_id for r in toxicity.flag_toxic(spark.createDataFrame(list(scores.values()))).collect()}
    clean = [r.doc_id in flagged for r in unseen if not r.toxic]
    toxic = [r.doc_id in flagged for r in unseen if r.toxic]
    assert np.mean(clean) <= 0.02 and np.mean(toxic) >= 0.6  # a few dozen toxic rows to learn from


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 50, 6)) for _ in range(300)]
    first = np.array([5 in r for r in rows], dtype=float)
    truth = np.column_stack((first, first))
    seen = []
    real = toxicity.fit_linear

    def spy(part, before, target, *a):
        seen.append((len(part), before.shape))
        return real(part, before, target, *a)

    toxicity.fit_linear = spy
    try:
        chain = toxicity.fit_chain(rows, truth, np.arange(300) % 3, ["a", "b"])
    finally:
        toxicity.fit_linear = real
    assert seen == [(300, (300, 0)), (200, (200, 0)), (200, (200, 0)), (200, (200, 0)), (300, (300, 1))]
    hit = chain.models[1].predict(np.array([5]), [0.95])
    assert hit > 0.5 > chain.models[1].predict(np.array([7]), [0.02])


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    chain = toxicity.learn(odd_docs, labels, ["toxic"])
    assert toxicity.score_toxicity(odd_docs, chain).count() == odd_docs.count()
    none = toxicity.learn(odd_docs, labels.limit(0), ["toxic"])
    assert {r.p_toxic for r in toxicity.score_toxicity(odd_docs, none).collect()} == {0.0}
    assert toxicity.score_toxicity(no_docs, chain).collect() == []
