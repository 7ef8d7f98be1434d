import base64

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlsift.functions.language import BUCKETS, language_detector, language_profile, trigram_buckets
from crawlsift.functions.naming import export_name, image_extension, pair_directory
from crawlsift.functions.numeric import class_probability, cosine
from crawlsift.functions.tokens import MAX_VOCABULARY, build_vocabulary, tokenizer


def test_names(spark):
    url = "http://hé.example/" + "ü?/+" * 60
    df = spark.createDataFrame([(url, 0.98765)], "u string, s double")
    raw = url.encode()
    got = df.select(
        export_name(F.col("u"), F.col("s"), "txt"), pair_directory(F.col("u"), F.col("u"), F.col("s"))
    ).first()
    token = lambda n: base64.urlsafe_b64encode(raw[:n]).decode()
    assert got[0] == f"{token(128)}_0.9876.txt" or got[0] == f"{token(128)}_0.9877.txt"
    assert got[1].startswith(f"{token(64)}_{token(64)}_0.987")
    kinds = spark.createDataFrame([("image/jpeg; q=1",), ("image/svg+xml",)], "c string")
    assert [r[0] for r in kinds.select(image_extension(F.col("c"))).collect()] == ["jpg", None]


def test_numeric(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 4.0, 6.0], [0.0, 0.0, 0.0])], "a array<double>, b array<double>, z array<double>")
    row = df.select(
        class_probability(F.col("a"), 2), cosine(F.col("a"), F.col("b")), cosine(F.col("a"), F.col("z")),
        cosine(F.col("a"), F.array(F.lit(1.0))), class_probability(F.array(F.lit(1e6), F.lit(0.0)), 0),
    ).first()
    e = np.exp([1, 2, 3])
    assert row[0] == pytest.approx(e[2] / e.sum())
    assert row[1] == pytest.approx(1.0)
    assert row[2] is None and row[3] is None and row[4] == 1.0


def test_vocabulary_and_tokens(spark):
    df = spark.createDataFrame([("b a a. C c c",), ("A é-1",), (None,), ("",)], "t string")
    vocab = build_vocabulary(df, "t", 3)
    assert [(r["token"], r["n"], r["id"]) for r in vocab.orderBy("id").collect()] == [("a", 3, 1), ("c", 3, 2), ("1", 1, 3)]
    tokens = [r[0] for r in df.select(tokenizer(vocab)(F.col("t"))).collect()]
    assert [t["input_ids"] for t in tokens] == [[0, 1, 1, 2, 2, 2], [1, 0, 3], None, []]
    assert tokens[0]["attention_mask"] == [1] * 6
    with pytest.raises(ValueError):
        build_vocabulary(df, "t", MAX_VOCABULARY + 1)


def test_language(spark):
    labelled = spark.createDataFrame(
        [("the cat and the dog and the hen", "en"), ("der hund und die katze und das huhn", "de"), (None, "xx"), ("x", None)],
        "t string, l string",
    )
    profile = language_profile(labelled, "t", "l")
    assert profile.count() == 2 * BUCKETS
    detect = language_detector(profile)
    texts = spark.createDataFrame([("and the hen",), ("und die",), ("ab",), (None,), ("😀😀😀x",)], "t string")
    got = [r[0] for r in texts.select(detect(F.col("t"))).collect()]
    assert got[:4] == ["en", "de", "unknown", None] and got[4] in ("en", "de")


def test_trigrams_are_code_points():
    want = [(961 * ord(a) + 31 * ord(b) + ord(c)) % BUCKETS for a, b, c in zip("a😀é\n", "😀é\n", "é\n")]
    assert trigram_buckets("a😀é\n").tolist() == want
