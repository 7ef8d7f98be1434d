"""Subword merges against a plain version, and lossless encoding."""

from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from crawlsift.functions import subwords as S

TEXTS = ["the cat sat on the mat", "the the then", "aaaa aaa aa a", "x{y}z $1 {a}{b}", None, "", "é 你好 \U0001f600\n\n\ttab", "12 123 1234", "ababab abab"]


def plain_merges(texts, n_merges, per_round=1, least=2):
    words = Counter(w for t in texts if t for w in regex.findall(S.WORD, t))
    split = {w: list(w) for w in words}
    merges = []
    while len(merges) < n_merges:
        counts = Counter()
        for w, s in split.items():
            for pair in zip(s, s[1:]):
                counts[pair] += words[w]
        ranked = sorted(((l, r, n) for (l, r), n in counts.items() if n >= least), key=lambda p: (-p[2], p[0], p[1]))
        wanted = min(per_round, n_merges - len(merges))
        chosen = S._independent(ranked[: S._CANDIDATES * wanted], wanted)
        if not chosen:
            break
        merges += chosen
        for left, right, _ in chosen:
            for w, s in split.items():
                out, i = [], 0
                while i < len(s):
                    if s[i : i + 2] == [left, right]:
                        out.append(left + right)
                        i += 2
                    else:
                        out.append(s[i])
                        i += 1
                split[w] = out
    return merges


@pytest.mark.parametrize("per_round", [1, 3])
def test_merges_are_the_plain_ones(spark, per_round):
    table = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    assert S.learn_merges(table, "text", 12, per_round) == plain_merges(TEXTS, 12, per_round)
    assert S.learn_merges(table, "text", 0) == [] == S.learn_merges(table.limit(0), "text", 5)
    with pytest.raises(ValueError):
        S.learn_merges(table, "text", S.MAX_SUBWORDS + 1)


def test_learning_stops_where_nothing_repeats(spark):
    table = spark.createDataFrame([("ab cd",)], "text string")
    assert S.learn_merges(table, "text", 50) == []
    assert S.learn_merges(table, "text", 50, least=1) == [(" ", "c", 1), ("a", "b", 1), (" c", "d", 1)]


def test_longest_match():
    trie = S.Trie(["a", "b", "ab", "abc", "bcd"])
    first = S.BYTE_IDS
    assert trie.ids("abcd") == [first + 3, ord("d")]
    assert trie.ids("abx") == [first + 2, ord("x")] and trie.ids("") == []
    assert trie.ids("é") == list("é".encode())


def test_round_trip(spark):
    texts = [*TEXTS, "unseen ¶ characters \x00", "word " * 40_000, " " * 100_000]
    learnt = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    vocabulary = S.subword_vocabulary(learnt, "text", 20, 4)
    assert len(set(vocabulary)) == len(vocabulary)
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    encoded = table.select("i", "text", S.subword_encoder(vocabulary)(F.col("text")).alias("t"))
    rows = encoded.select("i", "text", "t.*", S.subword_decoder(vocabulary)(F.col("t.input_ids")).alias("back")).collect()
    for r in rows:
        assert r.back == (r.text or "") and r.attention_mask == [1] * len(r.input_ids)
    the = [r.input_ids for r in rows if r.text == "the the then"][0]
    assert len(the) < len("the the then")


def test_decoding_odd_ids(spark):
    table = spark.createDataFrame([(1, [65, 9999, -1, 66]), (2, None), (3, []), (4, [0xFF])], "i int, ids array<int>")
    got = {r.i: r.back for r in table.select("i", S.subword_decoder(["x"])(F.col("ids")).alias("back")).collect()}
    assert got == {1: "AB", 2: None, 3: "", 4: "�"}


def test_ids_of_odd_batches(spark):
    encode = S.subword_encoder(["a"])
    got = spark.createDataFrame([("ab" * 5,), (None,), ("",)], "t string").select(encode(F.col("t")).alias("t"))
    assert [r.t.input_ids for r in got.collect()] == [[S.BYTE_IDS, 98] * 5, [], []]


def test_sessions_hold_batches_to_a_size(spark):
    from crawlsift.session import BATCH_BYTES, BATCH_ROWS, attach

    rows, size = (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))
    before = spark.conf.get(rows), spark.conf.get(size)
    try:
        for given, kept in ((("10000", "67108864b"), (str(BATCH_ROWS), str(BATCH_BYTES))), (("0", "1g"), (str(BATCH_ROWS), str(BATCH_BYTES))), (("7", "1000b"), ("7", "1000b"))):
            spark.conf.set(rows, given[0])
            spark.conf.set(size, given[1])
            attach(spark)
            assert (spark.conf.get(rows), spark.conf.get(size)) == kept
    finally:
        spark.conf.set(rows, before[0])
        spark.conf.set(size, before[1])
