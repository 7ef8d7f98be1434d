"""Contaminated documents against the edit distance of every item to every document."""

import re

import numpy as np
import pytest

from crawlsift.llm import decontaminate as D


def words_of(text):
    return re.sub("[!-/:-@\\[-`{-~]", " ", (text or "").lower()).replace("\x1c", "\x1c").split()


def plain_distance(item, text):
    """Least edits of ``item`` to any passage of ``text``, by the textbook recurrence."""
    row = [0] * (len(text) + 1)
    for word in item:
        new = [row[0] + 1]
        for j, other in enumerate(text):
            new.append(min(row[j] + (word != other), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def plain_contaminations(texts, items, similarity=0.8):
    out = {}
    for d, text in texts.items():
        have = words_of(text)
        known = set(have)
        for i, item in items.items():
            want = words_of(item)
            edits = int((1 - similarity) * len(want) + 1e-9)
            if want and sum(w in known for w in want) >= len(want) - edits:
                distance = plain_distance(want, have)
                if distance <= edits:
                    out[d, i] = distance
    return out


ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar"
FILL = " ".join(f"filler{i}" for i in range(300))


def run(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string, item_id string, distance int")
    items = spark.createDataFrame(items, "item_id long, text string, extra int")
    return docs, items, {(r.doc_id, r.item_id): r.distance for r in D.contaminations(docs, items, **options).collect()}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = int(rng.integers(len(words)))
        kind = rng.integers(3)
        if kind == 0:
            words[at] = "zulu"
        elif kind == 1:
            words.insert(at, "zulu")
        else:
            del words[at]
    return words


def test_edited_copies_are_found_and_others_left_alone(spark, texts):
    rng = np.random.default_rng(5)
    vocabulary = sorted({w for t in list(texts.values())[:50] for w in words_of(t)})
    items = {i: " ".join(rng.choice(vocabulary, int(rng.integers(12, 60)))) for i in range(60)}
    docs, far = {}, 0
    for i, item in items.items():
        words = item.split()
        for extra in (0, len(words) // 10, len(words) // 5, len(words) // 3):
            docs[len(docs)] = " ".join([FILL, *edited(rng, words, extra), FILL])
    expected = plain_contaminations(docs, items)
    _, _, got = run(spark, [(d, t, "x", 1) for d, t in docs.items()], [(i, t, 0) for i, t in items.items()])
    assert set(got) <= set(expected) and all(got[k] >= expected[k] for k in got)
    assert len(got) >= 0.97 * len(expected) and len(expected) > 150


def test_cases(spark):
    docs = [
        (1, f"{FILL} {ITEM.upper()}, {FILL}", None, 1),
        (2, ITEM, None, 1),
        (3, f"{FILL} {ITEM.replace(' ', '; ')}!", None, 1),
        (4, None, None, 1),
        (5, "", None, 1),
        (6, " ".join(ITEM.split()[:11]), None, 1),
        (7, " ".join(ITEM.split()[:12]), None, 1),
        (7, f"{ITEM} {ITEM}", None, 1),
        (None, ITEM, None, 1),
        (8, "short item", None, 1),
        (9, " ".join([FILL] * 2000 + [ITEM] + [FILL] * 2000), None, 1),
    ]
    items = [(10, ITEM, 0), (11, ITEM, 0), (12, None, 0), (13, " ,. ", 0), (14, "item", 0), (10, ITEM, 0)]
    frame, bench, got = run(spark, docs, items)
    for item in (10, 11):
        assert {d: v for (d, i), v in got.items() if i == item} == {1: 0, 2: 0, 3: 0, 7: 0, 9: 0, 7: 0, None: 0}
    assert {d for d, i in got if i == 14} == {8} and not {i for _, i in got} & {12, 13}
    _, _, sliced = run(spark, docs, items, slice_bytes=50)
    assert sliced == got
    clean = D.drop_contaminated(frame, bench)
    assert clean.columns == frame.columns and {r.doc_id for r in clean.collect()} == {4, 5, 6}


def test_three_edits_pass_and_four_do_not(spark):
    words = ITEM.split()
    near = " ".join(["zulu"] + words[1:7] + words[8:14] + ["yankee"])
    far = " ".join(["zulu"] + words[1:7] + words[8:13] + ["yankee"] * 2)
    _, _, got = run(spark, [(1, near, "", 0), (2, far, "", 0)], [(10, ITEM, 0)], recall=1.0)
    assert got == {(1, 10): 3}


def test_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert D.contaminations(no_docs, items).collect() == []
    assert D.contaminations(odd_docs, items.limit(0)).collect() == []
    assert D.drop_contaminated(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert D.drop_contaminated(odd_docs, items).columns == odd_docs.columns


def test_passage_distance_is_the_plain_one():
    rng = np.random.default_rng(0)
    for _ in range(40):
        item, text = rng.integers(0, 5, 6), rng.integers(0, 5, int(rng.integers(0, 15)))
        assert D.passage_distance(item, text)[0] == plain_distance(list(item), list(text))


@pytest.mark.parametrize("size", [14, 30, 57])
def test_recall_at_the_largest_distance(size):
    rng = np.random.default_rng(size)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 400, size)).encode() for _ in range(30)]
    index = D.Index(texts)
    found = 0
    for i in range(30):
        words = edited(rng, texts[i].decode().split(), index.edits[i])
        text = " ".join([FILL, *words, FILL]).encode()
        found += any(m[1] == i for m in index.matches([text]))
    assert found >= 29


@pytest.mark.parametrize("size", [1, 2, 3, 4])
def test_exact_copies_of_short_items_inside_a_text(size):
    rng = np.random.default_rng(size)
    items = sorted({" ".join(f"w{w}" for w in rng.integers(0, 2000, size)) for _ in range(300)})
    index = D.Index([i.encode() for i in items])
    texts = [f"x {item} y w1 {item} z".encode() for item in items]
    got = {(doc, item): (distance, end) for doc, item, distance, end in index.matches(texts)}
    assert all(got.get((i, i)) == (0, size + 1) for i in range(len(items)))
    assert {k: v[0] for k, v in got.items()} == plain_contaminations(
        {d: t.decode() for d, t in enumerate(texts)}, dict(enumerate(items))
    )


@pytest.mark.parametrize("size", [5, 8, 13, 20])
def test_recall_inside_a_text_of_short_items(size):
    rng = np.random.default_rng(size)
    items = [" ".join(f"w{w}" for w in rng.integers(0, 2000, size)) for _ in range(1000)]
    index = D.Index([i.encode() for i in items])
    texts = [" ".join(["x1 x2", *edited(rng, i.split(), index.edits[k]), "y1 y2 y3 y4", *["y5"] * size]) for k, i in enumerate(items)]
    found = {(doc, item) for doc, item, *_ in index.matches([t.encode() for t in texts])}
    assert sum((i, i) in found for i in range(1000)) >= 960


@pytest.mark.parametrize("limit", ["tables", "recall"])
def test_items_that_tables_do_not_reach_are_found_without_loss(monkeypatch, limit):
    rng = np.random.default_rng(3)
    items = [" ".join(f"w{w}" for w in rng.integers(0, 500, int(size))) for size in rng.integers(5, 120, 150)]
    if limit == "tables":
        monkeypatch.setattr(D, "MAX_TABLES", 0)
    index = D.Index([i.encode() for i in items], recall=1.0 if limit == "recall" else 0.97)
    copies = [edited(rng, i.split(), index.edits[k]) for k, i in enumerate(items)]
    texts = [" ".join([*copies[k], "x1 x2", *copies[-k], *copies[k][: len(copies[k]) // 2]]) for k in range(150)]
    got = {(doc, item): distance for doc, item, distance, _ in index.matches([t.encode() for t in texts])}
    assert got == plain_contaminations(dict(enumerate(texts)), dict(enumerate(items)))
