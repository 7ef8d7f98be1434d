"""Exact duplicates, mixing and line windows: edge cases and brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from crawlsift.llm import exact_dedup, line_windows, mixing
from crawlsift.llm.queries import mix_columns


def test_exact_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = exact_dedup.exact_duplicates(odd_docs, digest_all=True).collect()
    source = odd_docs.collect()
    assert len(rows) == len(source)
    body = {i: re.sub("[\x20\x09-\x0d]", "", t or "") for i, t in ((r.doc_id, r.text) for r in source) if i is not None}
    for r in rows:
        if r.doc_id is not None:
            assert r.digest == hashlib.sha256(body[r.doc_id].encode()).hexdigest()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert sorted(of[1]) == [(1, 4, False), (1, 4, True)] and of[2] == [(1, 4, False)]
    # All empty: the three code points of the blank text win.
    assert of[3] == [(5, 4, False)] and of[5] == [(5, 4, True)] and sorted(of[None]) == [(1, 4, False), (5, 4, False)]
    assert of[8] == [(8, 2, True)] and of[7] == [(8, 2, False)] and of[6] == [(6, 1, True)]
    assert exact_dedup.exact_duplicates(no_docs).collect() == []


def test_digest_only_where_needed_and_false_hits(odd_docs):
    lean = {(r.doc_id, r.keep_id, r.kept): r.digest for r in exact_dedup.exact_duplicates(odd_docs).collect()}
    assert lean[6, 6, True] is None and lean[2, 1, False] is not None
    tight = exact_dedup.exact_duplicates(odd_docs, filter_words=1).collect()
    assert sorted(map(str, ((r.doc_id, r.keep_id, r.kept) for r in tight))) == sorted(map(str, lean_keys(odd_docs)))


def lean_keys(docs):
    return [(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.exact_duplicates(docs).collect()]


def test_hot_group_keeps_every_row(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup.exact_duplicates(docs)
    assert found.count() == 20_000 and found.where("kept").count() == 20_000 - 6667 + 1
    assert found.where("keep_id = 0 AND group_size = 6667").count() == 6667


def test_prefix_twins_are_not_duplicates(spark):
    head = "x" * 200
    docs = spark.createDataFrame([(1, head + "a"), (2, head + "b"), (3, head + "a ")], "doc_id long, text string")
    assert sorted(lean_keys(docs)) == [(1, 3, False), (2, 2, True), (3, 3, True)]


def plain_shares(nodes, budget):
    """Water-filling by rounds: who is full drops out, the rest shares again."""
    got, open_ = {}, {n: (w, c) for n, (w, c) in nodes.items() if w > 0}
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c <= budget * w / total + 1e-9]
        if not full:
            return got | {n: budget * w / total for n, (w, _) in open_.items()} | {n: 0 for n in nodes if n not in got and n not in open_}
        for n in full:
            got[n] = open_.pop(n)[1]
        budget -= sum(got[n] for n in full)
    return got | {n: 0 for n in nodes if n not in got}


MIX = mixing.Mixture({"web": 5, "books": 1}, {"en": 3, "de": 1}, {"a": 2, "b": 1, "never": 0}, share=0.6, max_epochs=3, seed=4)
LEAVES = [
    ("web", "en", "a", 100), ("web", "en", "b", 4000), ("web", "de", "a", 50), ("web", "de", "never", 900),
    ("books", "en", "a", 2000), ("books", "de", "b", 10), ("books", None, "b", 300), (None, "en", None, 40),
]


def test_budgets_are_the_plain_ones(spark):
    sized = spark.createDataFrame([(d, l, s, n, str(i), n) for i, (d, l, s, n) in enumerate(LEAVES)], "domain string, lang string, source string, docs long, leaf string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(sized, MIX).collect()}
    weight = lambda table, name: table.get(name, MIX.other)
    room = {(d, l, s): n * 3 if weight(MIX.sources, s) else 0 for d, l, s, n in LEAVES}
    top = plain_shares({d: (weight(MIX.domains, d), sum(v for k, v in room.items() if k[0] == d)) for d, *_ in LEAVES}, 0.6 * sum(n for *_, n in LEAVES))
    expected = {}
    for d, b in top.items():
        langs = plain_shares({l: (weight(MIX.languages, l), sum(v for k, v in room.items() if k[:2] == (d, l))) for e, l, *_ in LEAVES if e == d}, b)
        for l, c in langs.items():
            shares = plain_shares({s: (weight(MIX.sources, s), room[e, m, s]) for e, m, s, _ in LEAVES if (e, m) == (d, l)}, c)
            expected |= {(d, l, s): v for s, v in shares.items()}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) <= 1 for k in got)


def test_prefix_by_epoch_order(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(id % 7 as int))").alias("text"), F.lit("en").alias("lang"), F.lit("src0").alias("source"))
    mix = mixing.Mixture(share=1.4, max_epochs=2, seed=9)
    rows = mixing.mix_epochs(docs, mix, **mix_columns()).collect()
    total = sum(r.doc_id % 7 for r in rows)
    budget = int(1.4 * total) - total
    key = lambda i: hashlib.md5(f"9:1:{i}".encode()).hexdigest()[:16]
    reach, twice = 0, set()
    for i in sorted(range(500), key=key):
        reach += i % 7
        if reach > budget:
            break
        twice.add(i)
    # Documents without tokens behind the last one taken do not reach the cut.
    assert {r.doc_id for r in rows if r.epochs == 2} ^ twice <= {i for i in range(500) if i % 7 == 0}
    assert all(r.epochs in (1, 2) for r in rows)
    taken = mixing.mix_documents(docs, mix, **mix_columns())
    assert taken.columns == docs.columns and taken.count() == sum(r.epochs for r in rows)


def water_filled(children, budget):
    """What each (weight, capacity) gets: the emptiest by weight is used up first."""
    order = sorted((c / w, i) for i, (w, c) in enumerate(children) if w)
    got, rest, heft = [0.0] * len(children), budget, sum(w for w, _ in children)
    for ratio, i in order:
        weight, capacity = children[i]
        got[i] = min(capacity, weight * rest / heft)
        rest, heft = rest - got[i], heft - weight
    return got


@pytest.mark.parametrize("splits", [2, 7, 256])
def test_large_families_are_shared_out_by_buckets(spark, monkeypatch, splits):
    monkeypatch.setattr(mixing, "SPLITS", splits)
    families = {
        ("a", None): ([(1 + i % 3, float(i * i % 997)) for i in range(2000)], 2e5),
        ("b", "x"): ([(1 + i % 2, float((1 + i % 2) * (5 + i % 4))) for i in range(900)], 7000.0),  # four ratios
        ("b", "y"): ([(i % 2, float(i % 2 * 10)) for i in range(40)], 1e6),  # more than there is; weights of zero
        ("c", "x"): ([(1, 0.0), (0, 0.0)], 50.0),
        (None, None): ([(2.0, 1e9), (1.0, 1e9), (1.0, 3.0)], 0.0),
    }
    rows = [(*k, i, float(w), c, b) for k, (children, b) in families.items() for i, (w, c) in enumerate(children)]
    nodes = spark.createDataFrame(rows, "d string, l string, i int, w double, cap double, b double")
    shared = mixing._share_out(nodes, ["d", "l"], "w", "cap", "b", "got").collect()
    assert len(shared) == len(rows)
    for key, (children, budget) in families.items():
        got = {r.i: r.got for r in shared if (r.d, r.l) == key}
        assert [got[i] for i in range(len(children))] == pytest.approx(water_filled(children, budget), rel=1e-9, abs=1e-9)


def test_mixing_odd_rows(odd_docs, no_docs):
    mix = mixing.Mixture(share=1.0, max_epochs=2, seed=1)
    out = mixing.mix_documents(odd_docs, mix, **mix_columns())
    assert out.columns == odd_docs.columns and 0 < out.count() <= 2 * odd_docs.count()
    assert mixing.mix_documents(no_docs, mix, **mix_columns()).collect() == []


def plain_windows(docs):
    """Lines left of each document, by walking all windows in order."""
    seen, out = set(), {}
    for d, text in sorted(docs.items()):
        lines = (text or "").split("\n") if text else []
        full = [i for i, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")]
        drop = set()
        for at in range(len(full) - 2):
            three = tuple(lines[i].strip(" \t\n\x0b\x0c\r") for i in full[at : at + 3])
            if three in seen:
                drop |= set(full[at : at + 3])
            seen.add(three)
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text
    return out


def test_line_windows_against_a_walk(spark):
    docs = {
        1: "a\nb\nc\nd", 2: "b\nc\nd\ne", 3: "x\nx\nx\nx\nx", 4: " a \n\n b\nc\r\nz", 5: "a\nb", 6: None, 7: "",
        8: "q\nb\nc\nd\ne\nr\na\nb\nc", 9: "A\nb\nc",
    }
    table = spark.createDataFrame([(d, t, 7) for d, t in docs.items()], "doc_id long, text string, N_LINES int")
    got = {r.doc_id: r for r in line_windows.remove_repeated_lines(table).collect()}
    assert {d: r.text for d, r in got.items()} == plain_windows(docs)
    assert got[2].n_lines == 4 and got[2].n_removed == 3 and got[6].n_removed == 0


def test_line_windows_odd_rows(odd_docs, no_docs):
    out = line_windows.remove_repeated_lines(odd_docs)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and out.columns[: len(odd_docs.columns)] == odd_docs.columns
    assert {r.doc_id: r.text for r in rows if r.doc_id == 9} == {9: "a\n\nb\nc\nd\nx\n"}
    assert line_windows.remove_repeated_lines(no_docs).collect() == []


@pytest.mark.parametrize("hot", [2, 900])
def test_a_window_that_most_documents_share(spark, hot):
    docs = spark.range(1000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < hot, F.concat(F.lit("one\ntwo\nthree\n"), F.col("id").cast("string"))).otherwise(F.col("id").cast("string")).alias("text"),
    )
    out = line_windows.remove_repeated_lines(docs)
    assert out.where("n_removed = 3").count() == hot - 1 and out.where("n_removed = 0").count() == 1001 - hot
