"""The conversation trie against a plain version, and tree contraction on odd trees."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from crawlsift.llm import trie
from crawlsift.llm.queries import op12_conversation_trie
from tests.llm.conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string, depth string, Key int, parent long"


def plain_trie(rows):
    """Node rows of conversations given as (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(t)] for c, t in turns.items()}
    rebuilt = {}
    for c, sequence in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = own.get(base, [])[:h] + sequence[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, sequence in rebuilt.items():
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].append(c)
            if d:
                children[tuple(sequence[: d - 1])].add(tuple(sequence[:d]))
    totals, out = {}, []
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [totals[x] for x in children[node]]
        totals[node] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
        ends = ",".join(map(str, sorted(c for c in members[node] if len(rebuilt[c]) == len(node))))
        out.append(
            (
                min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_equals_plain(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = op12_conversation_trie(spark, SF)
    assert got.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert {f.dataType.simpleString() for f in got.schema if f.name != "ends_sha256"} == {"bigint"}
    assert found(got) == plain_trie(map(tuple, rows))


def odd_rows():
    rng = random.Random(5)
    texts = ["a", "b", "", None, "é😀", "long " * 5000]
    rows = [
        (c, rng.choice([None, 0, 1, 2, 2, 3]), rng.choice(["user", None, ""]), rng.choice(texts))
        for c in [*range(95, 130), 200, 203, 299, 555, -3, -100, -101, 10**15 + 7, 10**15]
        for _ in range(rng.randint(1, 9))
    ]
    rows += rows[:20]  # repeated turns
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    rows += [(300, i, "user", "same") for i in range(200)] + [(301, i, "user", "same") for i in range(190)]
    return rows


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 7)
    rows = odd_rows()
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    assert found(trie.prefix_trie(trie.rebuild(table))) == plain_trie(rows)


def test_conversation_over_several_parts(spark):
    rows = [(c, i, "user", f"{i % 3}") for c in (7, 100) for i in range(400)] + [(101, 0, "u", "x")]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
        numbered, _ = trie._numbered(table)
        assert numbered.where("conv_id = 7").select("part").distinct().count() > 2
        assert found(trie.prefix_trie(trie.rebuild(table))) == plain_trie(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_conversations(spark):
    assert found(trie.prefix_trie(trie.rebuild(spark.createDataFrame([], SCHEMA)))) == []
    nobody = spark.createDataFrame([(None, 1, "user", "x", "", 1, 2)], SCHEMA)
    assert found(trie.prefix_trie(trie.rebuild(nobody))) == []


def test_long_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_CHARS", 20)
    ends = [(x, 1, i * 10 + x) for x in (1, 2) for i in range(300)]
    got = trie._end_digests(spark.createDataFrame(ends, "x long, y long, conv_id long"))
    for key, digest in got.collect():
        ids = ",".join(str(i * 10 + key.x) for i in range(300))
        assert digest == hashlib.sha256(ids.encode()).hexdigest()


def trees():
    rng = random.Random(2)
    yield "chain", [None, *range(299)]
    yield "star", [None] + [0] * 300
    yield "random", [None] + [rng.randrange(i) for i in range(1, 300)]
    yield "brush", [None, *range(99)] + [rng.randrange(100) for _ in range(200)]
    yield "chains", [None] + [0 if i % 60 == 0 else i for i in range(300)]
    yield "forest", [None, None, 0, 1, 2, 3]
    yield "one", [None]


@pytest.mark.parametrize("name, parents", list(trees()))
def test_subtree_totals(spark, monkeypatch, name, parents):
    n = len(parents)
    kids, depth, total = [0] * n, [0] * n, [i * i + 1 for i in range(n)]
    for i, p in enumerate(parents):
        if p is not None:
            kids[p] += 1
            depth[i] = depth[p] + 1
    rows = [(i * 3, None if p is None else p * 3, depth[i], kids[i], total[i], 1) for i, p in enumerate(parents)]
    for i in range(n - 1, -1, -1):
        if parents[i] is not None:
            total[parents[i]] += total[i]
    rounds = []
    marked = trie._mark
    monkeypatch.setattr(trie, "_mark", lambda *args: rounds.append(1) or marked(*args))
    table = spark.createDataFrame(rows, "id long, parent long, depth long, kids long, w long, one long")
    got = {r.id: (r.w, r.one) for r in trie.subtree_totals(table, ["w", "one"]).collect()}
    assert {i: w for i, (w, _) in got.items()} == {i * 3: total[i] for i in range(n)}
    assert len(rounds) <= 14  # a chain of 300 would take 300 rounds of rake alone


def test_chains_shrink_by_hash_too(spark, monkeypatch):
    monkeypatch.setattr(trie, "DIGIT_ROUNDS", 0)
    rows = [(i, i - 1 if i else None, i, 1 if i < 99 else 0, 1) for i in range(100)]
    table = spark.createDataFrame(rows, "id long, parent long, depth long, kids long, w long")
    assert {r.id: r.w for r in trie.subtree_totals(table, ["w"]).collect()} == {i: 100 - i for i in range(100)}
