"""Fingerprints, links and components against brute force."""

import re

import numpy as np
import xxhash

from crawlsift.llm import simhash
from crawlsift.llm.components import connected_components


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest id reachable over fingerprints within 2 bits, by repeated minima over all pairs."""
    unique = sorted(set(prints.values()))
    near = [[j for j, b in enumerate(unique) if (a ^ b).bit_count() <= 2] for a in unique]
    least = [min(d for d, f in prints.items() if f == u) for u in unique]
    while True:
        new = [min(least[j] for j in row) for row in near]
        if new == least:
            return {d: least[unique.index(f)] for d, f in prints.items()}
        least = new


def unsigned(value):
    return value & (1 << 64) - 1


def test_fingerprint_is_the_plain_one(texts):
    for text in [*list(texts.values())[:40], None, "", " \t", "One", "One  two", "É ß\x0bA", "a b c a b c"]:
        assert simhash.fingerprint(text.encode() if text is not None else None) == plain_fingerprint(text)


def test_long_text_in_chunks(monkeypatch):
    data = " ".join(f"w{i * i % 977}" for i in range(5000)).encode()
    whole = simhash.fingerprint(data)
    monkeypatch.setattr(simhash, "word_chunks", lambda d: (d[i : i + 4].split() for i in range(0)) if not d else iter([d.split()[:7], d.split()[7:8], [], d.split()[8:]]))
    assert simhash.fingerprint(data) == whole == plain_fingerprint(data.decode())


def test_components_of_documents(spark, documents, texts):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    got = {r.doc_id: r for r in simhash.near_duplicates(documents).collect()}
    assert {d: unsigned(r.fp) for d, r in got.items()} == prints
    assert {d: r.component_id for d, r in got.items()} == plain_components(prints)


def crowded(n, seed=3):
    """Random, lonely and crowded fingerprints: chains and balls of near copies."""
    rng = np.random.default_rng(seed)
    points = set(map(int, rng.integers(0, 1 << 63, n, dtype=np.uint64)))
    for start in list(points)[:4]:
        at = start
        for _ in range(n // 4):
            at ^= 1 << int(rng.integers(64))
            points.add(at)
        points |= {start ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 20, (n, 3))}
    return np.array(sorted(points), dtype=np.uint64)


def groups(points, pairs):
    label = {int(p): int(p) for p in points}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(int(a)), root(int(b))))
        label[b] = a
    return {p: root(p) for p in label}


def all_pairs(points):
    return [(a, b) for i, a in enumerate(points) for b in points[i + 1 :] if (int(a) ^ int(b)).bit_count() <= 2]


def test_shard_links_connect_what_all_pairs_connect():
    for n in (1, 2, 300):
        points = crowded(n)
        expected = groups(points, all_pairs(points))
        assert groups(points, zip(*simhash.shard_links(points))) == expected
        i, j = simhash._crowded(points)
        assert groups(points, zip(points[i], points[j])) == expected


def test_routing_keeps_every_link():
    points = crowded(400)
    tree, shards = simhash.build_tree(np.random.default_rng(1).permutation(points), leaf=40)
    assert shards > 3
    parts = [set(map(int, points[at])) for _, at in simhash.route(tree, points)]
    assert all(any({int(a), int(b)} <= p for p in parts) for a, b in all_pairs(points))


def test_links_with_small_and_oversize_shards(spark):
    points = crowded(300)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    expected = groups(points, all_pairs(points))
    for limit in (1_000_000, 50):
        links = simhash.fingerprint_links(table, sample_step=2, leaf=20, shard_limit=limit).collect()
        assert groups(points, [(unsigned(r.a), unsigned(r.b)) for r in links]) == expected


def test_shards_are_cut_over_three_levels(spark, monkeypatch):
    points = np.unique(np.concatenate([crowded(300), np.random.default_rng(8).integers(0, 1 << 63, 3000, dtype=np.uint64)]))
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    levels = []
    deeper = simhash._deeper
    monkeypatch.setattr(simhash, "_deeper", lambda *args: levels.append(args[2]) or deeper(*args))
    monkeypatch.setattr(simhash, "SHARD_SAMPLE", 60)
    links = simhash.fingerprint_links(table, sample_step=1000, shard_limit=150).collect()
    assert max(levels) >= 2
    assert groups(points, [(unsigned(r.a), unsigned(r.b)) for r in links]) == groups(points, all_pairs(points))


def test_copies_of_a_fingerprint_stay_few():
    points = np.random.default_rng(5).integers(0, 1 << 63, 60_000, dtype=np.uint64)
    tree, shards = simhash.build_tree(points[:4096])
    parts = [len(at) for _, at in simhash.route(tree, points)]
    assert shards > 50 and max(parts) < 0.1 * len(points)
    assert sum(parts) < 6 * len(points)  # of 64 random bits each level keeps some 10 % on both sides


def test_connected_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame([*path, *star, (500, 500), (None, 3), (7, 6)], "a long, b long")
    got = dict(connected_components(links, "a", "b").collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(links.limit(0), "a", "b").collect() == []


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].component_id for i in (1, 2)} == {1}
    assert {by_id[i].fp for i in (3, 4, 5)} == {0} and by_id[3].component_id == 3 == by_id[5].component_id
    assert by_id[7].component_id == 7 == by_id[8].component_id
    assert sorted(r.component_id for r in rows if r.doc_id is None) == [1, 3]
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 9, 10] and ids.count(None) == 2
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.drop_near_duplicates(no_docs).columns == no_docs.columns
