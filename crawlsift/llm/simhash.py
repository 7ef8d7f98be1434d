"""Near-duplicates by SimHash fingerprints, linked through vantage-point trees.

A small tree, built from a bounded sample of fingerprints, cuts the fingerprint space into
shards. A node splits by Hamming distance ``d`` to its vantage point: fingerprints with
``d <= mu`` go inside, those with ``d > mu - radius`` outside. By the triangle inequality two
fingerprints within ``radius`` of each other always meet on one side, so every link is found in
some shard, and a shard only overlaps its neighbours near the boundary. Shards that hold too much
for a task are cut again, by trees from samples of their own, until all fit. Inside a shard the
same tree goes on down to small blocks that are compared exactly.

Fingerprints so crowded that no vantage point divides them (a large group of near copies) are
linked through their neighbours at distance one: two fingerprints are within 2 exactly when they
share such a neighbour. That is linear in their number and exact, too.

Rows: equal fingerprints are one node, however many documents have it. Null and empty texts get
fingerprint zero and link like any other. A null id gets the component of its fingerprint, and a
component without any id is null. Repeated rows are returned as often as they come. Any other
columns are ignored.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.llm.common import free_name, join_hot, map_arrow, may_hold, ready, utf8, word_chunks
from crawlsift.llm.components import connected_components
from crawlsift.session import materialize

# Fixed values.
SEED = 42
SHINGLE_WORDS = 3
RADIUS = 2
BITS = 64
_HASH_BLOCK = 1 << 15
#: One in so many fingerprints at least, and no more than ``SAMPLE_LIMIT``, shape the top tree.
SAMPLE_STEP = 256
SAMPLE_LIMIT = 131_072
SAMPLE_PER_SHARD = 64
#: Blocks up to this size are compared pair by pair.
BLOCK = 192
#: A shard of more distinct fingerprints is cut further; a task needs up to 2.6 kB for each (when
#: they are crowded), so 130 MB at most.
SHARD_POINTS = 50_000
#: Fingerprints of a shard that shape its tree, and bits that name the tree's leaves.
SHARD_SAMPLE = 2_048
LEAF_BITS = 8
#: Trees below the top one; their leaves' names fill a long.
MAX_LEVELS = 5
_MASKS = np.array([0] + [1 << i for i in range(BITS)], dtype=np.uint64)


def fingerprint(data: bytes | None) -> int:
    """SimHash of a text's word shingles (UTF-8 in, unsigned 64 bits out)."""
    bits = np.zeros(BITS, dtype=np.int64)
    total = 0
    tail: list[bytes] = []

    def count(shingles: Iterator[bytes]) -> None:
        nonlocal total
        while block := [
            xxhash.xxh64_intdigest(s, SEED) for s in itertools.islice(shingles, _HASH_BLOCK)
        ]:
            hashes = np.array(block, dtype="<u8").view(np.uint8).reshape(-1, 8)
            bits[:] += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(block)

    for words in word_chunks((data or b"").lower()):
        words = tail + words
        count(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)))))
        tail = words[max(0, len(words) - SHINGLE_WORDS + 1) :]
    if total == 0:
        if not tail:
            return 0
        count(iter([b" ".join(tail)]))
    return int(np.packbits(2 * bits > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every row as a signed long."""
    ready(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        found = np.array([fingerprint(t) for t in utf8(batch.column(1))], dtype=np.uint64)
        return {"doc_id": batch.column(0), "fp": found.view(np.int64)}

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return map_arrow(slim, run, "doc_id long, fp long")


@dataclass
class Node:
    """Inner node of the top tree; leaves are shard numbers."""

    vantage: np.uint64
    mu: int
    inside: "Node | int"
    outside: "Node | int"


def _cut(points: np.ndarray, sample: np.ndarray, radius: int) -> tuple[np.uint64, int] | None:
    """Vantage point and ``mu`` that divide ``points`` with the least overlap; None when crowded."""
    step = max(1, len(points) // 12)
    best, chosen = None, None
    n = len(sample)
    for vantage in points[::step][:12]:
        counts = np.bincount(np.bitwise_count(sample ^ vantage), minlength=BITS + 1)
        inside = np.cumsum(counts)
        outside = n - np.concatenate((np.zeros(radius, dtype=np.int64), inside[:-radius]))
        good = np.maximum(inside, outside) <= 0.85 * n
        if good.any():
            cost = np.where(good, inside + outside + 0.1 * np.abs(inside - outside), np.inf)
            mu = int(cost.argmin())
            if best is None or cost[mu] < best:
                best, chosen = cost[mu], (vantage, mu)
    return chosen


def build_tree(sample: np.ndarray, radius: int = RADIUS, leaf: int = SAMPLE_PER_SHARD) -> tuple[Node | int, int]:
    """Top tree of a sample and its number of shards."""
    shards = itertools.count()

    def grow(points: np.ndarray) -> Node | int:
        cut = _cut(points, points, radius) if len(points) > 2 * leaf else None
        if cut is None:
            return next(shards)
        near = np.bitwise_count(points ^ cut[0])
        return Node(*cut, grow(points[near <= cut[1]]), grow(points[near > cut[1] - radius]))

    return grow(sample), next(shards)


def route(tree: Node | int, points: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, np.ndarray]]:
    """``(shard, positions)`` of the points that belong to each shard."""
    todo = [(tree, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if not isinstance(node, Node):
            yield node, at
            continue
        near = np.bitwise_count(points[at] ^ node.vantage)
        todo.append((node.inside, at[near <= node.mu]))
        todo.append((node.outside, at[near > node.mu - radius]))


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable by links ``(a, b)`` among ``n`` nodes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _crowded(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a crowded set through shared neighbours at distance one; linear in its size."""
    keys = np.concatenate([points ^ mask for mask in _MASKS])
    at = np.tile(np.arange(len(points)), len(_MASKS))
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    same = keys[1:] == keys[:-1]
    return at[:-1][same], at[1:][same]


def shard_links(points: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Star links ``(point, root)`` of all components of distinct points within ``radius``."""
    n = len(points)
    a, b = [], []
    todo = [np.arange(n)]
    while todo:
        at = todo.pop()
        if len(at) < 2:
            continue
        if len(at) <= BLOCK:
            block = points[at]
            i, j = np.nonzero(np.triu(np.bitwise_count(block[:, None] ^ block[None, :]) <= radius, 1))
        else:
            block = points[at]
            step = max(1, len(block) // 4096)
            cut = _cut(block, block[::step], radius)
            if cut is not None:
                near = np.bitwise_count(block ^ cut[0])
                inner, outer = at[near <= cut[1]], at[near > cut[1] - radius]
                if max(len(inner), len(outer)) <= 0.95 * len(at):
                    todo += [inner, outer]
                    continue
            i, j = _crowded(block)
        if len(i):
            label = _labels(len(at), i, j)
            moved = np.nonzero(label != np.arange(len(at)))[0]
            a.append(at[moved])
            b.append(at[label[moved]])
    if not a:
        return points[:0], points[:0]
    label = _labels(n, np.concatenate(a), np.concatenate(b))
    moved = np.nonzero(label != np.arange(n))[0]
    return points[moved], points[label[moved]]


def _shared_neighbours(points: DataFrame) -> DataFrame:
    """Links of crowded shards as a Spark join: a key has at most 65 fingerprints."""
    masks = [int(m) for m in _MASKS.view(np.int64)]
    keyed = points.select(
        "fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in masks])).alias("near")
    )
    least = keyed.groupBy("near").agg(F.min("fp").alias("root"))
    return keyed.join(least, "near").where("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b"))


def _dealt(points: pa.RecordBatch, trees: dict[int, Node | int]) -> dict:
    """``shard`` and ``fp`` of points that have a shard each, routed on by the trees of the shards."""
    shards = points.column(0).to_numpy(zero_copy_only=False)
    prints = points.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
    names, found = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.uint64)]
    order = np.argsort(shards, kind="stable")
    cuts = np.nonzero(np.diff(shards[order]))[0] + 1
    for at in np.split(order, cuts):
        shard = int(shards[at[0]])
        for leaf, inside in route(trees[shard], prints[at]):
            names.append(np.full(len(inside), shard << LEAF_BITS | leaf, dtype=np.int64))
            found.append(prints[at[inside]])
    return {"shard": np.concatenate(names), "fp": np.concatenate(found).view(np.int64)}


def _deeper(over: DataFrame, sizes: DataFrame, level: int) -> tuple[DataFrame, set[int]]:
    """Shards that hold too much, routed on by trees grown from samples of them; and those whose
    sample no vantage point divides. A tree is a few kB and has fewer than 2**LEAF_BITS leaves."""
    spark = over.sparkSession
    step = F.greatest(F.lit(1), F.ceil(F.col("count") / SHARD_SAMPLE)).cast("long")
    sample = over.join(sizes, "shard").where(F.pmod(F.xxhash64("fp", F.lit(level)), step) == 0).select("shard", "fp")
    leaf = max(1, SHARD_SAMPLE // 32)

    def grow(points: pa.Table) -> pa.Table:
        found = np.sort(points.column("fp").to_numpy().view(np.uint64))
        found = np.random.default_rng(SEED).permutation(found)
        tree, leaves = build_tree(found, leaf=leaf)
        while leaves >= 1 << LEAF_BITS:
            found = found[::2]
            tree, leaves = build_tree(found, leaf=leaf)
        return pa.table({"shard": points.column("shard").slice(0, 1), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    rows = sample.groupBy("shard").applyInArrow(grow, "shard long, tree binary").collect()
    trees = {r.shard: pickle.loads(bytes(r.tree)) for r in rows}
    whole = {shard for shard, tree in trees.items() if not isinstance(tree, Node)}
    shared = spark.sparkContext.broadcast(trees)
    routed = map_arrow(over.select("shard", "fp"), lambda batch: _dealt(batch, shared.value), "shard long, fp long")
    return routed, {shard << LEAF_BITS for shard in whole}


def fingerprint_links(
    distinct: DataFrame,
    sample_step: int = SAMPLE_STEP,
    leaf: int = SAMPLE_PER_SHARD,
    shard_limit: int = SHARD_POINTS,
) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within 2 bits.

    Within a shard a component comes as a star around one member, so there are no more links
    than routed rows. The sample for the top tree takes one fingerprint in ``sample_step``, or
    fewer so that it stays below ``SAMPLE_LIMIT``; shards of more than ``shard_limit`` fingerprints
    are cut by trees of their own, again and again until all fit. Samples decide only how work is
    dealt out.
    """
    spark = distinct.sparkSession
    step = max(sample_step, -(-distinct.count() // SAMPLE_LIMIT))
    rows = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(step)) == 0).collect()
    sample = np.sort(np.array([r.fp for r in rows], dtype=np.int64).view(np.uint64))
    sample = np.random.default_rng(SEED).permutation(sample)
    tree, _ = build_tree(sample, leaf=leaf)
    shared = spark.sparkContext.broadcast(tree)

    def deal(batch: pa.RecordBatch) -> dict:
        points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        parts = list(route(shared.value, points))
        return {
            "shard": np.repeat([s for s, _ in parts], [len(at) for _, at in parts]).astype(np.int64),
            "fp": points[np.concatenate([at for _, at in parts])].view(np.int64),
        }

    def link(shard: pa.Table) -> pa.Table:
        points = np.sort(shard.column("fp").to_numpy().view(np.uint64))
        a, b = shard_links(points)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    routed = materialize(map_arrow(distinct.select("fp"), deal, "shard long, fp long"), "shards")
    links: DataFrame | None = None
    crowded: set[int] = set()
    for level in itertools.count():
        sizes = materialize(routed.groupBy("shard").count(), "sizes")
        large = sizes.where(F.col("count") > shard_limit)
        # Shards that nothing divides are linked by a join over their fingerprints' neighbours.
        hopeless = F.col("shard").isin(sorted(crowded)) if crowded else F.lit(False)
        if level == MAX_LEVELS:
            hopeless = F.lit(True)
        fits = routed.join(large.select("shard"), "shard", "left_anti")
        found = fits.groupBy("shard").applyInArrow(link, "a long, b long")
        links = found if links is None else links.union(found)
        if large.isEmpty():
            return links
        over = routed.join(large.select("shard"), "shard", "left_semi")
        packed = over.where(hopeless)
        if not packed.isEmpty():
            links = links.union(_shared_neighbours(packed.select("fp").distinct()))
        over = over.where(~hopeless)
        if over.isEmpty():
            return links
        dealt, crowded = _deeper(over, large, level)
        routed = materialize(dealt, "shards")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id, component_size)`` for every row of ``docs``.

    ``component_id`` is the smallest id among all documents reachable over links of at most two
    differing bits; ``component_size`` counts rows.
    """
    spark = docs.sparkSession
    marked = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")),
        "distinct",
    )
    roots = connected_components(fingerprint_links(distinct), "a", "b")
    nodes = materialize(
        distinct.join(roots, distinct.fp == roots.node, "left").select(
            "fp", "least", "copies", F.coalesce("root", "fp").alias("root")
        ),
        "nodes",
    )
    total = marked.count()
    groups = nodes.groupBy("root").agg(
        F.min("least").alias("component_id"),
        F.sum("copies").alias("component_size"),
        F.count(F.lit(1)).alias("members"),
    )
    named = join_hot(nodes, groups, "root", "members", nodes.count(), F.col("fp"))
    named = named.select("fp", "copies", "component_id", "component_size")
    return join_hot(marked, named, "fp", "copies", total, F.col("doc_id")).select(
        "doc_id", "fp", "component_id", "component_size"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id.

    An id names one document, so of rows that repeat it one stays. Rows without an id cannot be
    named and all stay. Only rows that may have to go are shuffled; the rest is filtered in place.
    """
    key, drop, hit = (free_name(docs, name) for name in ("_keep_id", "_drop", "_hit"))
    # Ids that need a second look: those to drop, and those that several rows have.
    special = (
        near_duplicates(docs, id_col, text_col)
        .where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias(key))
        .agg(F.min(F.col("doc_id") != F.col("component_id")).alias(drop), F.count(F.lit(1)).alias("rows"))
        .where(F.col(drop) | (F.col("rows") > 1))
        .select(key, drop)
    )
    special = materialize(special, "special")
    doc_id = F.col(id_col).cast("long")
    marked = may_hold(docs, doc_id, special, F.col(key), hit)
    looked_up = marked.where(hit).drop(hit).join(special, doc_id == F.col(key), "left")
    kept = looked_up.where(~F.coalesce(drop, F.lit(False))).drop(key, drop)
    return marked.where(~F.col(hit)).drop(hit).union(kept.dropDuplicates([id_col]))
