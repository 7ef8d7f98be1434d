"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a sequence of first turns (role and text) that some conversation starts with. Nodes are
named by the combined hash of their turns, each hashed together with its place (128 bits), so a
conversation's nodes are running combinations of its turns' hashes. Long conversations are cut
into blocks of ``BLOCK`` turns; only a block's total passes to the next.

Subtree totals are not handed up level by level: a chain of a million turns would take a million
joins. Rounds of two steps contract the tree instead. *Rake* takes off all leaves and adds what
they hold to their parents. *Compress* takes out, from chains of nodes with one child, nodes of
which no two are neighbours; what such a node holds is put on the edge above its child. Each round
takes off all leaves and a good part of every chain, so the rounds grow with the logarithm of the
number of nodes. Then the rounds are undone, last one first: a node that was taken out has its
child's total plus what lay between. Every round is written to the shared work folder.

No group is ever gathered: parents with very many children are reached through sums (combined
before the shuffle) or salted joins, a conversation's turns are numbered by ranges of the whole
table, and the conversations that end at one node are listed by ranges first, then digested as
a stream of long pieces.

Rows: turns without a ``conv_id`` belong to no conversation and are left out. A null turn comes
first; equal turns go by role, then text; a null role or text is empty. Repeated rows are turns of
their own. Very long texts count whole. An empty table gives no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlsift.llm.common import frugal, join_hot, ready
from crawlsift.session import materialize

# Fixed values.
#: Conversations share a beginning within groups of so many ids, of fewer than so many turns.
FAMILY = 100
SHARED_TURNS = 6
BLOCK = 4096
#: Rounds that choose chain nodes by a digit of their depth, which halves a chain; later ones
#: choose by a hash of id and round.
DIGIT_ROUNDS = 20
PIECE_CHARS = 1 << 16
_PART_BITS = 33  # where monotonically_increasing_id keeps the partition


def _numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in the conversation, and how many turns each conversation has.

    The table is sorted by ranges, so a conversation may lie in several parts; a turn's place is
    its place in the part plus what earlier parts have of its conversation.
    """
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    turns = (
        slim.repartitionByRange(*order[:3], F.left("text", F.lit(64)))
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit(1), "role", "text").alias("a"),
            F.xxhash64(F.lit(2), "role", "text").alias("b"),
            F.char_length("text").cast("long").alias("chars"),
        )
        .withColumn("part", F.shiftright("at", _PART_BITS))
    )
    turns = materialize(turns, "turns")
    parts = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sizes = parts.groupBy("conv_id").agg(F.sum("n").alias("n"))
    return turns.join(starts.drop("n"), ["conv_id", "part"]).select(
        "conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), "part", "a", "b", "chars"
    ), sizes


def rebuild(conversations: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: ``(conv_id, depth, a, b, chars, size)``.

    A conversation ``c`` gets the first ``h`` turns of conversation ``c - c % FAMILY``, then its
    own after its first ``h``, where ``h`` is the unsigned crc32 of its decimal id, modulo
    ``SHARED_TURNS``. ``a`` and ``b`` hash role and text, ``chars`` counts the text's code points,
    ``size`` is the number of rebuilt turns. Each conversation also has a row of depth 0.
    """
    ready(conversations.sparkSession)
    turns, sizes = _numbered(conversations)
    turns = materialize(turns, "numbered")
    sizes = materialize(sizes, "sizes")
    own = sizes.select(
        "conv_id",
        "n",
        (F.crc32(F.col("conv_id").cast("string")) % SHARED_TURNS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
    )
    bases = sizes.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    known = own.join(bases, "base", "left").withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    known = known.withColumn("size", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    known = materialize(known.select("conv_id", "base", "h", "shared", "size"), "known")
    # A family has at most 199 ids, so a shared turn is copied to so many conversations at most.
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED_TURNS)).select(
        F.col("conv_id").alias("base"), F.col("place").alias("depth"), "a", "b", "chars"
    )
    heads = known.join(heads, "base").where("depth <= h").select("conv_id", "depth", "a", "b", "chars", "size")
    # A long conversation lies in several parts; joined by part, no key has more rows than a part.
    by_part = turns.groupBy("conv_id", "part").agg(F.max("place").alias("last"))
    by_part = by_part.join(known, "conv_id").where("last > h").select("conv_id", "part", "h", "shared", "size")
    tails = turns.join(by_part, ["conv_id", "part"]).where("place > h")
    tails = tails.select("conv_id", (F.col("place") - F.col("h") + F.col("shared")).alias("depth"), "a", "b", "chars", "size")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("a", "b", "chars")]
    roots = known.select("conv_id", F.lit(0).cast("long").alias("depth"), *nothing, "size")
    return roots.union(heads).union(tails)


def _prefixed(turns: DataFrame) -> DataFrame:
    """Turns with the names of their node and of its parent: ``(conv_id, depth, chars, size, key,
    parent_key)``; a name combines the hashes of the turns up to there."""
    root = F.col("depth") == 0
    placed = turns.select(
        "conv_id",
        "depth",
        "chars",
        "size",
        F.floor(F.col("depth") / BLOCK).alias("block"),
        *[F.when(root, F.lit(0)).otherwise(F.xxhash64(F.lit(i), "depth", "a", "b")).alias(c) for i, c in ((3, "x"), (4, "y"))],
    )
    placed = materialize(placed, "placed")
    blocks = placed.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x0"), F.bit_xor("y").alias("y0"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("x0", "y0")]
    ).where("block > 0")
    so_far = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = placed.select("*", F.bit_xor("x").over(so_far).alias("x1"), F.bit_xor("y").over(so_far).alias("y1"))
    joined = inside.join(carried, ["conv_id", "block"], "left")

    def name(*columns: str) -> Column:
        halves = []
        for c in columns:
            total = F.col(f"{c}1").bitwiseXOR(F.coalesce(f"{c}0", F.lit(0)))
            halves.append(total.alias(c))
        return F.struct(*halves)

    named = joined.withColumn("key", name("x", "y"))
    parent = F.struct(F.col("key.x").bitwiseXOR(F.col("x")).alias("x"), F.col("key.y").bitwiseXOR(F.col("y")).alias("y"))
    return named.select(
        "conv_id", "depth", "chars", "size", "key", F.when(F.col("depth") > 0, parent).alias("parent_key")
    )


def _pieces(ends: DataFrame) -> DataFrame:
    """``(x, y, first, ids)``: the ids that end at a node, in ascending pieces of bounded length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        node, first, ids, size = None, None, [], 0

        def close() -> None:
            if ids:
                rows.append((*node, first, ",".join(ids)))

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["x", "y", "first", "ids"])

        for batch in batches:
            for x, y, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (x, y) or size >= PIECE_CHARS:
                    close()
                    node, first, ids, size = (x, y), conv_id, [], 0
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
            if len(rows) >= 1000:
                yield out()
                rows = []
        close()
        if rows:
            yield out()

    order = ["x", "y", "conv_id"]
    dealt = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(frugal(run), "x long, y long, first long, ids string")


def _end_digests(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)``: SHA-256 of the ids that end at each node, ascending, comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        node, digest = None, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["x", "y", "ends_sha256"])

        for batch in batches:
            for x, y, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == (x, y):
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    rows.append((*node, digest.hexdigest()))
                node, digest = (x, y), hashlib.sha256(ids.encode())
            if len(rows) >= 1000:
                yield out()
                rows = []
        if node is not None:
            rows.append((*node, digest.hexdigest()))
        if rows:
            yield out()

    dealt = _pieces(ends).repartition("x", "y").sortWithinPartitions("x", "y", "first")
    return dealt.mapInArrow(frugal(run), "x long, y long, ends_sha256 string").select(
        F.struct("x", "y").alias("key"), "ends_sha256"
    )


def _rake(active: DataFrame, weights: list[str]) -> DataFrame:
    """The nodes that are no leaves, with what their leaves held."""
    leaf = (F.col("kids") == 0) & F.col("parent").isNotNull()
    gains = active.where(leaf).groupBy(F.col("parent").alias("id")).agg(
        F.count(F.lit(1)).alias("lost"), *[F.sum(F.col(w) + F.col(f"edge_{w}")).alias(f"gain_{w}") for w in weights]
    )
    rest = active.where(~leaf).join(gains, "id", "left")
    return rest.select(
        "id",
        "parent",
        "depth",
        (F.col("kids") - F.coalesce("lost", F.lit(0))).alias("kids"),
        *[(F.col(w) + F.coalesce(f"gain_{w}", F.lit(0))).alias(w) for w in weights],
        *[f"edge_{w}" for w in weights],
    )


def _mark(rest: DataFrame, weights: list[str], turn: int) -> DataFrame:
    """``rest`` with ``kid``, the only child of each node that is taken out, and what lies on that
    child's edge. Of neighbours in a chain, never both are taken out."""
    if turn < DIGIT_ROUNDS:
        coin = F.getbit("depth", F.lit(turn)) == 1
    else:
        coin = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 1
    may_go = (F.col("kids") == 1) & F.col("parent").isNotNull() & coin
    tossed = rest.withColumn("may_go", may_go)
    # A node with one child has one row here, so its least row is that child's.
    child = F.struct("id", F.col("may_go"), *[F.col(f"edge_{w}") for w in weights])
    children = tossed.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.min(child).alias("child"))
    joined = tossed.join(children, "id", "left")
    goes = F.col("may_go") & ~F.col("child.may_go")
    return joined.select(
        *rest.columns,
        F.when(goes, F.col("child.id")).alias("kid"),
        *[F.when(goes, F.col(w) + F.col(f"child.edge_{w}")).alias(f"above_{w}") for w in weights],
    )


def _compress(marked: DataFrame, weights: list[str]) -> DataFrame:
    """The nodes that stay; children of those taken out hang from their grandparent."""
    gone = marked.where("kid IS NOT NULL").select(
        F.col("kid").alias("id"),
        F.col("parent").alias("grandparent"),
        *[(F.col(w) + F.col(f"edge_{w}")).alias(f"more_{w}") for w in weights],
    )
    stay = marked.where("kid IS NULL").join(gone, "id", "left")
    return stay.select(
        "id",
        F.coalesce("grandparent", "parent").alias("parent"),
        "depth",
        "kids",
        *weights,
        *[(F.col(f"edge_{w}") + F.coalesce(f"more_{w}", F.lit(0))).alias(f"edge_{w}") for w in weights],
    )


def subtree_totals(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """``(id, *weights)``: sums of ``weights`` over the subtree of every node.

    ``nodes`` has ``id``, ``parent`` (null for roots), ``depth`` (a chain's nodes have successive
    ones; it only decides how fast chains shrink), ``kids`` (the number of children) and the
    weights (longs).
    """
    zero = F.lit(0).cast("long")
    active = materialize(
        nodes.select("id", "parent", "depth", "kids", *weights, *[zero.alias(f"edge_{w}") for w in weights]), "active"
    )
    totals = []  # per round: leaves taken off with their totals, nodes taken out
    turn = 0
    while active.where("parent IS NOT NULL").take(1):
        marked = materialize(_mark(materialize(_rake(active, weights), "raked"), weights, turn), "marked")
        totals.append((active.where("kids = 0 AND parent IS NOT NULL").select("id", *weights), marked))
        active = materialize(_compress(marked, weights), "active")
        turn += 1
    known = active.select("id", *weights)
    for leaves, marked in reversed(totals):
        out = marked.where("kid IS NOT NULL").select("id", "kid", *[f"above_{w}" for w in weights])
        if out.take(1):
            below = known.select(F.col("id").alias("kid"), *[F.col(w).alias(f"below_{w}") for w in weights])
            found = out.join(below, "kid").select("id", *[(F.col(f"above_{w}") + F.col(f"below_{w}")).alias(w) for w in weights])
            known = known.union(materialize(found, "expanded"))
        known = known.union(leaves)
    return known


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``turns`` are those of ``rebuild``. ``saved_tokens`` adds, over the subtree, a node's members
    but one times the code points of its last text.
    """
    members = materialize(_prefixed(turns), "members")
    nodes = members.groupBy("key").agg(
        F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("chars").alias("chars"),
        F.min("parent_key").alias("parent_key"),
    )
    nodes = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    children = nodes.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count(F.lit(1)).alias("kids"))
    counted = nodes.join(children, "key", "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    counted = materialize(counted, "counted")
    parents = counted.where("kids > 0").select(
        F.col("key").alias("parent_key"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("kids").alias("siblings")
    )
    linked = join_hot(counted, parents, "parent_key", "siblings", counted.count(), F.col("id")).drop("siblings")
    linked = linked.withColumn("n_leaves", F.when(F.col("kids") == 0, 1).otherwise(0).cast("long")).withColumn(
        "saved_tokens", (F.col("n_convs") - 1) * F.col("chars")
    )
    linked = materialize(linked, "linked")
    sums = subtree_totals(linked, ["n_leaves", "saved_tokens"])
    ends = members.where("depth = size").select(F.col("key.x").alias("x"), F.col("key.y").alias("y"), "conv_id")
    found = linked.drop("n_leaves", "saved_tokens").join(sums, "id").join(_end_digests(ends), "key", "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("kids").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
