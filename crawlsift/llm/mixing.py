"""Mixing sources to target weights by hierarchical budgets.

The tree has three levels: domain, language, source. A token budget flows from the root down:
children share it in proportion to their weights, and a child that has fewer tokens (times the
allowed epochs) gives what it cannot use to its siblings. As every node's capacity is known
before, shortages reach an ancestor's siblings only when the whole subtree is exhausted.

A leaf whose budget covers it ``n`` times is taken in ``n`` whole epochs and a token-prefix of
the next one, in an order seeded by epoch. The document in which the budget runs out is drawn: it
is taken as often, over all seeds, as the share of it that the budget still covers, so that a leaf
is expected to get its budget however few documents it has. The order key decides alone, so a leaf's choice comes
down to one cut key: ever narrower hash buckets find where it lies, and only the last one it falls
in is ordered row by row. No leaf, however large, is sorted in one task and no text is shuffled.

Only built-in functions run. Rows: a null or empty text has no tokens and goes with any whole
epoch, or with a prefix that reaches its key. Null domain, language or source is a node of its
own. Rows with equal (or null) ids share their key, so all of them are in or all out. Other columns are kept as
they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crawlsift.llm.common import free_name, join_hot, ready
from crawlsift.session import broadcast_if_bounded, materialize

# Fixed values.
WORD = r"[^\x20\x09-\x0D]+"
#: Hash buckets are narrowed down so many times, by so many hex digits each.
LEVELS = 3
LEVEL_HEX = 2
KEY_HEX = 16
#: Buckets by capacity over weight into which the children of one node are cut.
SPLITS = 256
_NULL = "\u0002"
_SEPARATOR = "\u0001"


@dataclass
class Mixture:
    """Target weights by node name; nodes not named get ``other``. Zero means never."""

    domains: dict[str, float] = field(default_factory=dict)
    languages: dict[str, float] = field(default_factory=dict)
    sources: dict[str, float] = field(default_factory=dict)
    other: float = 1.0
    #: Tokens to take, as a share of all tokens there are.
    share: float = 1.0
    #: A document is taken at most so many times.
    max_epochs: int = 4
    seed: int = 0


def count_tokens(text: Column) -> Column:
    """Words of a text: runs without ASCII white space."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def order_key(epoch: Column, doc_id: Column, seed: int) -> Column:
    """Position of a document in an epoch: a seeded hash in hex, so it sorts as text."""
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name)), 1, KEY_HEX)


def _draw(key: Column) -> Column:
    """A number from 0 to 2**32 - 1 for the document in which a budget runs out."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("draw:"), key)), 1, 8), 16, 10).cast("double")


def _weight(column: str, weights: dict[str, float], other: float) -> Column:
    out = F.lit(float(other))
    for name, weight in weights.items():
        out = F.when(F.col(column).eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(out)
    return out


def _leaf(domain: Column, lang: Column, source: Column) -> Column:
    return F.concat_ws(
        _SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(_NULL)) for c in (domain, lang, source)]
    )


def _beside(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table`` for equal ``keys``; null keys are equal too."""
    renamed = table.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(renamed, same, "inner").drop(*[f"_k_{k}" for k in keys])


def _share_out(nodes: DataFrame, parents: list[str], weight: str, capacity: str, budget: str, out: str) -> DataFrame:
    """Split each parent's ``budget`` by weight, never above a child's capacity.

    With children ordered by capacity over weight, ``(budget - capacity before) / weight from
    here on`` rises up to the first child that is not used up and never rises again: its peak is
    the level of all such. A family is not ordered in one task: its quantiles cut it into ``SPLITS`` buckets, whose
    sums tell between which two bucket starts the peak lies, and only the distinct ratios of the
    two buckets there are ordered.
    """
    ratio = F.col(capacity) / F.nullif(F.col(weight), F.lit(0.0))
    nodes = materialize(nodes.withColumn("_ratio", ratio), "family")
    weighty = nodes.where("_ratio IS NOT NULL")
    cuts = F.array(*[F.lit(i / SPLITS) for i in range(1, SPLITS)])
    bounds = weighty.groupBy(*parents).agg(F.percentile_approx("_ratio", cuts, SPLITS * 8).alias("_bounds"))
    bucket = F.size(F.filter("_bounds", lambda x: x < F.col("_ratio")))
    groups = (
        _beside(weighty, bounds, parents)
        .groupBy(*parents, budget, bucket.alias("_bucket"), "_ratio")
        .agg(F.sum(capacity).alias("_cap"), F.sum(weight).alias("_heft"))
    )
    groups = materialize(groups, "ratios")
    sums = groups.groupBy(*parents, budget, "_bucket").agg(F.sum("_cap").alias("_cap"), F.sum("_heft").alias("_heft"))
    ordered = W.partitionBy(*parents).orderBy("_bucket")
    starts = sums.select(
        *parents,
        budget,
        "_bucket",
        F.lag("_bucket").over(ordered).alias("_earlier"),
        F.coalesce(F.sum("_cap").over(ordered.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)).alias("_before"),
        F.sum("_heft").over(ordered.rowsBetween(0, W.unboundedFollowing)).alias("_rest"),
    )
    starts = materialize(starts, "starts")
    first = (F.col(budget) - F.col("_before")) / F.col("_rest")
    peak = starts.groupBy(*parents).agg(F.max_by(F.array("_bucket", "_earlier"), first).alias("_near"))
    near = _beside(starts, peak, parents).where(F.array_contains("_near", F.col("_bucket")))
    inside = W.partitionBy(*parents, "_bucket").orderBy("_ratio").rowsBetween(W.unboundedPreceding, -1)

    def passed(column: str) -> Column:
        return F.coalesce(F.sum(column).over(inside), F.lit(0.0))

    level = (F.col(budget) - F.col("_before") - passed("_cap")) / (F.col("_rest") - passed("_heft"))
    levels = (
        _beside(groups, near.select(*parents, "_bucket", "_before", "_rest"), [*parents, "_bucket"])
        .select(*parents, level.alias("_level"))
        .groupBy(*parents)
        .agg(F.max("_level").alias("_level"))
    )
    renamed = levels.withColumnsRenamed({k: f"_k_{k}" for k in parents})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in parents]
    return (
        nodes.join(renamed, same, "left")
        .withColumn(out, F.coalesce(F.least(F.col(capacity), F.col(weight) * F.col("_level")), F.lit(0.0)))
        .drop("_level", "_ratio", *[f"_k_{k}" for k in parents])
    )


def leaf_budgets(leaves: DataFrame, mix: Mixture) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with the budget of each leaf."""
    leaves = materialize(leaves, "leaves")
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * float(mix.share)
    weighed = leaves.select(
        "*",
        _weight("domain", mix.domains, mix.other).alias("w1"),
        _weight("lang", mix.languages, mix.other).alias("w2"),
        _weight("source", mix.sources, mix.other).alias("w3"),
        F.lit(0).alias("root"),
    ).withColumn(
        "capacity",
        F.when((F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0), F.col("tokens") * float(mix.max_epochs))
        .otherwise(0.0),
    )
    weighed = weighed.withColumn("b0", F.lit(total))
    langs = weighed.groupBy("root", "b0", "domain", "w1", "lang", "w2").agg(F.sum("capacity").alias("capacity"))
    domains = langs.groupBy("root", "b0", "domain", "w1").agg(F.sum("capacity").alias("capacity"))
    domains = _share_out(domains, ["root"], "w1", "capacity", "b0", "b1").select("domain", "b1")
    langs = _share_out(_beside(langs, domains, ["domain"]), ["domain"], "w2", "capacity", "b1", "b2")
    leaves = _beside(weighed, langs.select("domain", "lang", "b2"), ["domain", "lang"])
    shared = _share_out(leaves, ["domain", "lang"], "w3", "capacity", "b2", "b3")
    return shared.withColumn("budget", F.floor("b3").cast("long")).select(
        "leaf", "domain", "lang", "source", "docs", "tokens", "budget"
    )


def _inside(rows: DataFrame, border: DataFrame | None, depth: int) -> DataFrame:
    """Rows of each leaf's border bucket, whose names have ``depth`` hex digits."""
    if border is None:
        return rows.withColumn("before", F.lit(0).cast("long"))
    return rows.withColumn("bucket", F.substring("key", 1, depth)).join(border, ["leaf", "bucket"])


def _border(inside: DataFrame, depth: int) -> DataFrame:
    """``(leaf, bucket, before)``: the bucket in which each leaf's budget runs out, and the tokens
    before it. A leaf has no more than ``16 ** LEVEL_HEX`` buckets here."""
    bucket = F.substring("key", 1, depth).alias("bucket")
    sums = inside.groupBy("leaf", bucket, "rest", "before").agg(F.sum("tokens").alias("tokens"))
    ordered = W.partitionBy("leaf").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    return (
        sums.withColumn("reach", F.col("before") + F.sum("tokens").over(ordered))
        .where("reach > rest")
        .groupBy("leaf")
        .agg(F.min(F.struct("bucket", (F.col("reach") - F.col("tokens")).alias("before"))).alias("at"))
        .select("leaf", F.col("at.bucket").alias("bucket"), F.col("at.before").alias("before"))
    )


def leaf_plan(sized: DataFrame, mix: Mixture) -> DataFrame:
    """One row per leaf: budget, whole epochs, and the cut key of the epoch after them.

    ``sized`` has doc_id, domain, lang, source, leaf and tokens per document. A cut key of ''
    takes nothing from the last epoch.
    """
    leaves = sized.groupBy("leaf", "domain", "lang", "source").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens")
    )
    budgets = leaf_budgets(leaves, mix)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0))
    budgets = budgets.withColumn("whole", whole.cast("int")).withColumn(
        "rest", F.col("budget") - F.col("whole") * F.col("tokens")
    )
    budgets = materialize(budgets, "budgets")
    open_leaves = budgets.where("rest > 0").select("leaf", "docs", "whole", "rest")
    rows = join_hot(sized, open_leaves, "leaf", "docs", sized.count(), F.col("doc_id")).where("rest > 0")
    rows = rows.withColumn("key", order_key(F.col("whole"), F.col("doc_id"), mix.seed))
    rows = materialize(rows.select("leaf", "tokens", "rest", "key"), "keys")
    border = None
    for depth in range(LEVEL_HEX, LEVELS * LEVEL_HEX + 1, LEVEL_HEX):
        border = materialize(_border(_inside(rows, border, depth - LEVEL_HEX), depth), "border")
    inside = _inside(rows, border, LEVELS * LEVEL_HEX)
    by_key = W.partitionBy("leaf").orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow)
    reached = inside.withColumn("reach", F.col("before") + F.sum("tokens").over(by_key)).groupBy("leaf", "key", "rest").agg(
        F.max("reach").alias("reach"), F.sum("tokens").alias("tokens")
    )
    over = F.col("reach") > F.col("rest")
    last = reached.groupBy("leaf").agg(
        F.max(F.when(~over, F.col("key"))).alias("last"),
        F.min(F.when(over, F.struct("key", "tokens", (F.col("rest") - F.col("reach") + F.col("tokens")).alias("left")))).alias("next"),
    )
    drawn = _draw(F.col("next.key")) * F.col("next.tokens").cast("double") < F.col("next.left").cast("double") * F.lit(4294967296.0)
    cuts = border.join(last, "leaf", "left").select(
        "leaf",
        # Every key of an earlier bucket sorts before the bare name of the border bucket.
        F.when(drawn, F.col("next.key")).otherwise(F.coalesce("last", "bucket")).alias("cut"),
    )
    return budgets.join(cuts, "leaf", "left").select(
        "leaf", "domain", "lang", "source", "docs", "tokens", "budget", "whole", F.coalesce("cut", F.lit("")).alias("cut")
    )


def mix_epochs(
    docs: DataFrame,
    mix: Mixture,
    domain: Column,
    lang: Column,
    source: Column,
    doc_id: Column,
    text: Column,
    epochs_col: str = "epochs",
) -> DataFrame:
    """``docs`` with the number of times each document is taken, zero included."""
    ready(docs.sparkSession)
    sized = docs.select(
        doc_id.alias("doc_id"),
        domain.cast("string").alias("domain"),
        lang.cast("string").alias("lang"),
        source.cast("string").alias("source"),
        _leaf(domain, lang, source).alias("leaf"),
        count_tokens(text).alias("tokens"),
    )
    plan = materialize(leaf_plan(materialize(sized, "sized"), mix), "plan")
    leaf, whole, cut, n = (free_name(docs, c) for c in ("_leaf", "_whole", "_cut", "_docs"))
    n_leaves = plan.count()
    slim = plan.select(
        F.col("leaf").alias(leaf), F.col("whole").alias(whole), F.col("cut").alias(cut), F.col("docs").alias(n)
    )
    named = docs.withColumn(leaf, _leaf(domain, lang, source))
    small = broadcast_if_bounded(slim, n_leaves)
    if small is not slim:
        joined = named.join(small, leaf, "left")
    else:
        joined = join_hot(named, slim, leaf, n, docs.count(), doc_id)
    key = order_key(F.col(whole), doc_id, mix.seed)
    times = F.col(whole) + (key <= F.col(cut)).cast("int")
    return joined.withColumn(epochs_col, times).drop(leaf, whole, cut, n)


def mix_documents(docs: DataFrame, mix: Mixture, **columns: Column) -> DataFrame:
    """``docs`` as the mixture takes them: a document comes once per epoch that holds it."""
    times = free_name(docs, "_epochs")
    counted = mix_epochs(docs, mix, epochs_col=times, **columns).where(F.col(times) > 0)
    turn = free_name(counted, "_turn")
    return counted.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(times, turn)
