"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

The first scan only measures: normalised length and a hash of the first characters. Lengths that
occur once cannot have duplicates, nor can prefixes that occur once among equal lengths. What
survives is written into a bit filter of fixed size, and the second scan hashes the full content
of just the rows whose bit is set. A false hit of the filter costs one needless hash, nothing
else.

Only built-in functions run. Rows: a null text counts as empty; all empty texts are equal. Of
equal texts the one with the most code points stays, then the smallest id (null ids last), then
any one of rows that agree in both. Repeated rows are rows like any other. Any other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlsift.llm.common import join_hot, ready
from crawlsift.session import materialize

# Fixed values.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 64
#: 64-bit words of the bit filter; its broadcast holds no more rows than this, whatever the data.
FILTER_WORDS = 65_536


def normalised(text: Column) -> Column:
    """Text without ASCII white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def _bit(words: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64("chars", "prefix"), F.lit(words * 64))
    return (at / 64).cast("int"), F.pmod(at, F.lit(64)).cast("int")


def surviving_keys(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(chars, prefix)`` pairs that more than one row shares."""
    text = normalised(F.col(text_col))
    keys = docs.select(
        F.length(text).alias("chars"), F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix")
    )
    keys = materialize(keys.groupBy("chars", "prefix").agg(F.count(F.lit(1)).alias("rows")), "keys")
    lengths = keys.groupBy("chars").agg(F.sum("rows").alias("same")).where("same > 1")
    return keys.join(lengths, "chars", "left_semi").where("rows > 1").select("chars", "prefix")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_all: bool = False,
    filter_words: int = FILTER_WORDS,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, digest)`` for every row of ``docs``.

    ``digest`` is the SHA-256 of the normalised text in lower-case hex. It is computed where
    refinement needs it, and null for rows known to be single, unless ``digest_all`` asks for it.
    """
    ready(docs.sparkSession)
    word, bit = _bit(filter_words)
    survivors = surviving_keys(docs, text_col).select(word.alias("word"), bit.alias("bit"))
    bits = survivors.groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")
    )
    measured = docs.select(
        F.col(id_col).alias("doc_id"),
        F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("code_points"),
        normalised(F.col(text_col)).alias("body"),
    ).select(
        "doc_id",
        "code_points",
        "body",
        F.length("body").alias("chars"),
        F.xxhash64(F.substring("body", 1, PREFIX_CHARS)).alias("prefix"),
    )
    flagged = measured.select(
        "doc_id", "code_points", "body", word.alias("word"), bit.alias("bit")
    ).join(F.broadcast(bits), "word", "left")
    survives = F.coalesce(F.expr("getbit(mask, bit)") == 1, F.lit(False))
    wanted = F.lit(True) if digest_all else survives
    rows = materialize(
        flagged.select(
            "doc_id",
            "code_points",
            survives.alias("survives"),
            F.when(wanted, F.sha2(F.col("body").cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    rivals = rows.where("survives")
    best = F.min(
        F.struct(
            (-F.col("code_points")).alias("size"),
            F.col("doc_id").isNull().alias("nameless"),
            F.col("doc_id").alias("doc_id"),
            F.col("row").alias("row"),
        )
    )
    groups = (
        rivals.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select(
            "digest",
            "group_size",
            F.col("best.doc_id").alias("keep_id"),
            F.col("best.row").alias("keep_row"),
        )
    )
    grouped = join_hot(rivals, groups, "digest", "group_size", rows.count(), F.col("row"))
    return grouped.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"
    ).union(
        rows.where("NOT survives").select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("long").alias("group_size"),
            F.lit(True).alias("kept"),
            "digest",
        )
    )
