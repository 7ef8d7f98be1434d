"""Vocabulary and token ids."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.session import materialize

#: Largest vocabulary shipped to the workers (a subword vocabulary holds about 30,000 entries).
MAX_VOCABULARY = 200_000
#: Id of a token outside the vocabulary; ids of the vocabulary start at 1.
UNKNOWN = 0

TOKENS = T.StructType(
    [
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType())),
    ]
)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def build_vocabulary(df: DataFrame, text: str, max_size: int = 30_000) -> DataFrame:
    """``(token, n, id)`` of the most frequent words; ties in token order, ids from 1.

    Counting combines on the map side. The ``max_size``-th count is read off a histogram of
    counts; words below it never leave their partitions, so the task that numbers the rest gets
    little more than ``max_size`` rows (only words that tie at the cut come on top).
    """
    if max_size > MAX_VOCABULARY:
        raise ValueError(f"vocabulary of {max_size} exceeds the limit of {MAX_VOCABULARY}")
    counts = (
        df.select(F.explode(words(F.col(text))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialize(counts, "word-counts")
    more = W.orderBy(F.desc("n")).rowsBetween(W.unboundedPreceding, -1)
    histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    reached = histogram.withColumn("before", F.coalesce(F.sum("words").over(more), F.lit(0)))
    least = reached.where(F.col("before") < max_size).agg(F.min("n")).first()[0]
    top = counts.where(F.col("n") >= (least or 0)).orderBy(F.desc("n"), "token").limit(max_size)
    ranked = top.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "token"))).alias("rows")
    )
    return ranked.select(F.posexplode("rows").alias("pos", "row")).select(
        F.col("row.token").alias("token"),
        (-F.col("row.m")).alias("n"),
        (F.col("pos") + 1).alias("id"),
    )


def tokenizer(vocabulary: DataFrame):
    """Function ``text column -> struct<input_ids, attention_mask>`` for a vocabulary.

    The vocabulary is bounded by ``MAX_VOCABULARY``, so it travels with the function; texts
    are looked up where they lie, without a shuffle.
    """
    rows = vocabulary.select("token", "id").limit(MAX_VOCABULARY + 1).collect()
    if len(rows) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary exceeds the limit of {MAX_VOCABULARY} tokens")
    table = sorted((r["id"], r["token"]) for r in rows)
    names = [token for _, token in table]
    numbers = [number for number, _ in table]

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(tokens: pa.Array) -> pa.Array:
        flat = tokens.flatten()
        position = pc.index_in(flat, value_set=pa.array(names, flat.type))
        found = pc.take(pa.array(numbers, pa.int32()), position)
        values = pc.fill_null(found, pa.scalar(UNKNOWN, pa.int32()))
        sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
        out = pa.ListArray.from_arrays(offsets, values, mask=tokens.is_null())
        return out

    def tokenize(text: Column) -> Column:
        input_ids = ids(words(text))
        return F.struct(
            input_ids.alias("input_ids"),
            F.transform(input_ids, lambda _: F.lit(1)).alias("attention_mask"),
        )

    return tokenize
