"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.session import attach, release_memory

# Fixed values.
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_CHUNK_BYTES = 1 << 22
#: 64-bit words of a bit filter; its broadcast has no more rows than this, whatever the data.
FILTER_WORDS = 65_536
#: A key is hot when it holds more than this share of all rows; so at most 1 / share keys are.
HOT_SHARE = 1 / 500
#: A hot key's rows are dealt to this many shuffle keys.
HOT_SALTS = 64


def ready(spark: SparkSession) -> SparkSession:
    """Ship the package and bound Arrow batches by rows and bytes: texts may be very long."""
    return attach(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _as(values, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def frugal(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The same function of batches, which leaves no unused memory with its worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release_memory()

    return run


def map_arrow(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, list]], schema: str
) -> DataFrame:
    """``mapInArrow`` for a function of one batch that returns columns by name."""
    fields = T._parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(fields)
        for batch in batches:
            if batch.num_rows:
                columns = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [_as(columns[f.name], f.type) for f in target], schema=target
                )

    return df.mapInArrow(frugal(run), fields)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a text column, without decoding them."""
    wide = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    return wide.to_pylist()


def word_chunks(data: bytes, size: int = _CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Words of ``data`` (runs without ASCII white space) in lists of bounded total size."""
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        blank = _BLANK.search(data, min(at + size, len(data)))
        end = blank.start() if blank else len(data)
        yield data[at:end].split()
        at = end


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def may_hold(rows: DataFrame, key: Column, members: DataFrame, member: Column, out: str) -> DataFrame:
    """``rows`` with a boolean ``out``: false only where ``key`` is certainly none of ``members``.

    The members go into a bit filter of fixed size, so rows that are none of them need no shuffle
    to be told apart. With very many members most rows may pass for one; callers look those up.
    """
    word, bit, mask = (free_name(rows, name) for name in ("_word", "_bit", "_mask"))

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_WORDS * 64))

    ones = members.select(place(member).alias("at")).select(
        (F.col("at") / 64).cast("int").alias(word), F.pmod("at", F.lit(64)).cast("int").alias("bit")
    )
    masks = ones.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias(mask))
    placed = rows.withColumn(word, (place(key) / 64).cast("int")).withColumn(
        bit, F.pmod(place(key), F.lit(64)).cast("int")
    )
    joined = placed.join(F.broadcast(masks), word, "left")
    hit = F.coalesce(F.getbit(mask, F.col(bit)) == 1, F.lit(False))
    return joined.withColumn(out, hit & key.isNotNull()).drop(word, bit, mask)


def join_hot(
    rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, spread: Column
) -> DataFrame:
    """Left-join ``rows`` to ``groups`` (one row per ``key``; null keys match nothing).

    ``size`` says how many of the ``total`` rows a group has. Groups above ``HOT_SHARE`` of all
    rows, of which there are at most ``1 / HOT_SHARE``, are dealt to ``HOT_SALTS`` shuffle keys
    by ``spread``; their keys are the only broadcast.
    """
    limit = int(total * HOT_SHARE) + 1
    mark, salt = free_name(rows, "_hot_key"), free_name(rows, "_salt")
    hot = groups.where(F.col(size) > limit).select(F.col(key).alias(mark))
    dealt = (
        rows.join(F.broadcast(hot), F.col(key) == F.col(mark), "left")
        .withColumn(
            salt,
            F.when(F.col(mark).isNotNull(), F.pmod(F.xxhash64(spread), F.lit(HOT_SALTS)).cast("int"))
            .otherwise(F.lit(0)),
        )
        .drop(mark)
    )
    all_salts = F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))
    copies = groups.withColumn(
        salt, F.explode(F.when(F.col(size) > limit, all_salts).otherwise(F.array(F.lit(0))))
    )
    return dealt.join(copies, [key, salt], "left").drop(salt)
