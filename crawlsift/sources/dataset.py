"""Stored datasets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.sources.listing import list_archives
from crawlsift.sources.paths import open_fs

_READ_ROWS = 8192


def read_dataset(
    spark: SparkSession, directory: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Read an exported dataset; a damaged or incomplete shard is skipped, the rest is kept.

    Give ``schema`` for a directory that may hold damaged shards: without it the schema is
    taken from a shard footer, which must then be readable. ``dataset_shards`` tells what of which
    shard is read.
    """
    reader = spark.read.option("ignoreCorruptFiles", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(directory)


def dataset_shards(spark: SparkSession, directory: str, deep: bool = False) -> DataFrame:
    """``(shard, bytes, rows, sound, problem)`` of every shard below ``directory``.

    A shard is sound when its footer can be read and the pages it points to lie inside the file;
    ``rows`` is then the footer's number, else null. With ``deep`` all pages are read, too, which
    finds damage inside them: ``rows`` is then how many can be read from the start, and a shard
    that yields fewer than its footer says is not sound. Every shard is looked at by one task; a
    passing failure of the store fails the task, which is retried.
    """
    listed = list_archives(spark, directory, ".parquet").select(F.col("path").alias("shard"), F.col("length").alias("bytes"))
    cores = spark.sparkContext.defaultParallelism
    schema = "shard string, bytes long, rows long, sound boolean, problem string"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, problem = _look_at(shard, deep)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard]),
                        pa.array([size], pa.int64()),
                        pa.array([rows], pa.int64()),
                        pa.array([problem is None]),
                        pa.array([problem], pa.string()),
                    ],
                    names=["shard", "bytes", "rows", "sound", "problem"],
                )

    # With its number given, adaptive execution does not pack the list into one task.
    return listed.repartition(4 * cores).mapInArrow(look, schema)


def _look_at(path: str, deep: bool) -> tuple[int | None, str | None]:
    """Rows of a shard and what is wrong with it."""
    fs, inner = open_fs(path)
    with fs.open_input_file(inner) as handle:
        try:
            shard = pq.ParquetFile(handle)
        except pa.ArrowInvalid as wrong:
            return None, f"footer: {wrong}"
        meta = shard.metadata
        size = handle.size()
        for group in range(meta.num_row_groups):
            for column in range(meta.num_columns):
                chunk = meta.row_group(group).column(column)
                starts = [at for at in (chunk.dictionary_page_offset, chunk.data_page_offset) if at]
                if min(starts, default=0) + chunk.total_compressed_size > size:
                    return None, "footer: pages lie beyond the end of the file"
        if not deep:
            return meta.num_rows, None
        rows = 0
        try:
            for batch in shard.iter_batches(_READ_ROWS):
                batch.validate(full=True)
                rows += batch.num_rows
        except (pa.ArrowException, OSError, ValueError) as wrong:
            return rows, f"pages: {type(wrong).__name__}: {wrong}"
        return rows, None if rows == meta.num_rows else f"pages: {rows} rows of {meta.num_rows}"


def write_dataset(df: DataFrame, directory: str, mode: str = "errorifexists") -> None:
    """Write scored rows as a sharded dataset."""
    df.write.mode(mode).parquet(directory)
