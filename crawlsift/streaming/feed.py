"""Continuous runs: new archives as a stream of records, running totals of outcomes, archives that
have been read to their end."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from crawlsift.operators.outcome import FINISHED_ARCHIVES
from crawlsift.session import attach
from crawlsift.sinks.stats import stats_json
from crawlsift.sources.paths import open_fs, plain_path
from crawlsift.sources.warc import (
    DEFAULT_CAP,
    DEFAULT_SPLIT,
    RANGE_SCHEMA,
    read_range,
    record_schema,
    to_batches,
)

#: Tasks that the byte ranges of a batch are dealt to.
STREAM_TASKS_PER_CORE = 2
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def stream_warc(
    spark: SparkSession,
    root: str,
    max_files_per_trigger: int = 100,
    max_content_length: int = DEFAULT_CAP,
    payload: list[str] | None = None,
    columns: list[str] | None = None,
    split_bytes: int = DEFAULT_SPLIT,
    log: str | None = None,
    max_bytes_per_trigger: int | None = None,
    marks: bool = False,
) -> DataFrame:
    """Stream of archive records from archives that appear below ``root``.

    Without ``log``, Spark's file source finds and remembers the archives (each is read exactly
    once, whatever its name), and at most ``max_files_per_trigger`` whole archives enter a batch.
    With ``log``, a shared folder that belongs to this query, batches are bounded by
    ``max_bytes_per_trigger`` and may end inside an archive, so one that is larger than a batch
    should be is read over several. Run such a stream at an interval and ``finish`` it: a run that
    takes what is available once takes one batch. Either way contents are streamed by the tasks,
    never loaded whole.

    ``marks`` adds the columns of ``RANGE_SCHEMA`` and a row after the records of each byte range.
    """
    attach(spark)
    schema = record_schema(columns, marks)
    cores = spark.sparkContext.defaultParallelism
    if log is not None:
        stream = (
            spark.readStream.format("warc")
            .option("path", root)
            .option("log", log)
            .option("maxContentLength", max_content_length)
            .option("payload", "all" if payload is None else ",".join(payload))
            .option("splitBytes", split_bytes)
            .option("leastPartitions", cores)
            .option("marks", marks)
        )
        if columns is not None:
            stream = stream.option("columns", ",".join(columns))
        if max_bytes_per_trigger is not None:
            stream = stream.option("maxBytesPerTrigger", max_bytes_per_trigger)
        return stream.load()
    if max_bytes_per_trigger is not None:
        raise ValueError("max_bytes_per_trigger needs a log")
    wanted = None if payload is None else tuple(payload)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("path", "start", "end", "length")
            for path, start, end, size in zip(*(batch.column(n).to_pylist() for n in names)):
                rows = read_range(path, start, end, size, max_content_length, wanted, mark=marks)
                yield from to_batches(rows, schema)

    archives = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.warc.gz")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(root)
        .select(plain_path(F.col("path")).alias("path"), "length")
    )
    # The ranges of a large archive go to different tasks; only their bounds are shuffled.
    count = F.greatest(F.lit(1), F.round(F.col("length") / split_bytes)).cast("long")
    ranges = (
        archives.withColumn("count", count)
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
        .select(
            "path",
            "length",
            (F.col("i") * split_bytes).alias("start"),
            F.when(F.col("i") == F.col("count") - 1, F.col("length"))
            .otherwise((F.col("i") + 1) * split_bytes)
            .alias("end"),
        )
    )
    # With its number given, adaptive execution does not pack the small list into one task.
    return ranges.repartition(STREAM_TASKS_PER_CORE * cores, "path", "start").mapInArrow(read, schema)


@contextmanager
def small_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in a few partitions a core.

    For state of a row per counter or archive: every partition costs each batch several small files.
    A query keeps the number it was started with first, as its checkpoint says.
    """
    key = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(min(int(usual), STREAM_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query that runs at an interval has read all there is, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def finished_archives_of(rows: DataFrame) -> DataFrame:
    """``(archive, n_ranges, n_records, n_errors)``: one row when an archive has been read to its
    end, in whatever order and however many batches its byte ranges come.

    ``rows`` is a stream with ``marks``. State is kept for archives that have begun only, four
    numbers each; rows of records do not reach it.
    """

    def add(key: tuple, ranges: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        read, n, records, errors = state.get if state.exists else (0, 0, 0, 0)
        length = 0
        for part in ranges:
            read += int((part["range_end"] - part["range_start"]).sum())
            n += len(part)
            records += int(part["range_records"].sum())
            errors += int(part["range_errors"].sum())
            length = int(part["archive_length"].iloc[0])
        if read < length:
            state.update((read, n, records, errors))
            return
        if state.exists:
            state.remove()
        yield pd.DataFrame({"archive": [key[0]], "n_ranges": [n], "n_records": [records], "n_errors": [errors]})

    marks = rows.filter(F.col("range_end").isNotNull()).select("archive", *RANGE_SCHEMA.names)
    return marks.groupBy("archive").applyInPandasWithState(
        add,
        "archive string, n_ranges long, n_records long, n_errors long",
        "read long, n_ranges long, n_records long, n_errors long",
        "append",
        GroupStateTimeout.NoTimeout,
    )


def funnel_snapshots(
    rows: DataFrame,
    checkpoint: str,
    outcome: str = "outcome",
    totals: dict[str, Column] | None = None,
    json_file: str | None = None,
    table_dir: str | None = None,
    console: bool = False,
    interval: str | None = None,
    finished: bool = False,
) -> StreamingQuery:
    """Running totals of outcomes, refreshed every ``interval`` (or once over what is there).

    ``totals`` names further counters and what a row adds to each, such as its regex matches.
    ``finished`` also counts the archives read to their end without an error; ``rows`` then come
    from a stream with ``marks``. State is one row per counter, and per archive with ``finished``,
    as an archive may go on in a later batch. Each snapshot replaces the JSON file and the Parquet table
    of the one before, and may be printed.
    """
    nothing = F.lit(0).cast("long")

    def entry(name: Column, n: Column, archive=F.lit(None).cast("string"), errors=nothing, length=nothing) -> Column:
        parts = {"counter": name, "archive": archive, "n": n, "errors": errors, "length": length}
        return F.struct(*[value.alias(key) for key, value in parts.items()])

    entries = [entry(F.col(outcome), F.lit(1).cast("long"))]
    for name, weight in (totals or {}).items():
        entries.append(entry(F.lit(name), F.coalesce(weight.cast("long"), nothing)))
    added = F.array(*entries)
    if finished:
        read = F.col("range_end") - F.col("range_start")
        mark = entry(F.lit(FINISHED_ARCHIVES), read, F.col("archive"), F.col("range_errors"), F.col("archive_length"))
        added = F.when(F.col("range_end").isNotNull(), F.array(mark)).otherwise(added)
    counts = (
        rows.select(F.inline(added))
        .groupBy("counter", "archive")
        .agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"), F.max("length").alias("length"))
    )
    whole = (F.col("n") == F.col("length")) & (F.col("errors") == 0)

    def publish(snapshot: DataFrame, _: int) -> None:
        n = F.when(F.col("archive").isNull(), F.col("n")).otherwise(whole.cast("long"))
        snapshot = snapshot.groupBy("counter").agg(F.sum(n).alias("n"))
        snapshot = snapshot.coalesce(1).persist()
        try:
            if console:
                snapshot.show(100, truncate=False)
            if json_file is not None:
                line = stats_json(snapshot).first()["value"]  # one row: the counters
                fs, path = open_fs(json_file)
                fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(path) as stream:
                    stream.write(line.encode("utf-8"))
            if table_dir is not None:
                snapshot.write.mode("overwrite").parquet(table_dir)
        finally:
            snapshot.unpersist()

    writer = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    with small_state(rows.sparkSession):
        if interval is None:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=interval).start()


def stream_dataset(
    rows: DataFrame, directory: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Append a stream of rows to a stored dataset, exactly once."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if interval is None:
        return writer.trigger(availableNow=True).start(directory)
    return writer.trigger(processingTime=interval).start(directory)
