"""Counters and console reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stats_json(counts: DataFrame) -> DataFrame:
    """``(value)``: one JSON object from ``(counter, n)`` rows, names in order.

    There is one row per counter name, some twenty at most.
    """
    entries = F.sort_array(F.collect_list(F.struct("counter", "n")))
    return counts.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def write_stats(counts: DataFrame, directory: str, mode: str = "overwrite") -> None:
    """Write the counters as one JSON text file."""
    stats_json(counts).coalesce(1).write.mode(mode).text(directory)


def report_rows(df: DataFrame, *urls: str) -> DataFrame:
    """What a report shows of each positive: its URLs and its score."""
    return df.select(*(urls or ("url",)), "prediction")


def report(df: DataFrame, *urls: str, n: int | None = None) -> None:
    """Print every positive, or the first ``n``; rows come to the driver one partition at a time."""
    rows = report_rows(df, *urls)
    for row in (rows if n is None else rows.limit(n)).toLocalIterator():
        print(*row, sep="\t")


def report_stream(
    df: DataFrame, *urls: str, checkpoint: str, n: int | None = None
) -> StreamingQuery:
    """Print positives of a stream as they come; with ``n``, no more than the first of a batch."""
    return (
        report_rows(df, *urls)
        .writeStream.foreachBatch(lambda batch, _: report(batch, *urls, n=n))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
