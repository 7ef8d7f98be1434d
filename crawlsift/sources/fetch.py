"""Random access: references to records become records."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.sources.paths import open_fs
from crawlsift.sources.warc import (
    DEFAULT_CAP,
    RECORD_SCHEMA,
    iter_records,
    to_batches,
)

#: References this close together in one archive are read by one task, in order.
RANGE_BYTES = 64 * 1024 * 1024
_SMALL_READ = 1 << 16
#: Bytes that take as long to read as another request, and the most that one read fetches.
GAP_BYTES = 1 << 18
READ_BYTES = 8 << 20

FETCHED_COLUMNS = [
    "has_headers",
    "has_http_headers",
    "warc_type",
    "target_uri",
    "content_type",
    "content_length",
    "payload",
    "error",
]


class _Ahead:
    """An archive of which a stretch has been read in one go; other places are read as asked."""

    def __init__(self, handle):
        self.handle = handle
        self.start, self.data, self.at = 0, b"", 0

    def stretch(self, start: int, end: int) -> None:
        self.handle.seek(start)
        self.start, self.data = start, self.handle.read(end - start)

    def seek(self, at: int, whence: int = 0) -> int:
        self.at = at if whence == 0 else self.handle.size() + at
        return self.at

    def read(self, size: int) -> bytes:
        place = self.at - self.start
        if 0 <= place < len(self.data):
            out = self.data[place : place + size]
        else:
            self.handle.seek(self.at)
            out = self.handle.read(size)
        self.at += len(out)
        return out


def plan_reads(refs: list[dict]) -> Iterator[list[dict]]:
    """Sorted references in groups that one read serves.

    A reference joins the group before it in its archive when the bytes between them cost less than
    another request (``GAP_BYTES``) and the read stays below ``READ_BYTES``.
    """
    held: list[dict] = []
    for ref in refs:
        if held:
            first, last = held[0], held[-1]
            known = ref["offset"] is not None and last["offset"] is not None
            near = known and ref["offset"] - last["offset"] <= GAP_BYTES and ref["offset"] - first["offset"] <= READ_BYTES
            if ref["warc_path"] != first["warc_path"] or not near:
                yield held
                held = []
        held.append(ref)
    if held:
        yield held


def _ranged_reader(cap: int, schema: T.StructType, keep: list[str]):
    carried = ["warc_path", "offset", *keep]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        path, handle, ahead = None, None, None
        for batch in batches:
            for group in plan_reads(batch.select(carried).to_pylist()):
                if group[0]["warc_path"] != path:
                    if handle is not None:
                        handle.close()
                    path, handle = group[0]["warc_path"], None
                    try:
                        fs, inner = open_fs(path)
                        handle = fs.open_input_file(inner)
                        ahead = _Ahead(handle)
                    except FileNotFoundError:  # any other failure may pass: the task is retried
                        handle = None
                if handle is not None and group[0]["offset"] is not None:
                    ahead.stretch(group[0]["offset"], group[-1]["offset"] + _SMALL_READ)
                at, row = None, {"error": "no record at this offset"}
                for ref in group:
                    if handle is None:
                        row = {"error": "archive cannot be opened"}
                    elif ref["offset"] is not None and ref["offset"] != at:
                        at = ref["offset"]
                        found = iter_records(ahead, at, at + 1, cap, read_bytes=_SMALL_READ)
                        row = next(found, {"error": "no record at this offset"})
                    yield {**row, **ref}
        if handle is not None:
            handle.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return to_batches(rows(batches), schema)

    return read


def _scanning_reader(cap: int, schema: T.StructType, keep: list[str], folders: tuple[str, ...]):
    """Reader that merges sorted references with one pass over the stretch that holds them."""
    carried = ["warc_path", "offset", *keep]

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[dict]]]:
        held: list[dict] = []
        for batch in batches:
            for ref in batch.select(carried).to_pylist():
                first = held[0] if held else ref
                far = ref["offset"] is None or first["offset"] is None
                if ref["warc_path"] != first["warc_path"] or far or ref["offset"] - first["offset"] > RANGE_BYTES:
                    yield held[0]["warc_path"], held
                    held = []
                held.append(ref)
        if held:
            yield held[0]["warc_path"], held

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for path, refs in stretches(batches):
            found, at, row = iter(()), None, None
            if path is not None and path.startswith(folders) and refs[0]["offset"] is not None:
                fs, inner = open_fs(path)
                with suppress(FileNotFoundError), fs.open_input_file(inner) as handle:
                    found = iter_records(handle, refs[0]["offset"], refs[-1]["offset"] + 1, cap)
                    for ref in refs:
                        while at is None or at < ref["offset"]:
                            row = next(found, None)
                            if row is None:
                                break
                            at = row["record_offset"]
                        hit = row is not None and at == ref["offset"]
                        yield {**(row if hit else {"error": "no record at this offset"}), **ref}
                        if row is None:
                            at = ref["offset"]
                    continue
            for ref in refs:
                yield {"error": "archive cannot be opened", **ref}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return to_batches(rows(batches), schema)

    return read


def fetch_records(
    refs: DataFrame,
    max_content_length: int = DEFAULT_CAP,
    mode: str = "range",
    roots: str | list[str] | None = None,
    keep: list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """The record behind every distinct ``(warc_path, offset)`` of ``refs``.

    References are made distinct first: an image that a third of all pages show is read once.
    Callers whose references are distinct already name columns to ``keep``: these ride along,
    one row per reference, so the bytes need not be joined back.

    ``mode="range"`` reads records at their offsets; neighbours are read in one go. Work is spread by archive *and*
    offset range, so references that crowd in one archive still use many tasks, and each task
    moves forward through its range. The number of ``tasks`` is fixed: references are tiny
    and would otherwise be packed by their size into too few tasks for the reads they cause.
    ``mode="scan"`` reads archives below ``roots`` from the first to the last wanted record of
    each range in one go, which pays when most records are wanted. Only references are shuffled
    in either mode, never payloads. A reference without a readable record keeps a row with
    ``error``; a storage failure other than a missing file fails the task, so that it is retried.
    """
    spark = refs.sparkSession
    keep = list(keep or [])
    keys = refs.select("warc_path", "offset", *keep)
    wanted = keys if keep else keys.distinct()
    record = T.StructType([f for f in RECORD_SCHEMA if f.name in FETCHED_COLUMNS])
    schema = T.StructType([*wanted.schema.fields, *record.fields])
    n = tasks or max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    ordered = (
        wanted.withColumn("_range", F.floor(F.col("offset") / RANGE_BYTES))
        .repartition(n, "warc_path", "_range")
        .sortWithinPartitions("warc_path", "offset")
        .drop("_range")
    )
    if mode == "range":
        return ordered.mapInArrow(_ranged_reader(max_content_length, schema, keep), schema)
    if mode == "scan":
        if roots is None:
            raise ValueError("mode='scan' needs the roots to read")
        folders = tuple(f"{r.rstrip('/')}/" for r in ([roots] if isinstance(roots, str) else roots))
        return ordered.mapInArrow(_scanning_reader(max_content_length, schema, keep, folders), schema)
    raise ValueError(f"unknown mode {mode!r}: use 'range' or 'scan'")
