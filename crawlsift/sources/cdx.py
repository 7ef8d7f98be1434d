"""Index files: where the capture of a URL lies."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.session import broadcast_if_bounded, materialize
from crawlsift.sources.listing import list_archives
from crawlsift.sources.paths import base_name, open_fs, parent

# File suffix, first token of the header, and column letters of an index.
INDEX_SUFFIX = ".cdx.gz"
HEADER_TOKEN = "CDX"
URL, ARCHIVE, OFFSET, MIME = "a", "g", "V", "m"
REVISIT = "warc/revisit"

#: 64-bit words of the bit filter that an index gets of the URLs wanted from its item.
FILTER_WORDS = 65_536
_FILTER_BITS = FILTER_WORDS * 64
_READ_BYTES = 1 << 20
_PIECE_BYTES = 8 << 20
_OFFSET = re.compile("[0-9]{1,18}")

_LINE_FIELDS = [
    ("line_no", pa.int64()),
    ("url", pa.string()),
    ("mime", pa.string()),
    ("warc_path", pa.string()),
    ("offset", pa.int64()),
    ("malformed", pa.bool_()),
]
_FILE_FIELDS = [
    ("header", pa.string()),
    ("letters", pa.list_(pa.string())),
    ("intact", pa.bool_()),
    ("n_malformed", pa.int64()),
]
_SCAN_SCHEMA = (
    "path string, item_dir string, line_no long, url string, mime string, warc_path string, "
    "offset long, malformed boolean, header string, letters array<string>, intact boolean, "
    "n_malformed long"
)


@dataclass
class Index:
    """What one pass over all indexes found: a row per index file, a row per line asked for."""

    files: DataFrame
    lines: DataFrame


def _inflated(stream) -> Iterator[bytes | None]:
    """Inflated text in pieces of bounded size, then None if the file is cut short or damaged.

    Only what the file holds counts as damage: a storage failure fails the task, to be retried.
    """
    inflater, complete = zlib.decompressobj(31), False
    while data := stream.read(_READ_BYTES):
        more = True
        while more:
            try:
                text = inflater.decompress(data, _PIECE_BYTES)
            except zlib.error:
                yield None
                return
            if text:
                yield text
            complete = inflater.eof
            if complete:
                data = inflater.unused_data
                more = bool(data)
                if more:
                    inflater = zlib.decompressobj(31)
            else:
                data = inflater.unconsumed_tail
                more = bool(data) or len(text) == _PIECE_BYTES
    if not complete:
        yield None


def _places(letters: list[str]) -> list[int] | None:
    """Where a line has URL, archive, offset and type; None if the header does not name them all."""
    if letters[:1] != [HEADER_TOKEN] or any(x not in letters[1:] for x in (URL, ARCHIVE, OFFSET, MIME)):
        return None
    return [letters[1:].index(x) for x in (URL, ARCHIVE, OFFSET, MIME)]


def _parsed(line: str, places: list[int], folder: str) -> tuple:
    """``(url, mime, warc_path, offset, malformed)`` of a line."""
    fields = line.split(" ")
    url, archive, offset, mime = (fields[p] if p < len(fields) else None for p in places)
    number = int(offset) if offset is not None and _OFFSET.fullmatch(offset) else None
    sound = mime is not None and (mime == REVISIT or None not in (url, archive, number))
    return url, mime, None if archive is None else f"{folder}/{archive}", number, not sound


def _column(name: str, kind: pa.DataType, values: list | None, n: int) -> pa.Array:
    return pa.nulls(n, kind) if values is None else pa.array(values, kind)


def _batch(path: str, item_dir: str, n: int, **values: list) -> pa.RecordBatch:
    fields = [*_LINE_FIELDS, *_FILE_FIELDS]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * n, pa.string()),
            pa.array([item_dir] * n, pa.string()),
            *[_column(name, kind, values.get(name), n) for name, kind in fields],
        ],
        names=["path", "item_dir", *[name for name, _ in fields]],
    )


def _read_index(path: str, item_dir: str, masks: dict[int, int] | None, lines: bool) -> Iterator[pa.RecordBatch]:
    """Lines of one index that may be wanted, and at last the row that tells how it is.

    The file is inflated once. Every line is looked at, also those that are not wanted: one that
    cannot be read spoils its index.
    """
    folder = item_dir.rpartition("/")[0]
    header, letters, places = None, [], None
    number = n_malformed = 0

    def take(raw: list[bytes]) -> Iterator[pa.RecordBatch]:
        nonlocal header, letters, places, number, n_malformed
        kept = []
        for data in raw:
            if header is None:
                header = data.decode("utf-8", "replace").strip()
                letters = header.split()
                places = _places(letters)
            text = data.rstrip(b"\r").decode("utf-8", "replace").strip(" ")
            if places is not None and text != header:
                row = _parsed(text, places, folder)
                n_malformed += row[4]
                if masks is None:
                    hit = lines
                else:
                    at = zlib.crc32((row[0] or "").encode("utf-8")) % _FILTER_BITS
                    hit = lines and masks.get(at >> 6, 0) >> (at & 63) & 1
                if hit:
                    kept.append((number, *row))
            number += 1
        if kept:
            columns = dict(zip([name for name, _ in _LINE_FIELDS], map(list, zip(*kept))))
            yield _batch(path, item_dir, len(kept), **columns)

    fs, inner = open_fs(path)
    intact, rest = True, b""
    with fs.open_input_stream(inner, compression=None) as stream:
        for piece in _inflated(stream):
            if piece is None:
                intact = False
                break
            *whole, rest = (rest + piece).split(b"\n")
            yield from take(whole)
    if rest:
        yield from take([rest])
    yield _batch(
        path, item_dir, 1, header=[header or ""], letters=[letters], intact=[intact], n_malformed=[n_malformed]
    )


def _reader(filtered: bool, lines: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                masks = None
                if filtered:
                    words = batch.column("words")[i].values
                    masks = {}
                    if words is not None:
                        masks = dict(zip(words.field("word").to_pylist(), words.field("mask").to_pylist()))
                path, item_dir = (batch.column(name)[i].as_py() for name in ("path", "item_dir"))
                yield from _read_index(path, item_dir, masks, lines)

    return read


def _filters(wanted: DataFrame) -> DataFrame:
    """``(item_dir, words)``: a bit filter of the URLs wanted from each item.

    Bits combine before the shuffle, and an item has no more than FILTER_WORDS words, however many
    URLs it is asked for: with tens of millions most lines pass, which is slower but no less right.
    """
    place = F.pmod(F.crc32(F.coalesce("url", F.lit("")).cast("binary")), F.lit(_FILTER_BITS))
    ones = wanted.select("item_dir", place.alias("at")).select(
        "item_dir", F.expr("at div 64").cast("int").alias("word"), (F.col("at") % 64).cast("int").alias("bit")
    )
    masks = ones.groupBy("item_dir", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    return masks.groupBy("item_dir").agg(F.collect_list(F.struct("word", "mask")).alias("words"))


def _scan(
    spark: SparkSession, roots: str | list[str], wanted: DataFrame | None = None, lines: bool = True
) -> DataFrame:
    """Rows of lines (``line_no`` is set) and of files. Each index is read by one task; the number
    of tasks is fixed, as the listing alone would be packed into few."""
    listed = list_archives(spark, roots, INDEX_SUFFIX).select(
        "path", parent(F.col("path")).alias("item_dir")
    )
    named = listed.filter(
        base_name(F.col("path")) == F.concat(base_name(F.col("item_dir")), F.lit(INDEX_SUFFIX))
    )
    if wanted is not None:
        named = named.join(_filters(wanted), "item_dir", "left").select("path", "item_dir", "words")
    n = max(
        spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    )
    return named.repartition(n, "path").mapInArrow(_reader(wanted is not None, lines), _SCAN_SCHEMA)


def _files(scan: DataFrame) -> DataFrame:
    letters = F.slice(F.col("letters"), F.lit(2), F.size("letters"))
    usable = F.col("intact") & (F.try_element_at("letters", F.lit(1)) == HEADER_TOKEN)
    for letter in (URL, ARCHIVE, OFFSET, MIME):
        usable = usable & F.array_contains(letters, letter)
    return scan.filter("line_no IS NULL").select(
        "path",
        "item_dir",
        "header",
        letters.alias("letters"),
        "intact",
        F.coalesce(usable, F.lit(False)).alias("usable"),
        "n_malformed",
    )


def index_files(spark: SparkSession, roots: str | list[str]) -> DataFrame:
    """``(path, item_dir, header, letters, intact, usable, n_malformed)``, one row per index file.

    Only ``<dir>/<basename of dir>.cdx.gz`` counts as an index. ``usable`` says that the file
    inflates to its end and its header names all needed columns.
    """
    return _files(_scan(spark, roots, lines=False))


def read_index(
    spark: SparkSession, roots: str | list[str], wanted: DataFrame | None = None
) -> Index:
    """Files and lines of all indexes, each inflated once; the result is written as Parquet.

    With ``wanted`` (``item_dir, url``, repeats allowed) the task that reads an index gets a bit
    filter of the URLs asked from its item, and only lines that pass leave it: all lines of every
    wanted URL and few others.
    """
    scan = materialize(_scan(spark, roots, wanted), "index")
    files = _files(scan)
    usable = files.filter("usable").select("path")
    lines = scan.filter("line_no IS NOT NULL").join(
        broadcast_if_bounded(usable, files.count()), "path", "left_semi"
    )
    return Index(
        files,
        lines.select("item_dir", "line_no", "url", "mime", "warc_path", "offset", "malformed"),
    )


def read_cdx(
    spark: SparkSession, roots: str | list[str], wanted: DataFrame | None = None
) -> DataFrame:
    """``(item_dir, line_no, url, mime, warc_path, offset, malformed)`` of all usable indexes.

    ``line_no`` counts the lines of a file. Columns are found by the letters of the file's own
    header. Lines that cannot be read are flagged, because one such line spoils its whole index.
    ``wanted`` leaves out lines of URLs not asked for, see ``read_index``.
    """
    return read_index(spark, roots, wanted).lines


def usable_items(files: DataFrame) -> DataFrame:
    """``(item_dir)`` of items with a sound index: usable file, no unreadable line."""
    return files.filter(F.col("usable") & (F.col("n_malformed") == 0)).select("item_dir")


def not_revisit(mime: Column) -> Column:
    """Index rows that point at a stored body."""
    return mime != REVISIT


def latest_captures(cdx: DataFrame) -> DataFrame:
    """``(item_dir, url, warc_path, offset)``: the last index line of every URL wins."""
    return (
        cdx.filter(not_revisit(F.col("mime")) & ~F.col("malformed"))
        .groupBy("item_dir", "url")
        .agg(F.max_by(F.struct("warc_path", "offset"), "line_no").alias("at"))
        .select("item_dir", "url", "at.warc_path", "at.offset")
    )
