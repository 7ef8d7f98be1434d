"""Archive records as a DataFrame: ``spark.read.format("warc")``.

One input partition is a byte range of one archive, or several small archives. Members of the
gzip file are inflated as a stream, records over the size cap are skipped without being held in
memory, and rows leave as Arrow batches of bounded size. Filters on type, content type, length and
headers are pushed down: a record that cannot pass is dropped before its block is read.
"""

from __future__ import annotations

import codecs
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
)

from crawlsift.sources.paths import list_files, open_fs

_HEADERS = T.MapType(T.StringType(), T.StringType())

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("record_offset", T.LongType()),
        T.StructField("record_length", T.LongType()),
        T.StructField("has_headers", T.BooleanType()),
        T.StructField("has_http_headers", T.BooleanType()),
        T.StructField("warc_type", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("warc_headers", _HEADERS),
        T.StructField("http_headers", _HEADERS),
        T.StructField("content_type", T.StringType()),
        T.StructField("http_charset", T.StringType()),
        T.StructField("block_length", T.LongType()),
        T.StructField("content_length", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)
#: Columns of the row that ends a byte range, for those who ask for them; null on records.
RANGE_SCHEMA = T.StructType(
    [
        T.StructField("range_start", T.LongType()),
        T.StructField("range_end", T.LongType()),
        T.StructField("archive_length", T.LongType()),
        T.StructField("range_records", T.LongType()),
        T.StructField("range_errors", T.LongType()),
    ]
)
#: What a job that looks at page or image content needs; header maps cost time to ship.
SLIM_COLUMNS = [f.name for f in RECORD_SCHEMA if f.name not in ("warc_headers", "http_headers")]

_ARROW_TYPES = {
    T.StringType: pa.string(),
    T.LongType: pa.int64(),
    T.IntegerType: pa.int32(),
    T.DoubleType: pa.float64(),
    T.BooleanType: pa.bool_(),
    T.BinaryType: pa.binary(),
    T.MapType: pa.map_(pa.string(), pa.string()),
}

# Fixed values.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
DEFAULT_CAP = 4_000_000
DEFAULT_SPLIT = 256 * 1024 * 1024
#: What opening an archive costs, in bytes that could be read meanwhile.
OPEN_BYTES = 1 << 20
#: A task of small ranges takes so many bytes, ``OPEN_BYTES`` for each range included.
TASK_BYTES = 64 << 20
_READ_BYTES = 1 << 20
_FEED_BYTES = 1 << 14
_INFLATE_BYTES = 1 << 16
_LOOK_BACK = 1 << 20
_BATCH_BYTES = 8 << 20
_BATCH_ROWS = 512
_MAGIC = b"\x1f\x8b\x08"
_RECORD = b"WARC/"
_LOOK_BYTES = 1 << 16
#: So many first bytes tell one member from another.
_HEAD_BYTES = 64
#: Longest run of bytes deflate stores verbatim. An archive nested inside a record can imitate
#: member starts only within such a run, so a chain of valid members beyond it is genuine.
_STORED_LIMIT = 65_536


class _Members:
    """Inflates consecutive gzip members from ``offset`` on, holding little in memory."""

    def __init__(self, handle, offset: int, read_bytes: int = _READ_BYTES):
        self.handle = handle
        self.read_bytes = read_bytes
        handle.seek(offset)
        self.position = offset  # file offset of the first unconsumed compressed byte
        self.raw = memoryview(b"")
        self.out = bytearray()
        self.start = 0  # consumed prefix of ``out``
        self.ended = True

    def _feed(self) -> bool:
        if not len(self.raw):
            self.raw = memoryview(self.handle.read(self.read_bytes))
        return len(self.raw) > 0

    def open(self) -> bool:
        """Start the next member; False at the end of the file."""
        if not self._feed():
            return False
        self.inflater = zlib.decompressobj(31)
        self.out = bytearray()
        self.start = 0
        self.ended = False
        return True

    def fill(self, size: int) -> bool:
        """Make ``size`` unread bytes available; False when the member ends before."""
        while len(self.out) - self.start < size and not self.ended:
            more = self._feed()
            piece = self.raw[:_FEED_BYTES]
            out = self.inflater.decompress(piece, _INFLATE_BYTES)
            if not more and not out and not self.inflater.eof:
                raise EOFError("archive ends inside a member")
            self.out += out
            rest = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            used = len(piece) - len(rest)
            self.raw = self.raw[used:]
            self.position += used
            self.ended = self.inflater.eof
        return len(self.out) - self.start >= size

    def take(self, size: int) -> bytes:
        self.fill(size)
        data = bytes(self.out[self.start : self.start + size])
        del self.out[: self.start + len(data)]
        self.start = 0
        return data

    def drop(self, size: int | None = None) -> int:
        """Discard ``size`` bytes, or the rest of the member, without keeping them; how many there
        were."""
        dropped = 0
        while size is None or dropped < size:
            have = len(self.out) - self.start
            if have == 0:
                if self.ended or not self.fill(1):
                    break
                continue
            step = have if size is None else min(have, size - dropped)
            self.start += step
            dropped += step
            if self.start == len(self.out):
                self.out = bytearray()
                self.start = 0
        return dropped

    def at_record(self) -> bool:
        """True when the next bytes begin a record."""
        return self.fill(len(_RECORD)) and self.out.startswith(_RECORD, self.start)

    def find_header_end(self, limit: int | None = None) -> int:
        """Length of the header block at the read position, its blank line included; -1 if there
        is none in the member or its next ``limit`` bytes."""
        size, looked = 4096, 0
        while True:
            full = self.fill(size if limit is None else min(size, limit))
            stop = len(self.out) if limit is None else min(len(self.out), self.start + limit)
            end = header_end(self.out, self.start + looked, stop)
            if end >= 0:
                return end - self.start
            if not full or (limit is not None and stop - self.start >= limit):
                return -1
            have = len(self.out) - self.start
            size, looked = 2 * have, max(0, have - 3)

    def skip_blank(self) -> bool:
        """Skip line ends between records; False when the member holds nothing more."""
        while self.fill(1):
            if self.out[self.start] not in b"\r\n":
                return True
            self.start += 1
        return False


def header_end(data: bytes | bytearray, start: int = 0, stop: int | None = None) -> int:
    """Where the header block ends that goes up to the first blank line; -1 if there is none."""
    ends = [at + len(blank) for blank in (b"\r\n\r\n", b"\n\n") if (at := data.find(blank, start, stop)) >= 0]
    return min(ends, default=-1)


def _lines(raw: bytes) -> list[str]:
    """Header lines; only line feeds end one, other separators may stand in a URL."""
    return re.split("\r?\n", _text(raw))


def _text(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _parse_headers(lines: list[str]) -> dict[str, str]:
    """Header map: continuation lines joined, repeated names joined by a comma."""
    headers: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in (" ", "\t") and last is not None:
            headers[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            continue
        name, value = name.strip(), value.strip()
        headers[name] = f"{headers[name]}, {value}" if name in headers else value
        last = name
    return headers


def _lookup(headers: dict[str, str], name: str) -> str | None:
    value = headers.get(name)
    if value is None:
        wanted = name.lower()
        for key, candidate in headers.items():
            if key.lower() == wanted:
                return candidate
    return value


def _charset(content_type: str) -> str | None:
    """Charset parameter of a content type when Python knows it, else None."""
    for part in content_type.split(";")[1:]:
        name, _, value = part.partition("=")
        if name.strip() == "charset":
            try:
                return codecs.lookup(value.strip().strip("\"'")).name
            except (LookupError, ValueError):
                return None
    return None


def _block_length(headers: dict[str, str]) -> int:
    """The declared length; a missing one is 0, one that is no plain number is damage."""
    declared = _lookup(headers, "Content-Length")
    if declared is None:
        return 0
    if not re.fullmatch("[0-9]+", declared):
        raise ValueError(f"Content-Length is no number: {declared[:40]!r}")
    return int(declared)


#: Tests by column: True when a value of the column may pass.
Tests = dict[str, list[Callable[[object], bool]]]
#: Columns whose filters are decided from a record's headers.
TESTED = ("has_headers", "has_http_headers", "warc_type", "target_uri", "content_type", "block_length", "content_length")


def _passes(row: dict, tests: Tests) -> bool:
    """Whether a row passes the tests on those of its columns that are known by now."""
    return all(test(row[name]) for name, checks in tests.items() if name in row for test in checks)


#: What a row is that has none of the columns that tests look at: a damaged or headerless one.
_UNKNOWN = dict.fromkeys(TESTED)


def _head(headers: dict[str, str], length: int) -> dict:
    """What the headers of a record tell."""
    return {
        "has_headers": True,
        "has_http_headers": False,
        "warc_type": _lookup(headers, "WARC-Type"),
        "target_uri": _lookup(headers, "WARC-Target-URI"),
        "content_type": None,
        "warc_headers": list(headers.items()),
        "block_length": length,
        "content_length": length,
    }


def _http_head(raw: bytes) -> dict:
    """What the HTTP header block of a record tells."""
    http = _parse_headers(_lines(raw)[1:])
    kind = (_lookup(http, "Content-Type") or "none").lower()
    return {"has_http_headers": True, "http_headers": list(http.items()), "content_type": kind, "http_charset": _charset(kind)}


def _read_record(
    members: _Members, headers: dict[str, str], length: int, wanted: tuple[str, ...] | None, tests: Tests
) -> dict | None:
    """The record at the read position; None when it fails a test. Headers decide before the rest
    of the block is read, and a block that is not wanted is dropped without being held."""
    row = _head(headers, length)
    is_http = (_lookup(headers, "Content-Type") or "").lower().startswith("application/http")
    known = row if not is_http else {k: v for k, v in row.items() if k not in ("content_type", "content_length")}
    known["has_http_headers"] = is_http
    if not _passes(known, tests):
        members.drop(length)
        return None
    left = length
    if is_http:
        end = members.find_header_end(length)
        end = length if end < 0 else end
        raw = members.take(end)
        if len(raw) < end:
            raise EOFError("record is shorter than its Content-Length")
        left -= end
        row |= _http_head(raw) | {"content_length": left}
        if not _passes(row, tests):
            members.drop(left)
            return None
    if wanted is not None and not (row["content_type"] or "").startswith(wanted):
        if members.drop(left) < left:
            raise EOFError("record is shorter than its Content-Length")
        return row
    row["payload"] = members.take(left)
    if len(row["payload"]) < left:
        raise EOFError("record is shorter than its Content-Length")
    return row


def _member_rows(
    members: _Members, offset: int, cap: int, wanted: tuple[str, ...] | None, tests: Tests
) -> Iterator[dict]:
    """Rows of the records of the open member that pass the tests."""
    pending: dict | None = None
    count = 0
    while members.skip_blank():
        count += 1
        if pending is not None:
            yield {**pending, "record_offset": offset}
            pending = None
        size = members.find_header_end() if members.at_record() else -1
        if size < 0:
            members.drop()
            headless = {"has_headers": False, "has_http_headers": False}
            pending = headless if _passes(_UNKNOWN | headless, tests) else None
            break
        headers = _parse_headers(_lines(members.take(size))[1:])
        length = _block_length(headers)
        if length > cap:
            members.drop(length)
            continue
        pending = _read_record(members, headers, length, wanted, tests)
    members.drop()
    if pending is not None:
        length = members.position - offset if count <= 1 else None
        yield {**pending, "record_offset": offset, "record_length": length}


def iter_records(
    handle,
    start: int,
    end: int,
    cap: int,
    wanted: tuple[str, ...] | None = None,
    read_bytes=_READ_BYTES,
    begin: int = 0,
    tests: Tests | None = None,
    stopped: list[int] | None = None,
) -> Iterator[dict]:
    """Rows of all records whose gzip member starts in [begin, end); reading begins at ``start``.

    ``cap`` skips records with a longer block; ``wanted`` keeps payloads only for content
    types with these prefixes; ``tests`` drops records by their headers. A damaged member yields
    one row with ``error``, and reading goes on: with the next member where the damaged one could
    be inflated, else with the next place where certainly a member of the archive starts.
    ``stopped`` takes the place of the first member beyond ``end``, where it was met.
    """
    tests = tests or {}
    members = _Members(handle, start, read_bytes)
    while members.position < end:
        offset = members.position
        try:
            if not members.open():
                return
            if offset < begin:
                members.drop()
            else:
                yield from _member_rows(members, offset, cap, wanted, tests)
        except (EOFError, zlib.error, ValueError) as broken:
            if offset >= begin and _passes(_UNKNOWN, tests):
                yield {"record_offset": offset, "error": f"{type(broken).__name__}: {broken}"}
            try:
                members.drop()
                inflated = members.ended
            except (EOFError, zlib.error):
                inflated = False
            if not inflated:
                at = _next_member(handle, offset, end)
                if at is None:
                    return
                members = _Members(handle, at, read_bytes)
    if stopped is not None:
        stopped.append(members.position)


def _starts_record(handle, offset: int, size: int, damage: bool = False) -> bool:
    """True when members chain from ``offset`` past any stored run and the first is a record.

    A file that ends inside a later member was cut off; what comes before is still genuine. With
    ``damage`` so is what comes before a member that begins with a record but is damaged further
    on: what follows a nested archive is the rest of the member around it, which begins no record.
    """
    members = _Members(handle, offset)
    whole = 0
    begin = offset
    try:
        while members.position < size and members.position <= offset + _STORED_LIMIT:
            begin = members.position
            members.open()
            if whole == 0 and not members.at_record():
                return False
            members.drop()
            whole += 1
    except EOFError:
        return whole > 0
    except zlib.error:
        return damage and whole > 0 and _begins_record(handle, begin)
    return whole > 0


def _begins_record(handle, offset: int) -> bool:
    """True when a member begins here whose first bytes are a record's; it may be damaged later."""
    handle.seek(offset)
    try:
        return zlib.decompressobj(31).decompress(handle.read(4096), len(_RECORD)) == _RECORD
    except zlib.error:
        return False


def split_archive(size: int, split: int) -> list[tuple[int, int]]:
    """Byte ranges of about ``split`` bytes. A short rest joins the last range, so the end of a
    file, where a chain may be too short to prove anything, is read on from further back."""
    n = max(1, round(size / split))
    return [(i * split, size if i == n - 1 else (i + 1) * split) for i in range(n)]


def _magic_places(handle, start: int, end: int) -> Iterator[int]:
    """Offsets in [start, end) of bytes that begin a gzip member, or look so."""
    at = start
    while at < end:
        handle.seek(at)
        window = handle.read(min(_READ_BYTES, end - at) + len(_MAGIC) - 1)
        hit = window.find(_MAGIC)
        while hit >= 0 and at + hit < end:
            yield at + hit
            hit = window.find(_MAGIC, hit + 1)
        if len(window) < len(_MAGIC):
            return
        at += len(window) - len(_MAGIC) + 1


def find_record_start(handle, start: int, end: int, size: int) -> int | None:
    """First offset in [start, end) where certainly a record's member starts; None if there is
    none. The start of the file is taken as it is."""
    if start == 0:
        return 0
    return next((at for at in _magic_places(handle, start, end) if _starts_record(handle, at, size)), None)


def _data_start(head: bytes) -> int:
    """Where the compressed data of a gzip member start, from its first bytes."""
    flags, at = head[3], 10
    if flags & 4:
        at += 2 + int.from_bytes(head[at : at + 2], "little")
    for flag in (8, 16):  # name, comment
        if flags & flag:
            at = head.index(b"\0", at) + 1
    return at + (2 if flags & 2 else 0)


def _look_into(handle, offset: int) -> tuple[int | None, set[bytes]]:
    """What a damaged member tells about itself: where its compressed data end, if they can be
    followed so far (only its content is wrong then), and how members begin that its content holds."""
    handle.seek(offset)
    heads: set[bytes] = set()
    tail = b""
    try:
        piece = handle.read(_LOOK_BYTES)
        start = _data_start(piece)
        piece, position = piece[start:], offset + start
        inflater = zlib.decompressobj(-15)
        while piece and not inflater.eof:
            out = inflater.decompress(piece, _INFLATE_BYTES)
            rest = inflater.unused_data if inflater.eof else inflater.unconsumed_tail
            position += len(piece) - len(rest)
            window = tail + out
            at = window.find(_MAGIC)
            while 0 <= at <= len(window) - _HEAD_BYTES:
                heads.add(window[at : at + _HEAD_BYTES])
                at = window.find(_MAGIC, at + 1)
            tail = window[max(0, len(window) - _HEAD_BYTES + 1) :]
            piece = rest or handle.read(_LOOK_BYTES)
    except (zlib.error, ValueError, IndexError):
        return None, heads
    return (position + 8 if inflater.eof else None), heads


def _next_member(handle, offset: int, end: int) -> int | None:
    """Where reading goes on after the damaged member at ``offset``: right behind it where its
    end can be told, else the next place where certainly a record's member starts.

    An archive nested in the damaged member must not pass for records of this one.
    """
    here = handle.seek(0, 2)
    size = handle.tell() if here is None else here
    behind, heads = _look_into(handle, offset)
    if behind is not None and (behind >= size or _begins_record(handle, behind)):
        return behind if behind < end else None
    for at in _magic_places(handle, offset + 1, end):
        handle.seek(at)
        if handle.read(_HEAD_BYTES) not in heads and _starts_record(handle, at, size, damage=True):
            return at
    return None


def find_anchor(handle, start: int, size: int) -> int:
    """A certain member start at or before ``start``, near it as a rule.

    Reading on from there meets the same members, damaged ones included, as reading from the
    start of the file does, so every range agrees on what lies in it.
    """
    back = _LOOK_BACK
    while back < start:
        found = find_record_start(handle, start - back, start + 1, size)
        if found is not None:
            return found
        back *= 4
    return 0


def to_batches(
    rows: Iterator[dict], schema: T.StructType, max_rows: int = _BATCH_ROWS
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``max_rows`` rows and about 8 MB of payload."""
    kinds = [(f.name, _ARROW_TYPES[type(f.dataType)]) for f in schema]
    held: list[dict] = []
    size = 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r.get(name) for r in held], kind) for name, kind in kinds],
            names=[name for name, _ in kinds],
        )

    for row in rows:
        held.append(row)
        size += len(row.get("payload") or b"")
        if len(held) >= max_rows or size >= _BATCH_BYTES:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def read_range(
    path: str,
    start: int,
    end: int,
    size: int,
    cap: int,
    wanted: tuple[str, ...] | None,
    tests: Tests | None = None,
    mark: bool = False,
    first: int | None = None,
    stopped: list[int] | None = None,
) -> Iterator[dict]:
    """Rows of the records of one archive that start in a byte range; with ``mark`` one more row
    that says that the range has been read, and what was in it.

    Reading begins at ``first``, where it is known from the range before as the first member that
    is not one of its own; ``stopped`` takes the same for the range behind.
    """
    fs, inner = open_fs(path)
    n = errors = 0
    with fs.open_input_file(inner) as handle:
        if first is None:
            first = find_anchor(handle, start, size)
        for row in iter_records(handle, first, end, cap, wanted, begin=start, tests=tests, stopped=stopped):
            row["archive"] = path
            n += 1
            errors += "error" in row
            yield row
    if mark:
        yield {
            "archive": path,
            "range_start": start,
            "range_end": end,
            "archive_length": size,
            "range_records": n - errors,
            "range_errors": errors,
        }


@dataclass
class ArchiveRange:
    path: str
    start: int
    end: int
    size: int


@dataclass
class RangeList(InputPartition):
    """What one task reads: a range of a large archive, or some small archives."""

    ranges: list[ArchiveRange]


def pack_ranges(archives: list[tuple[str, int]], split: int, least_parts: int = 1) -> list[RangeList]:
    """Partitions of about ``split`` bytes, fewer where that would leave less than ``least_parts``.

    Large archives are cut into ranges. Small ones, in order, share a partition until their bytes,
    and ``OPEN_BYTES`` for opening each, fill it.
    """
    ranges = [ArchiveRange(path, start, end, size) for path, size in archives for start, end in split_archive(size, split)]
    return share_tasks(ranges, split, least_parts)


def share_tasks(ranges: list[ArchiveRange], split: int, least_parts: int = 1) -> list[RangeList]:
    """Ranges that are short beside ``OPEN_BYTES``, or whole archives, share a partition; a task for
    each of very many short ranges would cost more than reading them. Other ranges have their own."""
    total = sum(r.end - r.start + OPEN_BYTES for r in ranges)
    room = min(max(split, TASK_BYTES), max(OPEN_BYTES, total // max(1, least_parts)))
    if split > OPEN_BYTES:
        room = min(room, split)
    parts: list[RangeList] = []
    held: list[ArchiveRange] = []
    used = 0
    for r in ranges:
        length = r.end - r.start
        if length < r.size and split > OPEN_BYTES:
            parts.append(RangeList([r]))
            continue
        if held and used + length + OPEN_BYTES > room:
            parts.append(RangeList(held))
            held, used = [], 0
        held.append(r)
        used += length + OPEN_BYTES
    return parts + ([RangeList(held)] if held else [])


def _payload_types(option: str | None) -> tuple[str, ...] | None:
    """None = all payloads; empty tuple = none; else content-type prefixes."""
    if option is None or option == "all":
        return None
    return tuple(part for part in option.split(",") if part)


def record_schema(columns: list[str] | None, marks: bool = False) -> T.StructType:
    """The columns named, or all; with ``marks`` also those of the rows that end byte ranges."""
    unknown = set(columns or ()) - set(RECORD_SCHEMA.names)
    if unknown:
        raise ValueError(f"no such record columns: {sorted(unknown)}")
    kept = [f for f in RECORD_SCHEMA if columns is None or f.name in columns]
    if marks and "archive" not in {f.name for f in kept}:
        kept.insert(0, RECORD_SCHEMA["archive"])
    return T.StructType([*kept, *(RANGE_SCHEMA if marks else ())])


def _comparison(test: Callable[[object, object], bool], value) -> Callable[[object], bool]:
    return lambda found: found is not None and test(found, value)


_COMPARISONS = {
    EqualTo: lambda a, b: a == b,
    In: lambda a, b: a in b,
    GreaterThan: lambda a, b: a > b,
    GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
    StringStartsWith: lambda a, b: a.startswith(b),
}


def _test_of(wanted: Filter) -> tuple[str, Callable[[object], bool]] | None:
    """Column and test of a filter that headers decide, else None."""
    if type(wanted) is not IsNotNull and type(wanted) not in _COMPARISONS:
        return None
    if len(wanted.attribute) != 1 or wanted.attribute[0] not in TESTED:
        return None
    if isinstance(wanted, IsNotNull):
        return wanted.attribute[0], lambda found: found is not None
    if wanted.value is None:
        return None
    value = tuple(wanted.value) if isinstance(wanted, In) else wanted.value
    return wanted.attribute[0], _comparison(_COMPARISONS[type(wanted)], value)


@dataclass
class ReadOptions:
    """What archives are read, and how; shared by batch and stream."""

    roots: list[str]
    suffix: str
    cap: int
    split: int
    wanted: tuple[str, ...] | None
    columns: T.StructType
    filters: list[Filter] = field(default_factory=list)

    @classmethod
    def of(cls, options, schema: T.StructType) -> "ReadOptions":
        return cls(
            options["paths"].split("\n") if "paths" in options else [options["path"]],
            options.get("suffix", ".warc.gz"),
            int(options.get("maxContentLength", DEFAULT_CAP)),
            int(options.get("splitBytes", DEFAULT_SPLIT)),
            _payload_types(options.get("payload")),
            schema,
        )

    def read(self, partition: RangeList) -> Iterator[pa.RecordBatch]:
        tests: Tests = {}
        for name, test in filter(None, map(_test_of, self.filters)):
            tests.setdefault(name, []).append(test)
        mark = "range_end" in self.columns.names

        def rows() -> Iterator[dict]:
            before, first = None, None
            for r in partition.ranges:
                if before != (r.path, r.start):
                    first = None
                stopped: list[int] = []
                yield from read_range(r.path, r.start, r.end, r.size, self.cap, self.wanted, tests, mark, first, stopped)
                before, first = (r.path, r.end), (stopped or [None])[0]

        return to_batches(rows(), self.columns)


class WarcReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.options = ReadOptions.of(options, schema)
        self.least_parts = int(options.get("leastPartitions", 1))

    def partitions(self) -> list[RangeList]:
        archives = list_files(self.options.roots, self.options.suffix)
        return pack_ranges(archives, self.options.split, self.least_parts)

    def read(self, partition: RangeList | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark passes where there are no partitions at all
            return iter(())
        return self.options.read(partition)


class FilteringWarcReader(WarcReader):
    """Takes the filters that headers decide; the others stay with Spark."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for wanted in filters:
            if _test_of(wanted) is None:
                yield wanted
            else:
                self.options.filters.append(wanted)


class WarcDataSource(DataSource):
    """Options: ``path`` or ``paths`` (newline-separated), ``maxContentLength``, ``payload``
    (``all``, empty, or content-type prefixes), ``columns``, ``marks`` (true: also a row at the
    end of each byte range), ``splitBytes``, ``leastPartitions``, ``suffix``; ``pushFilters``
    (true: take filters; needs ``PUSHDOWN`` to be on, and no ``marks``); for streams also ``log``
    and ``maxBytesPerTrigger``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        columns = self.options.get("columns")
        marks = self.options.get("marks", "false").lower() == "true"
        return record_schema(columns.split(",") if columns else None, marks)

    def reader(self, schema: T.StructType) -> WarcReader:
        push = self.options.get("pushFilters", "false").lower() == "true" and "range_end" not in schema.names
        return (FilteringWarcReader if push else WarcReader)(self.options, schema)

    def streamReader(self, schema: T.StructType):
        from crawlsift.streaming.source import WarcStreamReader

        return WarcStreamReader(self.options, schema)


def read_warc(
    spark: SparkSession,
    paths: str | list[str],
    max_content_length: int = DEFAULT_CAP,
    payload: bool | list[str] = True,
    columns: list[str] | None = None,
    split_bytes: int = DEFAULT_SPLIT,
    push_filters: bool = True,
) -> DataFrame:
    """One row per archive record below ``paths``.

    ``payload`` may be False or a list of content-type prefixes: other records come without
    their bytes. ``columns`` names the columns to produce; a Python source cannot be pruned by
    the optimizer, so jobs say what they read. Archives longer than ``split_bytes`` are read
    by several tasks, short ones share a task. Filters on the columns ``TESTED`` are pushed down,
    for which Spark's setting is turned on, unless ``push_filters`` is False.
    """
    from crawlsift.session import attach

    attach(spark)
    roots = [paths] if isinstance(paths, str) else list(paths)
    kinds = "all" if payload is True else "" if payload is False else ",".join(payload)
    reader = (
        spark.read.format("warc")
        .option("paths", "\n".join(roots))
        .option("maxContentLength", max_content_length)
        .option("payload", kinds)
        .option("splitBytes", split_bytes)
        .option("leastPartitions", spark.sparkContext.defaultParallelism)
        .option("pushFilters", push_filters)
    )
    if push_filters:
        spark.conf.set(PUSHDOWN, "true")
    if payload is False and columns is None:
        columns = [name for name in RECORD_SCHEMA.names if name != "payload"]
    if columns is not None:
        reader = reader.option("columns", ",".join(columns))
    return reader.load()
