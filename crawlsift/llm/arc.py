"""Conversion of legacy ARC archives to WARC.

An ARC file begins with a version block that says how many fields its record lines have (five in
version 1, ten in version 2); every record is such a line and as many bytes as the line declares.
The converter turns the version block into a ``warcinfo`` record and every record into an
equivalent WARC record: ``response`` where the bytes are an HTTP response, ``resource`` otherwise.
Ids are UUIDs of archive name and record number, so a repeated task writes the same file; dates
come from the record lines; block and payload digests are computed.

Of records with equal payloads of at least ``revisit_bytes`` bytes one is written in full, and the
others as ``revisit`` records that refer to it. To find them, one pass over the archives yields
digests only; then each archive is converted by one task, which gets the decisions for its own
records. Payloads are never shuffled and do not enter the JVM.

Archives may be gzipped per record, gzipped whole, or plain, and are read as a stream: memory is
bounded by the largest record. Damage: bytes that begin no record line are passed over up to the
next line that does, and a record cut off at the end is left out; both are counted in ``skipped``.
Dates that cannot be read become the archive's own. Of equal rows of equal keys any one is written
in full. Null keys come after all others.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.llm.common import frugal, join_hot, ready
from crawlsift.session import materialize, work_dir
from crawlsift.sinks.record_files import ATOMIC_STORES
from crawlsift.sources.paths import decoded_path, open_fs, replace_file
from crawlsift.sources.warc import read_warc

# Fixed values.
FIELDS = {b"1": 5, b"2": 10}
V1_FIELDS = b"URL IP-address Archive-date Content-type Archive-length"
V2_FIELDS = b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
REVISIT_BYTES = 100
KEY_HEADER = "X-Page-Id"
ARC_BYTES = 64 << 20
_READ_BYTES = 1 << 18
_LONGEST_LINE = 1 << 16
_LINE = re.compile(rb"[A-Za-z][A-Za-z0-9+.-]*:\S.*")
_NO_CAP = 1 << 40


def _inflated(handle) -> Iterator[bytes]:
    """Bytes of a file: members of a gzip file one after another, or a plain file as it is."""
    data = handle.read(_READ_BYTES)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = handle.read(_READ_BYTES)
        return
    member = zlib.decompressobj(31)
    while data:
        out = member.decompress(data)
        if out:
            yield out
        data = member.unused_data
        if member.eof:
            member = zlib.decompressobj(31)
            data = data.lstrip(b"\0") or handle.read(_READ_BYTES)
        else:
            data = handle.read(_READ_BYTES)


class _Stream:
    """Lines and blocks of a byte stream; holds no more than it must."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held, self.at = chunks, b"", 0
        self.broken = False

    def _more(self) -> bool:
        try:
            chunk = next(self.chunks, b"")
        except (zlib.error, EOFError):
            chunk, self.broken = b"", True
        self.held, self.at = self.held[self.at :] + chunk, 0
        return bool(chunk)

    def line(self) -> bytes | None:
        """Next line without its end; a line beyond any sensible length is cut there."""
        while True:
            end = self.held.find(b"\n", self.at)
            if end >= 0 or len(self.held) - self.at > _LONGEST_LINE:
                end = end if end >= 0 else self.at + _LONGEST_LINE
                out = self.held[self.at : end]
                self.at = min(end + 1, len(self.held))
                return out.rstrip(b"\r")
            if not self._more():
                out, self.at = self.held[self.at :], len(self.held)
                return out or None

    def block(self, size: int) -> bytes | None:
        parts, have = [], 0
        while have < size:
            part = self.held[self.at : self.at + size - have]
            self.at += len(part)
            have += len(part)
            parts.append(part)
            if have < size and not self._more():
                return None
        return b"".join(parts)


@dataclass
class ArcRecord:
    """One record; ``number`` counts from 0, the version block. ``skipped`` bytes lie before it."""

    number: int
    url: str
    ip: str
    date: str
    mime: str
    block: bytes
    skipped: int = 0

    @property
    def header_end(self) -> int:
        """Length of the HTTP header block; 0 where the record is not an HTTP response."""
        if not self.block.startswith(b"HTTP/"):
            return 0
        ends = [(at, at + len(b)) for b in (b"\r\n\r\n", b"\n\n") if (at := self.block.find(b)) >= 0]
        return min(ends)[1] if ends else len(self.block)

    @property
    def payload(self) -> bytes:
        return self.block[self.header_end :]


def _date(raw: bytes, default: str) -> str:
    """ISO date of a 14-digit date; shorter ones are filled up."""
    digits = raw.decode("latin-1")
    if not digits.isdigit() or not 4 <= len(digits) <= 14:
        return default
    filled = digits + "00000101000000"[len(digits) :]
    try:
        return datetime.datetime.strptime(filled, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return default


def _fields(line: bytes, count: int) -> list[bytes] | None:
    """Fields of a record line; a URL may hold blanks, so fields are taken from the right."""
    fields = line.rsplit(b" ", count - 1)
    if len(fields) != count or not fields[-1].isdigit() or not _LINE.match(fields[0]):
        return None
    return fields


def iter_arc(handle) -> Iterator[ArcRecord]:
    """Records of an archive, its version block first."""
    stream = _Stream(_inflated(handle))
    count, own_date = 5, "1970-01-01T00:00:00Z"
    number = skipped = 0
    while (line := stream.line()) is not None:
        first = number == 0
        fields = _fields(line, 5 if first else count)
        if fields is None:
            skipped += len(line) + 1 if line else 0
            continue
        block = stream.block(int(fields[-1]))
        if block is None:
            return
        if first and fields[0].startswith(b"filedesc:"):
            count = FIELDS.get(block[:1], 5)
            own_date = _date(fields[2], own_date)
        url, ip, mime = (f.decode("utf-8", "replace") for f in (fields[0], fields[1], fields[3]))
        yield ArcRecord(number, url, ip, _date(fields[2], own_date), mime, block, skipped)
        number += 1
        skipped = 0


def record_id(archive: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{number}')}>"


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _http_header(record: ArcRecord, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*(.*?)[ \t]*\r?$", record.block[: record.header_end])
    return found[1].decode("latin-1") if found else None


def warc_record(archive: str, record: ArcRecord, refers_to: tuple[str, str, str] | None) -> bytes:
    """One gzip member. ``refers_to`` has id, URI and date of the record with the same payload."""
    payload = _digest(record.payload)
    block = record.block
    if record.number == 0 and record.url.startswith("filedesc:"):
        kind, mime = "warcinfo", "application/warc-fields"
        block = f"software: crawlsift\r\nformat: WARC File Format 1.0\r\nconvertedFrom: {archive}\r\n".encode()
    elif record.header_end:
        kind, mime = "response", "application/http; msgtype=response"
    else:
        kind, mime = "resource", record.mime if "/" in record.mime else "application/octet-stream"
    headers = {"WARC-Type": kind, "WARC-Record-ID": record_id(archive, record.number), "WARC-Date": record.date}
    if kind == "warcinfo":
        headers["WARC-Filename"] = archive
    else:
        headers |= {"WARC-Target-URI": record.url, "WARC-Payload-Digest": f"sha256:{payload}"}
        if re.fullmatch(r"[0-9a-fA-F.:]{3,45}", record.ip) and record.ip != "0.0.0.0":
            headers["WARC-IP-Address"] = record.ip
    if refers_to and kind in ("response", "resource"):
        block = block[: record.header_end]
        headers |= {
            "WARC-Type": "revisit",
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": refers_to[0],
            "WARC-Refers-To-Target-URI": refers_to[1],
            "WARC-Refers-To-Date": refers_to[2],
        }
    headers |= {"WARC-Block-Digest": f"sha256:{_digest(block)}", "Content-Type": mime, "Content-Length": str(len(block))}
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()) + "\r\n"
    return _gzip(head.encode() + block + b"\r\n\r\n")


def _gzip(data: bytes) -> bytes:
    deflater = zlib.compressobj(1, wbits=31)
    return deflater.compress(data) + deflater.flush()


@contextmanager
def _new_file(directory: str, name: str):
    """A file that appears under its name only once it is complete."""
    fs, base = open_fs(directory)
    base = base.rstrip("/")
    atomic = fs.type_name in ATOMIC_STORES
    if not atomic:
        fs.create_dir(base, recursive=True)
    path = f"{base}/{name}"
    target = path if atomic else f"{base}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(target, compression=None) as out:
        yield out
    if not atomic:
        replace_file(fs, target, path)


def _make_folder(directory: str) -> None:
    fs, base = open_fs(directory)
    fs.create_dir(base, recursive=True)


def write_arcs(pages: DataFrame, directory: str, arc_bytes: int = ARC_BYTES, key_header: str = KEY_HEADER) -> int:
    """Write ``pages`` (page_id, url, html) as ARC files, versions 1 and 2 in turn; count records.

    A page is an HTTP response whose header ``key_header`` has the page id. Null html is an empty
    payload; a null id gets no such header.
    """
    ready(pages.sparkSession)
    _make_folder(directory)
    slim = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rows = ((p, u, h) for b in batches for p, u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()))
        row = next(rows, None)
        for n in range(1 << 30):
            if row is None:
                return
            name, count, size = f"pages-{part:06d}-{n:04d}.arc", 0, 0
            version = 1 + (part + n) % 2
            with _new_file(directory, f"{name}.gz") as out:
                out.write(_gzip(_version_block(name, version)))
                while row is not None and size < arc_bytes:
                    record = _arc_record(*row, version, name, size, key_header)
                    out.write(_gzip(record))
                    count, size = count + 1, size + len(record)
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"records": [count]})

    return slim.mapInArrow(frugal(run), "records long").agg(F.sum("records")).first()[0] or 0


def _version_block(name: str, version: int) -> bytes:
    body = f"{version} 0 crawlsift\n".encode() + (V1_FIELDS if version == 1 else V2_FIELDS) + b"\n"
    fields = [f"filedesc://{name}", "0.0.0.0", "20000101000000", "text/plain"]
    if version == 2:  # the version block's own line has version 1 fields
        body += b"\n"
    return f"{' '.join(fields)} {len(body)}\n".encode() + body + b"\n"


def _arc_record(page_id: int | None, url: str | None, html: str, version: int, name: str, offset: int, key_header: str) -> bytes:
    body = html.encode("utf-8", "replace")
    key = "" if page_id is None else f"{key_header}: {page_id}\r\n"
    block = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{key}\r\n".encode() + body
    when = datetime.datetime(2000, 1, 1) + datetime.timedelta(seconds=abs(page_id or 0) % 10**8)
    clean = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")
    fields = [clean if _LINE.match(clean.encode()) else f"urn:page:{clean}", "0.0.0.0", when.strftime("%Y%m%d%H%M%S"), "text/html"]
    if version == 2:
        fields += ["200", "-", "-", str(offset), name]
    return f"{' '.join(fields)} {len(block)}\n".encode() + block + b"\n"


def _archives(spark: SparkSession, directory: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.arc*").load(directory)
    return files.select(decoded_path(F.col("path")).alias("arc"), "length")


def long_key(text: str | None) -> int | None:
    """A key header's value where it is a 64-bit integer."""
    if not text or not re.fullmatch(r"[+-]?[0-9]{1,40}", text):
        return None
    return key if -(1 << 63) <= (key := int(text)) < 1 << 63 else None


def arc_index(spark: SparkSession, directory: str, key_header: str = KEY_HEADER) -> DataFrame:
    """``(arc, number, key, uri, date, size, digest, skipped)`` of every record but version blocks."""
    files = _archives(spark, directory)
    n_files = max(1, files.count())
    schema = "arc string, number int, key long, uri string, date string, size long, digest string, skipped long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in schema.split(", ")]
        for batch in batches:
            for arc in batch.column(0).to_pylist():
                rows = []
                fs, path = open_fs(arc)
                with fs.open_input_stream(path, compression=None) as handle:
                    for r in iter_arc(handle):
                        if r.number == 0 and r.url.startswith("filedesc:"):
                            continue
                        key = _http_header(r, key_header)
                        key = long_key(key)
                        rows.append((arc, r.number, key, r.url, r.date, len(r.payload), _digest(r.payload), r.skipped))
                if rows:
                    columns = [list(c) for c in zip(*rows)]
                    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    # With its number given, adaptive execution leaves the list as it is: one archive a task.
    return files.select("arc").repartition(n_files).mapInArrow(frugal(run), schema)


def convert_arcs(
    spark: SparkSession, directory: str, target: str, key_header: str = KEY_HEADER, revisit_bytes: int = REVISIT_BYTES
) -> DataFrame:
    """Write a ``.warc.gz`` file below ``target`` for every archive; one row ``(warc, records)`` each.

    Of equal payloads the record with the smallest key, then archive and number, is written in full.
    """
    ready(spark)
    _make_folder(target)
    records = materialize(arc_index(spark, directory, key_header), "arc-index")
    first = F.min(F.struct(F.col("key").isNull().alias("nameless"), "key", "arc", "number", "uri", "date")).alias("first")
    groups = (
        records.where(F.col("size") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("copies"), first)
        .where("copies > 1")
        .select("digest", "copies", *[F.col(f"first.{c}").alias(f"{c}1") for c in ("arc", "number", "uri", "date")])
    )
    joined = join_hot(records, groups, "digest", "copies", records.count(), F.xxhash64("arc", "number"))
    itself = (F.col("arc") == F.col("arc1")) & (F.col("number") == F.col("number1"))
    decided = joined.select(
        "arc", "number", *[F.when(~itself, F.col(c)).alias(c) for c in ("arc1", "number1", "uri1", "date1")]
    )
    # Archives without records still become a file.
    n_files = max(1, _archives(spark, directory).count())
    empty = _archives(spark, directory).select("arc", F.lit(-1).alias("number"), *[F.lit(None).cast(t).alias(c) for c, t in (("arc1", "string"), ("number1", "int"), ("uri1", "string"), ("date1", "string"))])
    dealt = decided.union(empty).repartition(n_files, "arc")

    def convert(table: pa.Table) -> pa.Table:
        arc = table.column("arc")[0].as_py()
        name = arc.rsplit("/", 1)[-1]
        refers = {
            n: (record_id(a.rsplit("/", 1)[-1], n1), u, d)
            for n, a, n1, u, d in zip(*(table.column(c).to_pylist() for c in ("number", "arc1", "number1", "uri1", "date1")))
            if a is not None
        }
        count = 0
        out_name = f"{name}.warc.gz"  # the whole name: x.arc and x.arc.gz are two archives
        fs, path = open_fs(arc)
        with fs.open_input_stream(path, compression=None) as handle, _new_file(target, out_name) as out:
            for record in iter_arc(handle):
                out.write(warc_record(name, record, refers.get(record.number)))
                count += 1
        return pa.table({"warc": [out_name], "records": pa.array([count], pa.int64())})

    return dealt.groupBy("arc").applyInArrow(convert, "warc string, records long")


def read_converted(spark: SparkSession, directory: str, key_header: str = KEY_HEADER) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of all page records.

    Everything comes from the archives: a response's size and digest from its payload, those of a
    revisit from the response it refers to.
    """
    columns = ["warc_type", "warc_headers", "http_headers", "payload"]
    records = read_warc(spark, directory, max_content_length=_NO_CAP, columns=columns)
    pages = materialize(
        records.where(F.col("warc_type").isin("response", "resource", "revisit")).select(
            F.col("http_headers")[key_header].cast("long").alias("page_id"),
            F.col("warc_type").alias("record_type"),
            F.col("warc_headers")["WARC-Record-ID"].alias("record"),
            F.col("warc_headers")["WARC-Refers-To"].alias("target"),
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha2("payload", 256).alias("digest"),
        ),
        "warc-pages",
    )
    revisits = pages.where("record_type = 'revisit'").select("page_id", "record_type", "target")
    wanted = revisits.groupBy("target").agg(F.count(F.lit(1)).alias("copies"))
    targets = wanted.join(
        pages.where("record_type <> 'revisit'").select(F.col("record").alias("target"), F.col("page_id").alias("refers_to"), "bytes", "digest"),
        "target",
    )
    found = join_hot(revisits, targets, "target", "copies", pages.count(), F.col("page_id"))
    full = pages.where("record_type <> 'revisit'").withColumn("refers_to", F.lit(None).cast("long"))
    names = ["page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"]
    return full.select(*names).union(found.select(*names))


def archived_pages(pages: DataFrame, directory: str | None = None) -> DataFrame:
    """Write ``pages`` as ARC, convert to WARC, and read the WARC records back."""
    spark = pages.sparkSession
    directory = directory or work_dir(spark, "archives")
    write_arcs(pages, f"{directory}/arc")
    convert_arcs(spark, f"{directory}/arc", f"{directory}/warc").agg(F.sum("records")).collect()
    return read_converted(spark, f"{directory}/warc")
