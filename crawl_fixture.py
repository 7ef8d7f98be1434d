"""A crawl derived from the ``pages`` table: archives, index files and images.

The given tables hold no archives, so queries on archives read a crawl that a Spark job builds
from every row of ``pages``. What each page contributes is a fixed function of ``page_id``, so
expected results are plain SQL over ``pages`` and never come from this module.

Per page ``p`` (100 pages per item folder, 50 per archive):

* an HTML response with the page's own URL; its markup gets ``<img>`` tags (see ``img_tags``)
* a request record
* a PNG response ``http://img.example.org/<p>.png`` of one colour (see ``image_shape``);
  SVG instead if p % 10 = 7, broken PNG if p % 10 = 8, captured twice if p % 10 = 0
* p % 10 = 1: a metadata record; 2: a response under 128 bytes; 3: a PDF response;
  5: a frameset page; 6: an index line whose URL points at another record;
  9: an index line of a revisit
* p % 25 = 0: an HTML response of 300,000 bytes, LARGE_PARAGRAPHS times the same paragraph
* a warcinfo record heads each archive
"""

from __future__ import annotations

import gzip
import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES_PER_ITEM = 100
PAGES_PER_ARCHIVE = 50
IMAGE_HOST = "http://img.example.org"
LARGE_PARAGRAPH, LARGE_PARAGRAPHS = b"<p>The house of the town is on the hill, she said.</p>", 5_556
CDX_HEADER = " CDX N b a m s k r M S V g"


def image_shape(p: int) -> tuple[int, int, tuple[int, int, int]]:
    """(height, width, colour) of the image of page ``p``."""
    colour = ((p * 37) % 256, (p * 59) % 256, (p * 83) % 256)
    return 120 + (p * 7) % 100, 130 + (p * 13) % 100, colour


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(height: int, width: int, colour: tuple[int, int, int]) -> bytes:
    """A PNG of one colour; a text chunk keeps it over 128 bytes."""
    return png_of(bytes(colour) * width * height, width)


def png_of(pixels: bytes, width: int) -> bytes:
    """A PNG of the given bytes, three a pixel, with as many rows as they need."""
    height = -(-len(pixels) // (3 * width))
    pixels = pixels.ljust(height * width * 3, b"\x00")
    rows = b"".join(b"\x00" + pixels[i : i + 3 * width] for i in range(0, len(pixels), 3 * width))
    return (
        b"\x89PNG\r\n\x1a\n"
        + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
        + _chunk(b"tEXt", b"Comment\x00" + b"one colour " * 12)
        + _chunk(b"IDAT", zlib.compress(rows))
        + _chunk(b"IEND", b"")
    )


def bmp(height: int, width: int, colour: tuple[int, int, int]) -> bytes:
    row = bytes(reversed(colour)) * width
    row += b"\x00" * (-len(row) % 4)
    body = row * height
    head = struct.pack("<IIIHHIIIIII", 40, width, height, 1, 24, 0, len(body), 2835, 2835, 0, 0)
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + head + body


def img_tags(p: int) -> str:
    if p % 10 == 3:
        return ""
    tags = [f'<img src="{IMAGE_HOST}/{p}.png" alt="picture {p}">']
    tags.append(f'<img src="{IMAGE_HOST}/{p - p % PAGES_PER_ITEM}.png" alt="">')
    if p % 2 == 0:
        tags.append(f'<img class="x" src="/local/{p}.png">')
    if p % 3 == 0:
        tags.append(f'<img alt="none {p}">')
    if p % 10 == 6:
        tags.append(f"<img alt=moved src={IMAGE_HOST}/moved-{p}.png>")
    if p % 10 == 9:
        tags.append(f"<img src='{IMAGE_HOST}/revisit-{p}.png' alt='gone'/>")
    return "".join(tags)


def member(warc_type: str, url: str | None, content_type: str, block: bytes) -> bytes:
    """One gzip member holding one record."""
    head = f"WARC/1.0\r\nWARC-Type: {warc_type}\r\n"
    if url is not None:
        head += f"WARC-Target-URI: {url}\r\n"
    head += f"Content-Type: {content_type}\r\nContent-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode("utf-8") + block + b"\r\n\r\n", mtime=0)


def response(url: str, content_type: str | None, body: bytes) -> bytes:
    kind = "" if content_type is None else f"Content-Type: {content_type}\r\n"
    http = f"HTTP/1.1 200 OK\r\nServer: test\r\n{kind}Content-Length: {len(body)}\r\n\r\n"
    return member("response", url, "application/http; msgtype=response", http.encode() + body)


def page_records(p: int, url: str, html: str) -> list[tuple[bytes, str | None, str | None]]:
    """``(member, index URL, index mime)`` of everything page ``p`` contributes."""
    html = html.replace("</article>", img_tags(p) + "</article>", 1)
    kind, body = "text/html; charset=utf-8", html.encode("utf-8")
    if p % 10 == 4:
        kind = "TEXT/HTML; Charset=UTF-8"
    elif p % 10 == 5:
        kind = "text/html"
    elif p % 10 == 6:
        kind, body = "text/html; charset=windows-1252", html.encode("cp1252", "xmlcharrefreplace")
    request = f"GET / HTTP/1.1\r\nHost: {p}.example.org\r\n\r\n".encode()
    out = [
        (member("request", url, "application/http; msgtype=request", request), None, None),
        (response(url, kind, body), url, "text/html"),
    ]
    image_url = f"{IMAGE_HOST}/{p}.png"
    height, width, colour = image_shape(p)
    if p % 10 == 7:
        svg = b"<svg xmlns='http://www.w3.org/2000/svg'>" + b"<!-- drawing -->" * 8 + b"</svg>"
        out.append((response(image_url, "image/svg+xml", svg), image_url, "image/svg+xml"))
    elif p % 10 == 8:
        broken = png(height, width, colour)[:24] + b"broken" * 30
        out.append((response(image_url, "image/png", broken), image_url, "image/png"))
    else:
        picture = png(height, width, colour)
        out.append((response(image_url, "image/png", picture), image_url, "image/png"))
    if p % 10 == 0:
        other = png(height + 1, width + 1, tuple(255 - c for c in colour))
        out.append((response(image_url, "Image/PNG", other), image_url, "image/png"))
    if p % 10 == 1:
        out.append((member("metadata", url, "application/warc-fields", b"via: x\r\n" * 30), None, None))
    if p % 10 == 2:
        out.append((response(f"{url}#short", "text/html", b"<p>short</p>"), None, None))
    if p % 10 == 3:
        out.append((response(f"{url}#pdf", "application/pdf", b"%PDF-1.4 " * 40), None, None))
    if p % 10 == 5:
        frames = b"<html><head></head><frameset>" + b"<frame src='/f'>" * 10 + b"</frameset></html>"
        out.append((response(f"{url}#frames", "text/html", frames), None, None))
    if p % 10 == 9:
        out.append((b"", f"{IMAGE_HOST}/revisit-{p}.png", "warc/revisit"))
    if p % 25 == 0:
        out.append((response(f"{url}#large", "text/html", LARGE_PARAGRAPH * LARGE_PARAGRAPHS), None, None))
    return out


def _writer(root: str):
    def write(group: pd.DataFrame) -> pd.DataFrame:
        from crawlsift.sources.paths import open_fs

        fs, base = open_fs(root)
        item = f"item-{int(group['item'].iloc[0]):06d}"
        folder = f"{base.rstrip('/')}/{item}"
        fs.create_dir(folder, recursive=True)
        index = [CDX_HEADER]
        archives = records = 0
        for k, part in group.sort_values("page_id").groupby("archive"):
            name = f"{item}-{int(k)}.warc.gz"
            data = [member("warcinfo", None, "application/warc-fields", b"software: test\r\n")]
            offset = len(data[0])
            for p, url, html in zip(part["page_id"], part["url"], part["html"]):
                image_at = 0
                for raw, index_url, mime in page_records(int(p), url, html):
                    if index_url is not None:
                        index.append(
                            f"- 20200101000000 {index_url} {mime} 200 - - - {len(raw)} {offset} {item}/{name}"
                        )
                        if mime == "image/png":
                            image_at = offset
                    if raw:
                        data.append(raw)
                        offset += len(raw)
                if p % 10 == 6:
                    index.append(
                        f"- 20200101000000 {IMAGE_HOST}/moved-{p}.png image/png 200 - - - 1 {image_at} {item}/{name}"
                    )
            with fs.open_output_stream(f"{folder}/{name}", compression=None) as stream:
                stream.write(b"".join(data))
            archives += 1
            records += len(data)
        with fs.open_output_stream(f"{folder}/{item}.cdx.gz", compression=None) as stream:
            stream.write(gzip.compress(("\n".join(index) + "\n").encode("utf-8"), mtime=0))
        return pd.DataFrame({"archives": [archives], "records": [records]})

    return write


def build_crawl(spark: SparkSession, pages: DataFrame, root: str) -> tuple[int, int]:
    """Write the crawl below ``root``; returns the numbers of archives and records.

    A group is one item of at most PAGES_PER_ITEM pages, whatever the size of the table.
    """
    keyed = pages.select(
        F.expr(f"page_id div {PAGES_PER_ITEM}").alias("item"),
        F.expr(f"page_id div {PAGES_PER_ARCHIVE}").alias("archive"),
        "page_id",
        "url",
        "html",
    )
    done = keyed.groupBy("item").applyInPandas(_writer(root), "archives int, records int")
    return tuple(done.agg(F.sum("archives"), F.sum("records")).first())


DAMAGED_PAGES = 10
LINE_SEPARATOR = "\u2028"


def damaged_archive(archive: int, pages: list[tuple[int, str, str]]) -> bytes:
    """One archive of page responses, of which every seventh is damaged.

    By turns a length that is too large or negative, a flipped bit in a member whose body stores a
    whole archive verbatim, or bytes cut out. URLs of every eleventh page hold a line separator. Every third archive is sound, and all of it is one gzip member.
    """
    members = []
    for p, url, html in pages:
        url = url + LINE_SEPARATOR + "x" if p % 11 == 0 else url
        data = response(url, "text/html", html.encode("utf-8"))
        if p % 7 == 3 and archive % 3 != 2:
            half = len(data) // 2
            if p % 3 == 0:
                plain = gzip.decompress(data)
                odd = b"Content-Length: 9" if p % 2 else b"Content-Length: -"
                data = gzip.compress(plain.replace(b"Content-Length: ", odd, 1), mtime=0)
            elif p % 3 == 1:
                nested = b"".join(response(f"{url}#nested-{i}", "text/html", html.encode("utf-8")) for i in range(3))
                plain = gzip.decompress(response(url, "text/html", nested))
                data = gzip.compress(plain, compresslevel=0, mtime=0)
                half = len(data) // 2 if p % 2 else 200
                data = data[:half] + bytes([data[half] ^ 4]) + data[half + 1 :]
            else:
                data = data[:half] + data[half + 20 :]
        members.append(data)
    if archive % 3 == 2:
        return gzip.compress(b"".join(map(gzip.decompress, members)), mtime=0)
    return b"".join(members)


def build_damaged_crawl(spark: SparkSession, pages: DataFrame, root: str) -> None:
    """Archives ``damaged-<n>.warc.gz`` of DAMAGED_PAGES pages each below ``root``."""
    from crawlsift.sinks.record_files import write_record_files

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("page_id")
        archive = int(group["archive"].iloc[0])
        rows = list(zip(group["page_id"].tolist(), group["url"], group["html"]))
        return pd.DataFrame(
            {"name": [f"damaged-{archive:06d}.warc.gz"], "body": [damaged_archive(archive, rows)]}
        )

    numbered = pages.select("page_id", "url", "html", F.expr(f"page_id div {DAMAGED_PAGES}").alias("archive"))
    files = numbered.groupBy("archive").applyInPandas(build, "name string, body binary")
    write_record_files(files, root)
