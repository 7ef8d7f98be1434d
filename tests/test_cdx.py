import gzip
import os
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from crawlsift.sources import cdx
from crawlsift.sources.cdx import index_files, latest_captures, read_cdx, read_index, usable_items
from crawlsift.sources.paths import open_fs

HEADER = " CDX N b a m s k r M S V g"


def row(url, offset, file="i/f.warc.gz", mime="text/html"):
    return f"n 2020 {url} {mime} 200 d - - 9 {offset} {file}"


def index(folder, item, text, cut=0):
    os.makedirs(f"{folder}/{item}", exist_ok=True)
    data = gzip.compress(text.encode())
    with open(f"{folder}/{item}/{item}.cdx.gz", "wb") as file:
        file.write(data[: len(data) - cut])


def test_columns_come_from_the_header(spark, folder):
    index(folder, "i", " CDX g m V a\ni/x.warc.gz text/html 7 http://h/1\n")
    (got,) = read_cdx(spark, folder).collect()
    assert (got["item_dir"], got["url"], got["mime"], got["warc_path"], got["offset"], got["malformed"]) == (
        f"{folder}/i", "http://h/1", "text/html", f"{folder}/i/x.warc.gz", 7, False,
    )


def test_last_line_wins_and_revisits_drop(spark, folder):
    lines = [HEADER]
    for n in range(300):
        lines.append(row(f"http://h/{n % 7}", n))
    lines.append(row("http://h/3", 999, mime="warc/revisit"))
    lines.append(row("http://h/r", 5, mime="warc/revisit"))
    index(folder, "i", "\n".join(lines) + "\n")
    index(folder, "j", "\n".join([HEADER, row("http://h/3", 1)]) + "\n")
    got = {(os.path.basename(r["item_dir"]), r["url"]): r["offset"] for r in latest_captures(read_cdx(spark, folder)).collect()}
    want = {("i", f"http://h/{n % 7}"): n for n in range(300)}
    assert got == {**want, ("j", "http://h/3"): 1}


def test_broken_indexes(spark, folder):
    good = "\n".join([HEADER, row("http://h/1", 1)]) + "\n"
    index(folder, "good", good)
    index(folder, "headeronly", HEADER + "\n")
    index(folder, "nocdx", good.replace(" CDX", " XDC"))
    index(folder, "nocolumn", good.replace(" V", " Q"))
    index(folder, "cut", "\n".join([HEADER] + [row(f"http://h/{os.urandom(8).hex()}", i) for i in range(500)]), cut=30)
    index(folder, "badoffset", good + row("http://h/2", "x") + "\n")
    index(folder, "shortline", good + "a b\n")
    os.makedirs(f"{folder}/other")
    with open(f"{folder}/other/name.cdx.gz", "wb") as file:
        file.write(gzip.compress(good.encode()))
    files = index_files(spark, folder)
    items = usable_items(files)
    assert sorted(os.path.basename(r["item_dir"]) for r in items.collect()) == ["good", "headeronly"]
    urls = latest_captures(read_cdx(spark, folder)).filter(F.col("item_dir").endswith("/good"))
    assert [r["url"] for r in urls.collect()] == ["http://h/1"]


def batch_of(folder, item, words=None):
    columns = {"path": [f"{folder}/{item}/{item}.cdx.gz"], "item_dir": [f"{folder}/{item}"]}
    fields = [("path", pa.string()), ("item_dir", pa.string())]
    if words is not None:
        columns["words"] = [words]
        fields.append(("words", pa.list_(pa.struct([("word", pa.int32()), ("mask", pa.int64())]))))
    return pa.RecordBatch.from_pydict(columns, schema=pa.schema(fields))


def test_each_index_is_inflated_once(folder, monkeypatch):
    lines = [HEADER] + [row(f"http://h/{i}", i) for i in range(5000)]
    index(folder, "i", "\n".join(lines) + "\n")
    opened = []
    monkeypatch.setattr(cdx, "open_fs", lambda path: opened.append(path) or open_fs(path))
    monkeypatch.setattr(cdx, "_PIECE_BYTES", 1000)
    out = pa.Table.from_batches(list(cdx._reader(False, True)(iter([batch_of(folder, "i")])))).to_pylist()
    assert len(opened) == 1
    assert [r["offset"] for r in out[:-1]] == list(range(5000))
    assert [r["line_no"] for r in out[:-1]] == list(range(1, 5001))
    assert (out[-1]["intact"], out[-1]["n_malformed"], out[-1]["line_no"]) == (True, 0, None)


def test_only_wanted_lines_leave_the_task(folder):
    lines = [HEADER] + [row(f"http://h/{i % 4000}", i) for i in range(5000)] + ["spoiled"]
    index(folder, "i", "\n".join(lines) + "\n")
    index(folder, "j", "\n".join(lines) + "\n")
    at = zlib.crc32(b"http://h/77") % cdx._FILTER_BITS
    mask = 1 << (at & 63)
    words = [{"word": at >> 6, "mask": mask - (1 << 64) if mask >> 63 else mask}]
    batches = [batch_of(folder, "i", words), batch_of(folder, "j", [])]
    out = pa.Table.from_batches(list(cdx._reader(True, True)(iter(batches)))).to_pylist()
    kept = [r for r in out if r["line_no"] is not None]
    assert len(kept) < 50 and {r["item_dir"] for r in kept} == {f"{folder}/i"}
    assert [r["offset"] for r in kept if r["url"] == "http://h/77"] == [77, 4077]
    # lines that are not wanted are looked at all the same
    assert [r["n_malformed"] for r in out if r["line_no"] is None] == [1, 1]


def test_wanted_urls_of_an_item(spark, folder):
    for item, first in (("i", 0), ("j", 10_000), ("k", 20_000)):
        index(folder, item, "\n".join([HEADER] + [row(f"http://h/ü{n}", first + n) for n in range(3000)]) + "\n")
    asked = [(f"{folder}/{item}", f"http://h/ü{n}") for item in "ij" for n in range(0, 3000, 7)]
    rows = [*asked, *asked, (f"{folder}/i", None), (f"{folder}/other", "http://h/ü1")]
    wanted = spark.createDataFrame(rows, "item_dir string, url string")
    found = read_index(spark, folder, wanted)
    every = latest_captures(read_cdx(spark, folder)).join(wanted.distinct(), ["item_dir", "url"])
    some = latest_captures(found.lines).join(wanted.distinct(), ["item_dir", "url"])
    assert sorted(some.collect()) == sorted(every.collect()) and some.count() == len(asked)
    assert found.lines.count() < 1.1 * len(asked)
    assert usable_items(found.files).count() == 3


def test_indexes_of_several_members_and_blanks(spark, folder):
    index(folder, "i", "")
    text = "\n".join([HEADER] + [row(f"http://h/{n}", n) for n in range(100)]) + "\n"
    half = len(text) // 2
    data = gzip.compress(text[:half].encode()) + gzip.compress(text[half:].encode())
    data += gzip.compress(b" " * 20_000_000 + row("http://h/last", 7).encode())
    for item, body in (("i", data), ("zero", b""), ("tail", data + b"\0\1"), ("short", data[:-9])):
        os.makedirs(f"{folder}/{item}", exist_ok=True)
        with open(f"{folder}/{item}/{item}.cdx.gz", "wb") as file:
            file.write(body)
    found = read_index(spark, folder)
    intact = {os.path.basename(r["item_dir"]): r["intact"] for r in found.files.collect()}
    assert intact == {"i": True, "tail": False, "short": False} | ({"zero": False} if "zero" in intact else {})
    assert {r["item_dir"] for r in found.lines.collect()} == {f"{folder}/i"}
    assert found.lines.count() == 101
