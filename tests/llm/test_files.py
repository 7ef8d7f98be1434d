"""Packed token ids and archives: exact round trips."""

import gzip
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from crawlsift.llm import arc, packing
from crawlsift.llm.queries import TOKENIZER


def plain_best_fit(lengths, seq_len):
    rooms, rows = [], []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in range(len(rooms)) if rooms[r] >= lengths[piece]]
        if fits:
            row = min(fits, key=lambda r: rooms[r])
        else:
            row = len(rooms)
            rooms.append(seq_len)
            rows.append([])
        rooms[row] -= lengths[piece]
        rows[row].append(piece)
    return rooms, rows


def test_best_fit_is_the_plain_one():
    rng = np.random.default_rng(0)
    for seq_len in (1, 7, 64, 100):
        lengths = rng.integers(1, seq_len + 1, 300).tolist()
        got = packing.best_fit(lengths, seq_len)
        assert sorted(p for row in got for p in row) == list(range(300))
        filled = sorted(seq_len - sum(lengths[p] for p in row) for row in got)
        assert filled == sorted(plain_best_fit(lengths, seq_len)[0]) and filled[0] >= 0
    assert packing.best_fit([], 8) == []


def segments(rows):
    out = {}
    for r in rows:
        assert r.position_resets == r.cu_seqlens[:-1] and len(r.doc_ids) == len(r.cu_seqlens) - 1
        for a, b, doc, at in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.doc_offsets):
            out.setdefault(doc, []).append((at, r.input_ids[a:b]))
    return out


def test_round_trip(documents, texts):
    tokenizer = packing.Tokenizer.load(TOKENIZER)
    rows = packing.packed(documents, tokenizer, seq_len=256, shard_ids=20_000).collect()
    encode = tokenizer.open()
    found = {d: [i for _, part in sorted(v) for i in part] for d, v in segments(rows).items()}
    assert found == {d: encode(t).tolist() for d, t in texts.items() if t}
    used = sum(r.cu_seqlens[-1] for r in rows)
    assert used / (256 * len(rows)) > 0.98
    assert all(set(r.input_ids[r.cu_seqlens[-1] :]) <= {packing.PAD_ID} for r in rows)
    assert len({(r.shard, r.row) for r in rows}) == len(rows)


def test_shard_arrays():
    docs = [(1, np.arange(10, dtype=np.uint32)), (None, np.arange(3, dtype=np.uint32)), (2, np.arange(70_000, 70_002, dtype=np.uint32))]
    shard = packing.pack(docs, 4, 9)
    assert shard["ids"].dtype == np.uint32 and shard["ids"].shape == (4, 4)
    positions = packing.position_ids(shard)
    for n in range(4):
        ends = shard["cu_seqlens"][shard["row_splits"][n] : shard["row_splits"][n + 1]]
        for a, b in zip(ends, ends[1:]):
            assert positions[n, a:b].tolist() == list(range(b - a))
    assert packing.pack(docs[:1], 4, 9)["ids"].dtype == np.uint16
    assert dict(np.load(io.BytesIO(b) if (b := _saved(shard)) else None))["ids"].tolist() == shard["ids"].tolist()


def _saved(shard):
    out = io.BytesIO()
    np.savez(out, **shard)
    return out.getvalue()


def test_packing_odd_rows(odd_docs, no_docs):
    tokenizer = packing.Tokenizer.load(TOKENIZER)
    rows = packing.packed(odd_docs, tokenizer, seq_len=128).collect()
    found = segments(rows)
    assert set(found) == {1, 2, None, 5, 6, 7, 8, 9, 10}
    assert sum(len(p) for _, p in found[7]) == len(tokenizer.open()(odd_docs.where("doc_id = 7").first().text))
    assert packing.packed(no_docs, tokenizer).collect() == []


PAGES = [
    (1, "http://a/x y", "p" * 200), (2, "http://b/", "p" * 200), (3, None, None), (4, "", "small"), (5, "no scheme", "small"),
    (9, "http://c/\n", "é" * 60), (7, "http://d/", "é" * 60), (7, "http://d/", "é" * 60), (None, "http://e/", "p" * 200),
]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, digest int")
    rows = arc.archived_pages(pages).collect()
    assert len(rows) == len(PAGES)
    got = sorted(((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in rows), key=str)
    expected = [
        (1, 200, "response", None), (2, 200, "revisit", 1), (-1, 200, "revisit", 1), (3, 0, "response", None), (4, 5, "response", None),
        (5, 5, "response", None), (7, 120, "response", None), (7, 120, "revisit", 7), (9, 120, "revisit", 7),
    ]
    assert got == sorted(expected, key=str)
    assert arc.archived_pages(pages.limit(0)).collect() == []


def archive(version, records, packed=True, name="old.arc"):
    parts = [arc._version_block(name, version)]
    for url, mime, block in records:
        fields = [url, "10.0.0.1", "20010203040506", mime] + (["200", "-", "-", "0", name] if version == 2 else [])
        parts.append(f"{' '.join(fields)} {len(block)}\n".encode() + block + b"\n")
    return b"".join(map(gzip.compress, parts)) if packed else b"".join(parts)


HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\n"
RECORDS = [("http://a/b c", "text/plain", HTTP + b"body\n\nhttp://not/a record 1 2 3 4\n"), ("dns:a", "text/dns", b"a. IN A 10.0.0.1"), ("http://e/", "text/html", b"")]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [True, False])
def test_parsing_versions(version, packed):
    data = archive(version, RECORDS, packed)
    for raw in (data, gzip.compress(data)) if not packed else (data,):
        got = list(arc.iter_arc(io.BytesIO(raw)))
        assert [(r.url, r.mime, r.block) for r in got[1:]] == RECORDS
        assert got[0].url == "filedesc://old.arc" and {r.date for r in got[1:]} == {"2001-02-03T04:05:06Z"}
        assert got[1].payload == b"body\n\nhttp://not/a record 1 2 3 4\n" and got[2].header_end == 0


def test_damage_is_passed_over():
    first, second = archive(1, RECORDS[:1], False), archive(1, RECORDS[1:], False)
    body = second[len(arc._version_block("old.arc", 1)) :]
    got = list(arc.iter_arc(io.BytesIO(first + b"garbage line\nhttp://x 1 2 3 nonumber\n" + body)))
    assert [r.url for r in got[1:]] == ["http://a/b c", "dns:a", "http://e/"]
    assert got[2].skipped == len(b"garbage line\nhttp://x 1 2 3 nonumber\n")
    assert [r.url for r in arc.iter_arc(io.BytesIO((first + body)[:-25]))][-1] in ("http://a/b c", "dns:a")
    assert list(arc.iter_arc(io.BytesIO(b""))) == []
    cut = archive(1, RECORDS)[:-30]
    assert len(list(arc.iter_arc(io.BytesIO(cut)))) >= 2


def test_warc_records():
    records = list(arc.iter_arc(io.BytesIO(archive(1, RECORDS))))
    texts = [gzip.decompress(arc.warc_record("old.arc", r, None)) for r in records]
    assert [t.split(b"\r\n")[1] for t in texts] == [b"WARC-Type: warcinfo", b"WARC-Type: response", b"WARC-Type: resource", b"WARC-Type: resource"]
    assert b"WARC-Date: 2001-02-03T04:05:06Z" in texts[1] and b"WARC-IP-Address: 10.0.0.1" in texts[1]
    assert texts[1].endswith(RECORDS[0][2] + b"\r\n\r\n") and arc.record_id("a", 1) != arc.record_id("a", 2)
    revisit = gzip.decompress(arc.warc_record("old.arc", records[1], ("<id>", "http://z", "2000-01-01T00:00:00Z")))
    assert b"WARC-Type: revisit" in revisit and revisit.endswith(HTTP + b"\r\n\r\n") and b"WARC-Refers-To: <id>" in revisit


def test_dates():
    assert arc._date(b"1999", "x") == "1999-01-01T00:00:00Z"
    assert arc._date(b"19991332000000", "x") == "x" and arc._date(b"", "x") == "x"


def test_ids_near_both_ends_of_long(spark):
    top, low = (1 << 63) - 1, -(1 << 63)
    ids = [top, low, 10**18, top - 1, low + 1, -(10**18), None, 3]
    # Written in an order in which neither the first nor the last has the smallest id.
    rows = [(i, f"http://x/{n}", ("ab"[n % 2] if i != 3 else "c") * 150) for n, i in enumerate(ids)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in arc.archived_pages(pages).collect()}
    even, odd = min(i for i in ids[::2] if i is not None), low
    expected = {i: ("revisit", odd if n % 2 else even) for n, i in enumerate(ids)}
    expected |= {even: ("response", None), odd: ("response", None), 3: ("response", None)}
    assert got == expected
    assert arc.long_key(str(top)) == top and arc.long_key(str(low)) == low
    assert arc.long_key(str(top + 1)) is None and arc.long_key(str(low - 1)) is None and arc.long_key("1x") is None


@pytest.mark.parametrize("blank", [" ", "\t", "\n", " \n", "\u3000"])
def test_long_blank_runs(blank, monkeypatch):
    from tokenizers import Tokenizer

    from crawlsift.llm.queries import BYTE_LEVEL

    library = Tokenizer.from_file(BYTE_LEVEL)
    tokenizer = packing.Tokenizer.load(TOKENIZER)
    for n in (20, 30, 50):
        for text in (blank * n, blank * n + "x", "a" + blank * n + " b", "a " + blank * n + "\x1c 1" + blank * n):
            monkeypatch.setattr(packing, "BLANK_RUN", 30)
            assert tokenizer.open()(text).tolist() == library.encode(text, add_special_tokens=False).ids
    monkeypatch.undo()
    encode = tokenizer.open()
    for n in (900_000, 1_000_000, 5_000_000):
        ids = encode("a" + blank * (n // len(blank)) + "x")
        assert len(ids) and ids[-1] in encode("x b x" + blank + "x")


def test_one_blank_document_does_not_stop_the_rest(spark):
    docs = spark.createDataFrame([(1, " " * 1_200_000 + "x"), (2, "y")], "doc_id long, text string")
    found = segments(packing.packed(docs, packing.Tokenizer.load(TOKENIZER)).collect())
    assert set(found) == {1, 2}


def test_archives_of_one_stem_and_one_task_each(spark, folder):
    import os

    os.makedirs(f"{folder}/arc")
    for n in range(12):
        with open(f"{folder}/arc/x{n}.arc.gz", "wb") as file:
            file.write(archive(1, RECORDS, name=f"x{n}.arc"))
    with open(f"{folder}/arc/x0.arc", "wb") as file:
        file.write(archive(1, RECORDS[:1], False, name="x0.arc"))
    index = arc.arc_index(spark, f"{folder}/arc")
    assert index.count() == 12 * 3 + 1
    assert index.groupBy(F.spark_partition_id()).count().count() > 6
    done = arc.convert_arcs(spark, f"{folder}/arc", f"{folder}/warc").collect()
    assert len({r.warc for r in done}) == 13 == len(os.listdir(f"{folder}/warc")) and sum(r.records for r in done) == 12 * 4 + 2


def test_long_pages_and_other_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/", "é" * 3_000_000, "x"), (2, "http://b/", None, "y")], "page_id long, url string, html string, record_type string")
    got = {r.page_id: r.payload_bytes for r in arc.archived_pages(pages).collect()}
    assert got == {1: 6_000_000, 2: 0}
