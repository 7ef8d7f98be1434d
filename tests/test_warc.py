import gzip
import os

import pytest
from pyspark.sql import functions as F

from crawl_fixture import member, png, response
from crawlsift.functions.charset import decode_html
from crawlsift.operators.outcome import finished_archives, funnel_counts
from crawlsift.plans.text import read_pages, text_outcomes
from crawlsift.sources.fetch import fetch_records
from crawlsift.sources.listing import list_archives
from crawlsift.sources import warc
from crawlsift.streaming.feed import stream_warc
from crawlsift.sources.warc import find_record_start, iter_records, read_warc, split_archive


def write(path, *members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    offsets, at = [], 0
    with open(path, "wb") as file:
        for data in members:
            offsets.append(at)
            file.write(data)
            at += len(data)
    return offsets


def page(url, body, kind="text/html"):
    return response(url, kind, body)


BODY = b"<p>" + b"word " * 60 + b"</p>"


def test_fields(spark, folder):
    offsets = write(f"{folder}/a/a.warc.gz", page("http://h/1", BODY, "Text/HTML; charset=\"UTF-8\""))
    (row,) = read_warc(spark, folder).collect()
    assert row["archive"] == f"{folder}/a/a.warc.gz"
    assert row["record_offset"] == offsets[0]
    assert row["record_length"] == os.path.getsize(f"{folder}/a/a.warc.gz")
    assert row["content_type"] == 'text/html; charset="utf-8"'
    assert row["http_charset"] == "utf-8"
    assert row["content_length"] == len(BODY) and bytes(row["payload"]) == BODY
    assert row["block_length"] > row["content_length"]
    assert row["warc_headers"]["WARC-Type"] == "response"
    assert row["http_headers"]["Server"] == "test"


def test_odd_records(spark, folder):
    write(
        f"{folder}/x.warc.gz",
        member("metadata", "http://h/m", "application/warc-fields", b"a: b"),
        response("http://h/none", None, BODY),
        page("http://h/charset", BODY, "text/html; charset=klingon"),
        gzip.compress(b"not a record\r\n\r\n"),
        gzip.compress(b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        page("http://h/last", BODY),
    )
    rows = read_warc(spark, folder).orderBy("record_offset").collect()
    assert [r["has_headers"] for r in rows] == [True, True, True, False, True, True]
    assert [r["has_http_headers"] for r in rows] == [False, True, True, False, False, True]
    assert [r["content_type"] for r in rows][1] == "none"
    assert rows[2]["http_charset"] is None
    assert rows[0]["http_headers"] is None
    counts = {r["counter"]: r["n"] for r in funnel_counts(text_outcomes(read_pages(spark, folder))).collect()}
    assert counts == {
        "n_http_headers_none": 2,
        "n_wrong_content_type": 1,
        "n_record_headers_none": 1,
        "n_node_results": 2,
    }


def test_oversized_records_leave_no_trace(spark, folder):
    write(f"{folder}/x.warc.gz", page("http://h/1", BODY), page("http://h/2", BODY * 50), page("http://h/3", BODY))
    got = [r["target_uri"] for r in read_warc(spark, folder, max_content_length=1000).collect()]
    assert sorted(got) == ["http://h/1", "http://h/3"]


def test_several_records_in_one_member(spark, folder):
    plain = b"".join(gzip.decompress(page(f"http://h/{i}", BODY)) for i in range(5))
    write(f"{folder}/x.warc.gz", gzip.compress(plain), page("http://h/5", BODY))
    rows = read_warc(spark, folder).collect()
    assert sorted(r["target_uri"] for r in rows) == [f"http://h/{i}" for i in range(6)]
    assert {r["record_offset"] for r in rows if r["target_uri"] != "http://h/5"} == {0}


@pytest.mark.parametrize("split", [1, 100, 777, 5_000])
def test_splits_read_every_record_once(spark, folder, split):
    write(f"{folder}/x.warc.gz", *[page(f"http://h/{i}", os.urandom(150 + i)) for i in range(30)])
    if split == 1:
        # brute force without Spark: one range per byte
        path = f"{folder}/x.warc.gz"
        size = os.path.getsize(path)
        with open(path, "rb") as handle:
            starts = {find_record_start(handle, at, at + 1, size) for at in range(0, size, 1)}
        assert len(starts - {None}) == 30
        return
    rows = read_warc(spark, folder, split_bytes=split).collect()
    assert sorted(r["target_uri"] for r in rows) == sorted(f"http://h/{i}" for i in range(30))


def test_nested_archive_is_not_a_record_start(folder):
    inner = b"".join(page(f"http://inner/{i}", os.urandom(4_000)) for i in range(60))
    outer = [
        page("http://h/0", BODY),
        # level 0 stores the inner archive verbatim, so inner members look like outer ones
        gzip.compress(gzip.decompress(page("http://h/1", inner)), compresslevel=0),
        page("http://h/2", BODY),
    ]
    offsets = write(f"{folder}/x.warc.gz", *outer)
    size = os.path.getsize(f"{folder}/x.warc.gz")
    with open(f"{folder}/x.warc.gz", "rb") as handle:
        for start in range(offsets[1] + 1, offsets[2], 9_973):
            assert find_record_start(handle, start, size, size) == offsets[2]
        urls = [r["target_uri"] for r in iter_records(handle, 0, size, 10_000_000)]
    assert urls == ["http://h/0", "http://h/1", "http://h/2"]


def test_ranges_cover_the_file():
    for size, split in [(0, 10), (4, 10), (10, 10), (14, 10), (16, 10), (95, 10), (1, 1)]:
        ranges = split_archive(size, split)
        assert ranges[0][0] == 0 and ranges[-1][1] == size
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
        assert len(ranges) == 1 or ranges[-1][1] - ranges[-1][0] >= split / 2


def test_cut_archive_in_splits(spark, folder):
    pages = [page(f"http://h/{i}", os.urandom(300)) for i in range(40)]
    write(f"{folder}/x.warc.gz", *pages[:-1], pages[-1][:-50])
    for split in (2_000, 5_000):
        rows = read_warc(spark, folder, split_bytes=split)
        assert rows.filter("error is null").count() == 39
        assert rows.filter("error is not null").count() == 1


def test_truncated_archive_keeps_what_is_whole(spark, folder):
    write(f"{folder}/good.warc.gz", page("http://h/1", BODY))
    write(f"{folder}/empty.warc.gz", gzip.compress(b""))
    write(f"{folder}/bad.warc.gz", page("http://h/2", BODY), page("http://h/3", os.urandom(500))[:-40])
    rows = read_warc(spark, folder)
    assert sorted(r["target_uri"] for r in rows.filter("error is null").collect()) == ["http://h/1", "http://h/2"]
    assert rows.filter("error is not null").count() == 1
    (n,) = finished_archives(list_archives(spark, folder), rows).first()
    assert n == 2


def damaged(data, how):
    """A member with a wrong length in its header, a flipped bit, or bytes cut out."""
    if how == "length":
        return gzip.compress(gzip.decompress(data).replace(b"Content-Length: ", b"Content-Length: 9", 1))
    at = len(data) // 2
    return data[:at] + (bytes([data[at] ^ 4]) if how == "bit" else b"") + data[at + 1 + (how == "cut") * 20 :]


@pytest.mark.parametrize("how", ["length", "bit", "cut"])
def test_damage_costs_one_record_whatever_the_split(spark, folder, how):
    pages = [page(f"http://h/{i}", os.urandom(200 + 997 * (i % 5))) for i in range(60)]
    bad = {7, 8, 31, 59}
    write(f"{folder}/x.warc.gz", *[damaged(p, how) if i in bad else p for i, p in enumerate(pages)])
    good = sorted(f"http://h/{i}" for i in range(60) if i not in bad)
    errors = set()
    for split in (900, 5_000, 20_000, 1 << 28):
        rows = read_warc(spark, folder, split_bytes=split).collect()
        assert sorted(r["target_uri"] for r in rows if r["error"] is None) == good
        errors.add(tuple(sorted(r["record_offset"] for r in rows if r["error"] is not None)))
    assert len(errors) == 1 and 3 <= len(*errors) <= 4  # damage may run on into a damaged member
    stream = stream_warc(spark, folder, split_bytes=5_000)
    query = stream.writeStream.format("memory").queryName(f"damage_{how}").trigger(availableNow=True).start()
    query.awaitTermination()
    streamed = spark.table(f"damage_{how}").filter("error is null").collect()
    assert sorted(r["target_uri"] for r in streamed) == good


def test_line_ends(spark, folder):
    odd = "http://h/x\u2028y\u0085z\x0bq"
    plain = gzip.decompress(page(odd, BODY))
    unix = gzip.decompress(page("http://h/unix", b"a\r\n\r\nb" + BODY))
    head, _, block = unix.partition(b"\r\n\r\n")
    write(f"{folder}/x.warc.gz", gzip.compress(plain), gzip.compress(head.replace(b"\r\n", b"\n") + b"\n\n" + block))
    rows = {r["target_uri"]: r for r in read_warc(spark, folder).collect()}
    assert set(rows) == {odd, "http://h/unix"}
    assert bytes(rows["http://h/unix"]["payload"]) == b"a\r\n\r\nb" + BODY


def test_one_member_archive_needs_little_memory(folder):
    body = os.urandom(20_000)
    plain = b"".join(gzip.decompress(page(f"http://h/{i}", body)) for i in range(300))
    path = f"{folder}/x.warc.gz"
    write(path, gzip.compress(plain))
    peak = 0
    real = warc._Members.take

    def take(self, size):
        nonlocal peak
        data = real(self, size)
        peak = max(peak, len(self.out))
        return data

    warc._Members.take = take
    try:
        with open(path, "rb") as handle:
            assert sum(1 for _ in iter_records(handle, 0, os.path.getsize(path), 1 << 30)) == 300
    finally:
        warc._Members.take = real
    assert peak < 1 << 17


def test_long_header_block(spark, folder):
    long = b"X-Long: " + b"y" * (3 << 20) + b"\r\n"
    plain = gzip.decompress(page("http://h/long", BODY))
    first, _, rest = plain.partition(b"\r\n")
    write(f"{folder}/x.warc.gz", gzip.compress(first + b"\r\n" + long + rest), page("http://h/2", BODY))
    rows = read_warc(spark, folder).collect()
    assert {r["target_uri"] for r in rows} == {"http://h/long", "http://h/2"} and all(r["has_headers"] for r in rows)


def test_payload_and_column_choice(spark, folder):
    write(f"{folder}/x.warc.gz", page("http://h/1", BODY), response("http://h/2", "image/png", png(2, 2, (1, 2, 3))))
    rows = read_warc(spark, folder, payload=["image/"], columns=["target_uri", "payload"]).collect()
    assert {r["target_uri"]: r["payload"] is None for r in rows} == {"http://h/1": True, "http://h/2": False}
    assert read_warc(spark, folder, columns=["target_uri"]).columns == ["target_uri"]
    assert "payload" not in read_warc(spark, folder, payload=False).columns
    with pytest.raises(Exception, match="no such record columns"):
        read_warc(spark, folder, columns=["nope"]).collect()


def test_decode(spark):
    meta = "<meta http-equiv=x content='text/html; charset=ISO-8859-2'>ž".encode("iso-8859-2")
    rows = [
        ("é".encode(), None, "é"),
        ("é".encode("latin-1"), None, "é"),
        ("é€".encode("cp1252"), "cp1252", "é€"),
        (meta, None, meta.decode("iso-8859-2")),
        ("日本".encode("shift_jis"), "shift_jis", "日本"),
        (b"a\xffb", "utf-8", "a�b"),
        (b"x", "no-such-charset", None),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "p binary, c string, want string")
    for row in df.select(decode_html(F.col("p"), F.col("c")).alias("got"), "want").collect():
        assert row["got"] == row["want"]


def test_fetch_modes_agree(spark, folder):
    path = f"{folder}/x.warc.gz"
    offsets = write(path, *[page(f"http://h/{i}", os.urandom(200)) for i in range(8)])
    refs = spark.createDataFrame(
        [(path, offsets[i]) for i in (5, 1, 5, 5, 7)] + [(path, offsets[2] + 3), (path, 10**9), (f"{folder}/no.warc.gz", 0)],
        "warc_path string, offset long",
    )
    ranged = fetch_records(refs, mode="range")
    scanned = fetch_records(refs, mode="scan", roots=folder)
    good = [sorted((r["offset"], r["target_uri"], bytes(r["payload"])) for r in d.filter("error is null").collect()) for d in (ranged, scanned)]
    assert good[0] == good[1] and len(good[0]) == 3
    assert ranged.filter("error is not null").count() == scanned.filter("error is not null").count() == 3
    named = refs.withColumn("n", F.monotonically_increasing_id())
    kept = [fetch_records(named, mode=m, roots=folder, keep=["n"], tasks=3) for m in ("range", "scan")]
    rows = [sorted((r["n"], r["target_uri"] or "", r["error"] is None) for r in d.collect()) for d in kept]
    assert rows[0] == rows[1] and len(rows[0]) == 8 and sum(ok for *_, ok in rows[0]) == 5
    with pytest.raises(ValueError):
        fetch_records(refs, mode="scan")
    with pytest.raises(ValueError):
        fetch_records(refs, mode="other")


def test_a_storage_failure_fails_the_task(spark, folder):
    os.makedirs(f"{folder}/x.warc.gz")  # opening a directory is an OSError, but not a missing file
    refs = spark.createDataFrame([(f"{folder}/x.warc.gz", 0)], "warc_path string, offset long")
    for mode in ("range", "scan"):
        with pytest.raises(Exception, match="OSError|IsADirectory|directory"):
            fetch_records(refs, mode=mode, roots=folder).collect()


def test_scan_shuffles_references_only(spark, folder):
    write(f"{folder}/x.warc.gz", page("http://h/1", BODY))
    refs = spark.createDataFrame([(f"{folder}/x.warc.gz", 0)], "warc_path string, offset long")
    plan = fetch_records(refs, mode="scan", roots=folder)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow") + 1 :]
    assert "payload" not in below[below.index("\n") :] and "Join" not in plan


def test_listing(spark, folder):
    write(f"{folder}/a/x y+z%20.warc.gz", page("http://h/1", BODY))
    write(f"{folder}/b/n.txt", b"x")
    write(f"{folder}/c/_temporary/t.warc.gz", b"")
    names = [r["path"] for r in list_archives(spark, [f"{folder}/a", f"{folder}/b"]).collect()]
    assert names == [f"{folder}/a/x y+z%20.warc.gz"]
    assert [r["archive"] for r in read_warc(spark, folder).collect()] == names


def test_declared_and_marked_charsets(spark):
    late = b"<!-- " + b"x" * 9000 + b" --><META name=a content=b><meta data-x='" + b"y" * 900 + b"' charset = 'iso-8859-2'>" + "ž".encode("iso-8859-2")
    rows = [
        (late, "ž"),
        ("é".encode("utf-16"), "é"),
        (b"\xfe\xff" + "é".encode("utf-16-be"), "é"),
        ("é".encode("utf-32"), "é"),
        ("é".encode("utf-8-sig"), "é"),
        (b"<meta " * 300_000 + b"\xe9", "é"),
    ]
    df = spark.createDataFrame(rows, "p binary, want string")
    for row in df.select(decode_html(F.col("p"), F.lit(None).cast("string")).alias("got"), "want").collect():
        assert row["got"].endswith(row["want"])


@pytest.mark.parametrize("where", [30, 4_000, -12, "cut"])
def test_archive_nested_in_a_damaged_member(spark, folder, where):
    inner = b"".join(page(f"http://inner/{i}", os.urandom(3_000)) for i in range(3))
    outer = bytearray(gzip.compress(gzip.decompress(page("http://h/outer", inner)), compresslevel=0))
    if where == "cut":
        del outer[5_000:5_020]  # in the second inner record
    else:
        outer[where] ^= 4  # before the inner archive, in its second record, or behind it
    pages = [page(f"http://h/{i}", BODY) for i in range(4)]
    write(f"{folder}/x.warc.gz", pages[0], bytes(outer), pages[1], damaged(page("http://h/bad", os.urandom(900)), "bit"), *pages[2:])
    for split in (1 << 28, 2_000):
        rows = read_warc(spark, folder, split_bytes=split).collect()
        assert sorted(r["target_uri"] for r in rows if r["error"] is None) == [f"http://h/{i}" for i in range(4)]
        assert sum(r["error"] is not None for r in rows) == 2


@pytest.mark.parametrize("length", [b"-5", b"+5", b"1_0", b"x", b"", b"5 5"])
def test_a_length_that_is_no_number_is_damage(spark, folder, length):
    plain = gzip.decompress(page("http://h/odd", BODY))
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = [b"Content-Length: " + length if x.startswith(b"Content-Length") else x for x in head.split(b"\r\n")]
    write(f"{folder}/x.warc.gz", page("http://h/1", BODY), gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + rest), page("http://h/2", BODY))
    rows = read_warc(spark, folder).collect()
    assert sorted((r["target_uri"] or "", r["error"] is None) for r in rows) == [("", False), ("http://h/1", True), ("http://h/2", True)]


FILTERS = [
    "warc_type = 'response'",
    "warc_type in ('metadata', 'request')",
    "content_length >= 200 and content_length < 400",
    "block_length <= 300",
    "content_type like 'text/html%'",
    "target_uri is not null and warc_type = 'response' and content_type = 'image/png'",
    "target_uri like 'http://h/%' and content_length > 100",
    "has_http_headers = false",
    "error is not null or content_length > 0",
    "content_type is null",
    "length(payload) > 300 and warc_type = 'response'",
]


def test_pushed_filters_change_no_row(spark, folder):
    plain = b"".join(gzip.decompress(page(f"http://m/{i}", BODY * i)) for i in range(4))
    write(
        f"{folder}/x.warc.gz",
        *[page(f"http://h/{i}", b"y" * 97 * i) for i in range(8)],
        member("metadata", "http://h/m", "application/warc-fields", b"a: b" * 70),
        member("request", "http://h/q", "application/http; msgtype=request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n"),
        member("response", "http://h/headless", "application/http", b"no blank line at all" * 20),
        response("http://h/p", "image/png", png(9, 9, (1, 2, 3))),
        gzip.compress(b"not a record\r\n\r\n"),
        gzip.compress(plain),
        gzip.compress(b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
        damaged(page("http://h/bad", os.urandom(700)), "bit"),
        damaged(page("http://h/long", os.urandom(700)), "length"),
        page("http://h/last", BODY),
    )
    for wanted in FILTERS:
        seen = []
        for push in (True, False):
            rows = read_warc(spark, folder, push_filters=push).filter(wanted)
            seen.append(sorted(repr(r) for r in rows.collect()))
            plan = rows._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")
            if wanted == FILTERS[0]:
                assert ("Filter" in plan) != push, plan  # pushed down: Spark filters no more
        assert seen[0] == seen[1] and seen[0], wanted


def test_rejected_blocks_are_not_held(folder):
    path = f"{folder}/x.warc.gz"
    write(path, *[page(f"http://h/{i}", os.urandom(200_000)) for i in range(5)], member("metadata", "http://h/m", "application/warc-fields", b"a: b"))
    taken = []
    real = warc._Members.take
    warc._Members.take = lambda self, size: taken.append(size) or real(self, size)
    try:
        with open(path, "rb") as handle:
            tests = {"warc_type": [lambda x: x == "metadata"]}
            rows = list(iter_records(handle, 0, os.path.getsize(path), 1 << 30, tests=tests))
    finally:
        warc._Members.take = real
    assert [r["target_uri"] for r in rows] == ["http://h/m"] and max(taken) < 1000


def test_small_ranges_share_partitions(spark, folder):
    """Each had a task of its own."""
    parts = warc.pack_ranges([(str(i), 40_000) for i in range(2000)], 4_000, 8)
    assert 8 <= len(parts) <= 20_000 // 50
    assert [(r.path, r.start, r.end) for p in parts for r in p.ranges] == [(str(i), a, a + 4000) for i in range(2000) for a in range(0, 40_000, 4000)]
    urls = [f"http://h/{i}" for i in range(40)]
    bad = bytearray(page(urls[20], BODY))
    bad[len(bad) // 2] ^= 4
    path = f"{folder}/a.warc.gz"
    write(path, b"".join(bytes(bad) if u == urls[20] else page(u, BODY) for u in urls))
    for split in (60, 150, 1000, 1 << 20):
        rows = warc.read_warc(spark, folder, columns=["target_uri", "error"], split_bytes=split).collect()
        assert sorted(r.target_uri for r in rows if r.target_uri) == sorted(set(urls) - {urls[20]}), split
        assert [bool(r.error) for r in rows].count(True) == 1


def test_small_archives_share_partitions(spark, folder):
    names = [(f"{folder}/{i:05d}.warc.gz", 10_000) for i in range(10_000)]
    parts = warc.pack_ranges(names, 256 << 20, 8)
    assert 10 <= len(parts) < 100
    assert [r.path for p in parts for r in p.ranges] == [path for path, _ in names]
    mixed = warc.pack_ranges([("a", 5), ("b", 900 << 20), ("c", 7)], 256 << 20, 1)
    assert [[(r.path, r.start) for r in p.ranges] for p in mixed] == [[("b", i * (256 << 20))] for i in range(4)] + [[("a", 0), ("c", 0)]]
    assert warc.pack_ranges([], 1, 1) == []
    for i in range(300):
        write(f"{folder}/{i % 7}/{i}.warc.gz", page(f"http://h/{i}", BODY))
    rows = read_warc(spark, folder)
    assert rows.rdd.getNumPartitions() <= 8
    assert sorted(int(r["target_uri"][9:]) for r in rows.collect()) == list(range(300))


def test_marks_tell_what_was_read(spark, folder):
    write(f"{folder}/x.warc.gz", *[page(f"http://h/{i}", os.urandom(300)) for i in range(20)], damaged(page("http://h/b", os.urandom(300)), "bit"), page("http://h/c", BODY))
    size = os.path.getsize(f"{folder}/x.warc.gz")
    rows = spark.read.format("warc").options(path=folder, marks="true", splitBytes="1000", columns="target_uri").load()
    marks = rows.filter("range_end is not null").orderBy("range_start").collect()
    assert [m["range_start"] for m in marks] + [size] == [0] + [m["range_end"] for m in marks] and len(marks) > 3
    assert {m["archive_length"] for m in marks} == {size}
    assert sum(m["range_records"] for m in marks) == 21 and sum(m["range_errors"] for m in marks) == 1
    assert rows.filter("range_end is null and target_uri is not null").count() == 21


def test_neighbouring_references_share_reads(folder, monkeypatch):
    import pyarrow as pa
    import pyarrow.fs as pafs
    from pyspark.sql import types as T

    from crawlsift.sources import fetch

    path = f"{folder}/x.warc.gz"
    offsets = write(path, *[page(f"http://h/{i}", os.urandom(700)) for i in range(400)], page("http://h/long", os.urandom(900_000)), page("http://h/end", BODY))
    reads = []

    class Counted:
        def __init__(self):
            self.file = open(path, "rb")
            self.seek, self.close = self.file.seek, self.file.close

        def size(self):
            return os.path.getsize(path)

        def read(self, size):
            reads.append(size)
            return self.file.read(size)

    monkeypatch.setattr(fetch, "open_fs", lambda p: (type("F", (), {"open_input_file": lambda self, inner: Counted()})(), p))
    schema = T.StructType([T.StructField("warc_path", T.StringType()), T.StructField("offset", T.LongType()), *[f for f in warc.RECORD_SCHEMA if f.name in fetch.FETCHED_COLUMNS]])
    wanted = [*offsets[::2], offsets[401], offsets[3] + 1]
    wanted.sort()
    batch = pa.RecordBatch.from_pydict({"warc_path": [path] * len(wanted), "offset": wanted})
    rows = [r for b in fetch._ranged_reader(1 << 30, schema, [])(iter([batch])) for r in b.to_pylist()]
    good = {r["offset"]: r["target_uri"] for r in rows if r["error"] is None}
    assert good == {o: f"http://h/{i}" for i, o in enumerate(offsets) if i % 2 == 0 and i < 400} | {offsets[400]: "http://h/long", offsets[401]: "http://h/end"}
    assert len(rows) == len(wanted) and [r["offset"] for r in rows if r["error"]] == [offsets[3] + 1]
    assert len(reads) < 30  # 203 references; the long record and the end take reads of their own
    far = [{"warc_path": p, "offset": o} for p, o in [("a", 0), ("a", 10), ("a", 10**6), ("b", 10**6 + 5), ("b", None)]]
    assert [len(g) for g in fetch.plan_reads(far)] == [2, 1, 1, 1] and list(fetch.plan_reads([])) == []
