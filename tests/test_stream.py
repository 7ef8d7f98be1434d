import json
import os
import time

import pytest
from pyspark.sql import functions as F

from checks import queries
from crawl_fixture import png, response
from crawlsift.operators.filters import IMAGE_TYPES
from crawlsift.operators.outcome import finished_archives, funnel_counts
from crawlsift.operators.score import score_passthrough
from crawlsift.plans.image import image_rows, read_images
from crawlsift.plans.text import html_only, read_pages, text_outcomes
from crawlsift.sinks.stats import report_stream
from crawlsift.sources.warc import SLIM_COLUMNS
from crawlsift.sources.listing import list_archives
from crawlsift.streaming.feed import finish, finished_archives_of, funnel_snapshots, stream_dataset, stream_warc

BODY = b"<p>" + b"word " * 60 + b"</p>"


def archive(folder, name, urls):
    path = f"{folder}/in/{name}.warc.gz"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path + ".part", "wb") as file:
        for url in urls:
            file.write(response(url, "text/html", BODY))
    os.rename(path + ".part", path)


def run(spark, folder, cap=1):
    stream = stream_warc(spark, f"{folder}/in", max_files_per_trigger=cap, columns=["target_uri"])
    query = stream_dataset(stream, f"{folder}/out", f"{folder}/check")
    query.awaitTermination()
    return query, sorted(r[0] for r in spark.read.parquet(f"{folder}/out").collect())


def test_each_archive_once_whatever_its_name(spark, folder):
    archive(folder, "m1", ["http://h/1", "http://h/2"])
    archive(folder, "m2", ["http://h/3"])
    archive(folder, "m3", ["http://h/4"])
    query, rows = run(spark, folder)
    assert rows == ["http://h/1", "http://h/2", "http://h/3", "http://h/4"]
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) >= 3
    archive(folder, "a0", ["http://h/0"])  # sorts before the others
    assert run(spark, folder)[1] == [f"http://h/{i}" for i in range(5)]


def test_snapshots_equal_batch(spark, folder):
    for i in range(4):
        archive(folder, f"x{i}", [f"http://h/{i}-{j}" for j in range(i)])
    stream = stream_warc(spark, f"{folder}/in", max_files_per_trigger=1, payload=["text/html"], columns=SLIM_COLUMNS)
    query = funnel_snapshots(
        text_outcomes(stream), f"{folder}/check", json_file=f"{folder}/stats/stats.json", table_dir=f"{folder}/table", console=True
    )
    query.awaitTermination()
    batch = {r["counter"]: r["n"] for r in funnel_counts(text_outcomes(read_pages(spark, f"{folder}/in"))).collect()}
    assert batch == {"n_node_results": 6}
    assert {r["counter"]: r["n"] for r in spark.read.parquet(f"{folder}/table").collect()} == batch
    with open(f"{folder}/stats/stats.json") as file:
        assert json.load(file) == batch


def test_totals_keep_their_state_in_few_files(spark, folder):
    archive(folder, "x", ["http://h/1"])
    stream = stream_warc(spark, f"{folder}/in", payload=["text/html"], columns=SLIM_COLUMNS)
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        funnel_snapshots(text_outcomes(stream), f"{folder}/check", table_dir=f"{folder}/table").awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "60"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    parts = [name for name in os.listdir(f"{folder}/check/state/0") if name.isdigit()]
    assert len(parts) == 2 * spark.sparkContext.defaultParallelism


def test_streams_of_the_crawl_take_a_bounded_number_of_batches(spark, monkeypatch):
    for n, a_batch in ((3, 16), (192, 16), (6000, 500), (6001, 501)):
        monkeypatch.setattr(queries, "list_archives", lambda *_, n=n: spark.range(n))
        monkeypatch.setattr(queries, "crawl", lambda *_: "")
        assert queries._archives_a_batch.__wrapped__(spark, "") == a_batch


def test_console_report(spark, folder):
    archive(folder, "x", ["http://h/1"])
    stream = stream_warc(spark, f"{folder}/in", columns=["target_uri"])
    scored = score_passthrough(stream.withColumnRenamed("target_uri", "url"))
    query = report_stream(scored, checkpoint=f"{folder}/check")
    query.awaitTermination()
    assert query.exception() is None


def test_interval_trigger(spark, folder):
    archive(folder, "x", ["http://h/1"])
    stream = stream_warc(spark, f"{folder}/in", payload=["text/html"], columns=SLIM_COLUMNS)
    query = stream_dataset(html_only(stream).select("target_uri", "html"), f"{folder}/out", f"{folder}/check", "1 second")
    try:
        deadline = time.time() + 60
        while not query.recentProgress and time.time() < deadline:
            time.sleep(0.2)
        query.processAllAvailable()
        assert spark.read.parquet(f"{folder}/out").count() == 1
    finally:
        query.stop()


def test_images_of_a_stream_are_those_of_a_batch(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.warc.gz", "wb") as file:
        for i in range(6):
            file.write(response(f"http://h/{i}.png", "image/png", png(3 + i, 5, (i, 2, 3))))
        file.write(response("http://h/bad.png", "image/png", b"no image " * 30))
    columns = ["url", "image"]
    stream = image_rows(stream_warc(spark, f"{folder}/in", payload=list(IMAGE_TYPES), columns=SLIM_COLUMNS))
    query = (
        stream.select(*columns).writeStream.format("memory").queryName("streamed_images").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    streamed = spark.table("streamed_images").orderBy("url").collect()
    batch = image_rows(read_images(spark, f"{folder}/in")).select(*columns).orderBy("url").collect()
    assert streamed == batch and len(batch) == 6


def byte_stream(spark, folder, cap, **options):
    return stream_warc(spark, f"{folder}/in", log=f"{folder}/log", max_bytes_per_trigger=cap, marks=True, **options)


def batches_of(query):
    return [p for p in query.recentProgress if p["numInputRows"] > 0]


def test_one_archive_over_several_batches_and_a_restart(spark, folder):
    urls = [f"http://h/{i}" for i in range(60)]
    archive(folder, "big", urls)
    size = os.path.getsize(f"{folder}/in/big.warc.gz")
    cap = size // 6
    stream = byte_stream(spark, folder, cap, columns=["target_uri"], split_bytes=cap // 3)
    first = stream_dataset(stream, f"{folder}/out", f"{folder}/check")  # takes one batch
    first.awaitTermination()
    read = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    assert 0 < read.filter("range_end is null").count() < 60
    assert read.agg({"range_end": "max"}).first()[0] == cap
    archive(folder, "a", ["http://h/60"])  # sorts before the other, found after it
    second = finish(stream_dataset(stream, f"{folder}/out", f"{folder}/check", "0 seconds"))
    assert len(batches_of(second)) >= 5
    rows = spark.read.schema(stream.schema).parquet(f"{folder}/out")
    assert sorted(r.target_uri for r in rows.filter("range_end is null").collect()) == sorted([*urls, "http://h/60"])
    marks = rows.filter("range_end is not null").groupBy("archive").agg(F.sum("range_records").alias("n")).collect()
    assert sorted(m.n for m in marks) == [1, 60]
    with open(f"{folder}/check/offsets/0") as file:
        assert json.loads(file.read().splitlines()[-1]) == {"archive": 0, "byte": cap}
    archive(folder, "0", ["http://h/61"])
    third = finish(stream_dataset(stream, f"{folder}/out", f"{folder}/check", "0 seconds"))
    assert len(batches_of(third)) == 1
    assert spark.read.schema(stream.schema).parquet(f"{folder}/out").filter("range_end is null").count() == 62


def test_a_batch_that_was_not_committed_is_read_again(spark, folder):
    archive(folder, "x", [f"http://h/{i}" for i in range(30)])
    stream = byte_stream(spark, folder, os.path.getsize(f"{folder}/in/x.warc.gz") // 3, columns=["target_uri"])
    seen = []

    def fail_once(batch, number):
        rows = [r.target_uri for r in batch.filter("range_end is null").collect()]
        if number == 1 and not any(n == 1 for n, _ in seen):
            seen.append((1, None))
            raise RuntimeError("lost")
        seen.append((number, rows))

    def start():
        return stream.writeStream.foreachBatch(fail_once).option("checkpointLocation", f"{folder}/check").trigger(processingTime="0 seconds").start()

    query = start()
    with pytest.raises(Exception, match="lost"):
        query.processAllAvailable()
    finish(start())
    urls = [u for _, rows in seen if rows for u in rows]
    assert sorted(urls) == sorted(f"http://h/{i}" for i in range(30)) and len({n for n, r in seen if r}) >= 3


def test_finished_archives_over_batches(spark, folder):
    archive(folder, "a", [f"http://h/{i}" for i in range(25)])
    archive(folder, "b", ["http://h/x"])
    path = f"{folder}/in/c.warc.gz"
    bad = bytearray(response("http://h/bad", "text/html", os.urandom(400)))
    bad[len(bad) // 2] ^= 4
    with open(path, "wb") as file:
        file.write(b"".join(response(f"http://c/{i}", "text/html", BODY) for i in range(3)) + bytes(bad))
    cap = os.path.getsize(f"{folder}/in/a.warc.gz") // 3
    done = finished_archives_of(byte_stream(spark, folder, cap, columns=["archive"], split_bytes=cap // 2))
    query = finish(stream_dataset(done, f"{folder}/out", f"{folder}/check", "0 seconds"))
    assert len(batches_of(query)) >= 3
    rows = {r.archive.rsplit("/", 1)[1][0]: (r.n_records, r.n_errors, r.n_ranges > 2) for r in spark.read.schema(done.schema).parquet(f"{folder}/out").collect()}
    assert rows == {"a": (25, 0, True), "b": (1, 0, False), "c": (3, 1, False)}
    stream = byte_stream(spark, folder, cap, payload=["text/html"], columns=SLIM_COLUMNS, split_bytes=cap // 2)
    totals = finish(funnel_snapshots(text_outcomes(stream), f"{folder}/check2", table_dir=f"{folder}/table", interval="0 seconds", finished=True))
    assert totals.exception() is None
    counts = {r["counter"]: r["n"] for r in spark.read.parquet(f"{folder}/table").collect()}
    records = read_pages(spark, f"{folder}/in")
    batch = {r["counter"]: r["n"] for r in funnel_counts(text_outcomes(records)).collect()}
    assert counts == batch | finished_archives(list_archives(spark, f"{folder}/in"), records).first().asDict() and counts["n_finished_warc_files"] == 2


def test_ranges_out_of_order(spark, folder):
    """Ranges of one archive in two files of a stream of marks, the later range first."""
    schema = "archive string, range_start long, range_end long, archive_length long, range_records long, range_errors long"
    for n, rows in enumerate([[("x", 50, 100, 100, 2, 0), ("y", 0, 10, 10, 0, 0)], [("x", 0, 50, 100, 3, 1)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{folder}/marks/{n}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).json(f"{folder}/marks")
    query = stream_dataset(finished_archives_of(stream), f"{folder}/out", f"{folder}/check")
    query.awaitTermination()
    assert len(batches_of(query)) == 2
    got = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/out").collect())
    assert got == [("x", 2, 5, 1), ("y", 1, 0, 0)]


def test_archives_of_a_batch_use_many_tasks(spark, folder):
    for i in range(24):
        archive(folder, f"x{i}", [f"http://h/{i}"])
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    for log in (None, f"{folder}/log"):
        stream = stream_warc(spark, f"{folder}/in", columns=["target_uri"], log=log).withColumn("task", F.spark_partition_id())
        out = f"{folder}/out-{log is None}"
        stream_dataset(stream, out, f"{folder}/check-{log is None}").awaitTermination()
        rows = spark.read.parquet(out).collect()
        assert len(rows) == 24 and len({r.task for r in rows}) >= 4


def test_stream_options(spark, folder):
    with pytest.raises(ValueError, match="log"):
        stream_warc(spark, folder, max_bytes_per_trigger=1)
    stream = spark.readStream.format("warc").option("path", folder).load()
    query = stream.writeStream.format("memory").queryName("nolog").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="needs a log"):
        query.awaitTermination()
