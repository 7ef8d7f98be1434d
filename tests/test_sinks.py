"""Overwriting file outputs, and accounts of stored datasets."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.sinks.record_files import write_record_files
from crawlsift.sources.dataset import dataset_shards, read_dataset


def tree(folder):
    """Files below a folder by relative name, without the marker and hidden folders."""
    found = {}
    for at, folders, names in os.walk(folder):
        folders[:] = [f for f in folders if not f.startswith(".")]
        for name in names:
            if name != "_SUCCESS":
                path = os.path.join(at, name)
                found[os.path.relpath(path, folder)] = open(path, "rb").read()
    return found


def files(spark, *names, body="x"):
    return spark.createDataFrame([(n, body) for n in names], "name string, body string")


@F.udf(T.StringType())
def failing(name):
    if name.startswith("z"):
        raise ValueError("half-way")
    return "new"


def test_overwrite_takes_the_place_of_the_old_output(spark, folder):
    write_record_files(files(spark, "a/1", "a/2", "b", body="old"), folder)
    assert tree(folder) == {n: b"old" for n in ("a/1", "a/2", "b")}
    write_record_files(files(spark, "a/1", "c", body="new"), folder, mode="overwrite")
    assert tree(folder) == {"a/1": b"new", "c": b"new"}
    write_record_files(files(spark, "d", body="more"), folder)
    assert set(tree(folder)) == {"a/1", "c", "d"}
    write_record_files(files(spark, "a").limit(0), folder, mode="overwrite")
    assert tree(folder) == {} and "_SUCCESS" in os.listdir(folder)


def test_a_job_that_fails_leaves_the_old_output(spark, folder):
    write_record_files(files(spark, "a/1", "z", body="old"), folder)
    odd = files(spark, "a/1", "b", "c", "z").repartition(4, "name").withColumn("body", failing("name"))
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="half-way"):
            write_record_files(odd, folder, mode=mode)
        if mode == "overwrite":
            assert tree(folder) == {"a/1": b"old", "z": b"old"}
    write_record_files(files(spark, "a/1", body="last"), folder, mode="overwrite")
    assert tree(folder) == {"a/1": b"last"}
    assert not [n for n in os.listdir(folder) if n.startswith(".")]  # an overwrite also clears what failed tries left


def test_overwrite_before_there_is_an_output(spark, folder):
    write_record_files(files(spark, "a"), f"{folder}/new/place", mode="overwrite")
    assert tree(f"{folder}/new/place") == {"a": b"x"}


def test_names_stay_inside(spark, folder):
    with pytest.raises(Exception, match="relative file name"):
        write_record_files(files(spark, "a/../../b"), folder)


def test_shards(spark, folder):
    rows = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.repartition(5).write.parquet(f"{folder}/d")
    names = sorted(n for n in os.listdir(f"{folder}/d") if n.endswith(".parquet"))
    path = [f"{folder}/d/{n}" for n in names]
    data = [open(p, "rb").read() for p in path]
    changed = bytearray(data[1])
    changed[len(changed) // 2 : len(changed) // 2 + 300] = b"\xa5" * 300
    for p, body in {path[0]: data[0][: len(data[0]) // 2], path[1]: bytes(changed), path[2]: b"", path[3]: b"PAR1 no parquet PAR1"}.items():
        open(p, "wb").write(body)
    plain = {os.path.basename(r.shard): r for r in dataset_shards(spark, f"{folder}/d").collect()}
    # Spark's file sources list no files of zero bytes, and read nothing from them.
    assert [plain[n].sound if n in plain else None for n in names] == [False, True, None, False, True]
    deep = {os.path.basename(r.shard): r for r in dataset_shards(spark, f"{folder}/d", deep=True).collect()}
    assert [deep[n].sound if n in deep else None for n in names] == [False, False, None, False, True]
    assert deep[names[4]].rows == read_dataset(spark, path[4]).count() == plain[names[4]].rows == 8000
    assert deep[names[0]].rows is None and deep[names[0]].problem.startswith("footer") and deep[names[1]].rows < 8000
    assert read_dataset(spark, f"{folder}/d", "id long, text string").count() >= 8000


def test_shards_are_looked_at_side_by_side(spark, folder):
    spark.range(100).repartition(20).write.parquet(f"{folder}/d")
    looked = dataset_shards(spark, f"{folder}/d")
    assert looked.count() == 20 and looked.groupBy(F.spark_partition_id()).count().count() > 5
    assert looked.agg({"rows": "sum"}).first()[0] == 100


def test_written_files_are_listed_by_tasks(spark, folder):
    from crawlsift.sources.listing import read_files

    rows = [("a/x y.txt", b"1"), ("a/b/c%41+.txt", b"2"), ("a/empty.txt", b""), ("a/img.png", b"\x00\xff"), ("_h/n.txt", b"no"), ("a/.n.txt", b"no"), ("lang=é/z.txt", b"3")]
    for name, body in rows:
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as file:
            file.write(body)
    shown = {f"{folder}/{n}": (len(b), b) for n, b in rows if b not in (b"no", b"")}
    files = read_files(spark, folder)
    assert {r.path: (r.length, bytes(r.content)) for r in files.collect()} == shown
    assert files.inputFiles() == [] or all("listing" in name for name in files.inputFiles())
    assert {r.path for r in read_files(spark, f"file://{folder}/", "*.txt").collect()} == {p if p.startswith("file:") else f"file://{p}" for p in shown if p.endswith(".txt")}
    os.mkdir(f"{folder}/none")
    assert read_files(spark, f"{folder}/none").collect() == []


def test_shards_of_the_dataset_query_are_bounded(spark, monkeypatch):
    """A language was one shard, written by one task."""
    from checks import queries

    found = []
    real = queries.dataset_shards
    monkeypatch.setattr(queries, "dataset_shards", lambda *a, **k: found.append(real(*a, **k)) or found[-1])
    whole = sorted(map(tuple, queries.dataset_shards_query(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert found[0].count() == len(whole)
    monkeypatch.setattr(queries, "SHARD_BYTES", 200_000)
    cut = sorted(map(tuple, queries.dataset_shards_query(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert cut == whole and found[1].count() > len(whole)
