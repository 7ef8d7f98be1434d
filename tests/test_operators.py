import json
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.operators import joins
from crawlsift.operators.filters import above_threshold, with_alt
from crawlsift.operators.outcome import COUNTERS, first_failure, funnel_counts, observe_funnel, outcome_pairs
from crawlsift.operators.pages import evaluate_once
from crawlsift.operators.score import linear_token_model, score, score_decoded, score_pairs, score_text
from crawlsift.functions.image import pack_image
from crawlsift.session import BROADCAST_LIMIT_BYTES, broadcast_if_bounded, work_dir
from crawlsift.sinks.record_files import image_files, text_files, write_alt_pairs, write_pairs, write_record_files
from crawlsift.sinks.stats import report, write_stats
from crawlsift.sources.dataset import read_dataset, write_dataset


def files_below(root):
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            path = os.path.join(folder, name)
            if not name.startswith(("_", ".")):
                with open(path, "rb") as file:
                    found[os.path.relpath(path, root)] = file.read()
    return found


def test_first_failure_decides(spark):
    df = spark.createDataFrame([(True, True), (False, False), (True, None), (None, True)], "a boolean, b boolean")
    out = df.select(first_failure([(F.col("a"), "x"), (F.col("b"), "y")])).collect()
    assert [r[0] for r in out] == ["n_node_results", "x", "y", "x"]


def test_observation_equals_funnel(spark):
    df = spark.createDataFrame([(COUNTERS[i % 4],) for i in range(50)], "outcome string")
    seen = Observation("funnel")
    observe_funnel(df, seen).write.format("noop").mode("overwrite").save()
    counted = {r["counter"]: r["n"] for r in funnel_counts(df).collect()}
    assert {k: v for k, v in seen.get.items() if v} == counted and sum(counted.values()) == 50


def test_join_unique_spreads_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 10)
    rows = spark.createDataFrame(
        [(i, "d", "hot" if i % 3 else f"k{i % 20}") for i in range(600)] + [(-1, "d", "absent")],
        "i int, item_dir string, url string",
    )
    table = spark.createDataFrame([("d", "hot", 1)] + [("d", f"k{i}", i) for i in range(20)], "item_dir string, url string, v int")
    counts = joins.image_references(rows)
    got = joins.join_unique(rows, table, joins.KEYS, counts, 601)
    want = rows.join(table, joins.KEYS)
    assert sorted(got.select("i", "url", "v").collect()) == sorted(want.select("i", "url", "v").collect())
    assert got.count() == 600
    slim = joins.join_unique(rows, table, joins.KEYS, counts, 601, heavy=True, salt_on=["i"])
    assert sorted(slim.select("i", "url", "v").collect()) == sorted(want.select("i", "url", "v").collect())
    plain = joins.join_unique(rows, table, joins.KEYS, counts, 5)
    assert plain.count() == 600


@pytest.mark.parametrize("n_rows", [601, 5])
def test_heavy_join_keeps_its_tasks(spark, monkeypatch, n_rows):
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 10)
    rows = spark.createDataFrame([(i, "d", "hot" if i % 3 else f"k{i % 20}") for i in range(600)], "i int, item_dir string, url string")
    table = spark.createDataFrame([("d", "hot", 1)] + [("d", f"k{i}", i) for i in range(20)], "item_dir string, url string, v int")
    counts = joins.image_references(rows)
    got = joins.join_unique(rows, table, joins.KEYS, counts, n_rows, heavy=True, salt_on=["i"], tasks=11)
    assert got.rdd.getNumPartitions() == 11
    want = rows.join(table, joins.KEYS)
    assert sorted(got.select("i", "url", "v").collect()) == sorted(want.select("i", "url", "v").collect())


def test_image_outcome_order(spark):
    good = dict(url="u", warc_path="w", error=None, warc_type="response", content_length=200,
                content_type="image/png", target_uri="u", image=1)
    cases = [
        ({}, "n_node_results"),
        ({"url": None, "warc_path": None}, "n_unhandled_record_exceptions"),
        ({"warc_path": None, "warc_type": None}, "n_img_not_found"),
        ({"error": "cut", "warc_type": None}, "n_unhandled_record_exceptions"),
        ({"content_length": 127, "content_type": "text/html"}, "n_img_wrong_warc_type"),
        ({"warc_type": "request"}, "n_img_wrong_warc_type"),
        ({"content_type": "text/html", "target_uri": "v"}, "n_img_wrong_content_type"),
        ({"content_type": None}, "n_img_wrong_content_type"),
        ({"target_uri": "v", "image": None}, "n_img_misplaced"),
        ({"image": None}, "n_decoding_exception"),
    ]
    schema = ("url string, warc_path string, error string, warc_type string, content_length long, "
              "content_type string, target_uri string, image int, want string")
    df = spark.createDataFrame([{**good, **change, "want": want} for change, want in cases], schema)
    outcome = outcome_pairs(F.lit(True), F.lit(True))
    for row in df.select(outcome.alias("got"), "want").collect():
        assert row["got"] == row["want"]
    no = df.limit(1).select(outcome_pairs(F.lit(False), F.lit(False)), outcome_pairs(F.lit(True), F.lit(None)))
    assert list(no.first()) == ["n_distributed_image_filter_not_passed", "n_distributed_combined_filter_not_passed"]


def test_broadcast_needs_a_bound(spark):
    df = spark.range(3)
    assert "broadcast" in broadcast_if_bounded(df, 10)._jdf.queryExecution().logical().toString().lower()
    unbounded = broadcast_if_bounded(df, BROADCAST_LIMIT_BYTES)
    assert "broadcast" not in unbounded._jdf.queryExecution().logical().toString().lower()


def test_evaluate_once(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def slow(x):
        calls.add(1)
        return x * 2

    df = evaluate_once(spark.range(10).repartition(1), twice=slow(F.col("id").cast("int")))
    rows = df.filter("twice > 4").filter("twice < 14").select("id", "twice").collect()
    assert [r["twice"] for r in rows] == [6, 8, 10, 12]
    assert calls.value == 10


def test_thresholds_and_alt(spark):
    df = spark.createDataFrame([(0.9,), (0.91,), (None,)], "prediction double")
    assert above_threshold(df, 0.9).count() == 1
    assert above_threshold(df, 0.9, inclusive=True).count() == 2
    imgs = spark.createDataFrame([([("u", "a"), ("v", ""), ("w", None)],)], "i array<struct<url:string,alt:string>>")
    assert [x["url"] for x in imgs.select(with_alt(F.col("i")).alias("i")).first()["i"]] == ["u"]


def test_padding_is_inert_and_no_row_is_lost(spark):
    weights = np.array([0.0, 0.5, -0.25, 2.0])
    rows = [(i, {"input_ids": [1 + (i + j) % 3 for j in range(i % 5)], "attention_mask": [1] * (i % 5)}) for i in range(47)]
    schema = "i int, tokens struct<input_ids:array<int>,attention_mask:array<int>>"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    batched = {r["i"]: r["prediction"] for r in score_text(df, linear_token_model(weights), batch_size=20).collect()}
    alone = {r["i"]: r["prediction"] for r in score_text(df, linear_token_model(weights), batch_size=1).collect()}
    assert len(batched) == 47 and batched == alone
    for i, row in rows:
        logit = sum(weights[t] for t in row["input_ids"])
        assert batched[i] == pytest.approx(1 / (1 + np.exp(-logit)))


def test_batches_and_last_short_batch(spark):
    def batch_sizes():
        return lambda x: np.full(len(x), float(len(x)))

    df = spark.range(45).select("id", F.col("id").cast("double").alias("x")).coalesce(1)
    out = score(df, batch_sizes, ["x"], return_type=T.DoubleType(), batch_size=20).collect()
    assert sorted(r["prediction"] for r in out) == [5.0] * 5 + [20.0] * 40


def test_score_decoded(spark):
    def mean_model():
        return lambda pixels: pixels.reshape(len(pixels), -1).mean(axis=1)

    images = [pack_image(np.full((3, 3, 3), v, np.uint8)) for v in (0, 51, 255)] + [None]
    df = spark.createDataFrame([(i,) for i in images], "image struct<height:int,width:int,channels:int,data:binary>")
    got = [r["prediction"] for r in score_decoded(df.coalesce(1), mean_model, 2, 2, batch_size=2).collect()]
    assert got[:3] == pytest.approx([0, 0.2, 1]) and got[3] is None


def test_pairs_are_scored_in_batches_and_a_failed_pair_scores_zero(spark, folder):
    def failing_model():
        def predict(ids, mask, pixels):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
                file.write(str(pixels.shape))
            if (mask.sum(axis=1) == 2).any():
                raise RuntimeError("broken pair")
            return 10.0 * mask.sum(axis=1) + pixels.mean(axis=(1, 2, 3)) * 0

        return predict

    image = pack_image(np.full((3, 3, 3), 7, np.uint8))
    rows = [(([1] * n, [1] * n), image if n != 5 else None) for n in (1, 2, 3, 4, 5, 6)] + [(None, image)]
    df = spark.createDataFrame(
        rows, "tokens struct<input_ids:array<int>,attention_mask:array<int>>, image struct<height:int,width:int,channels:int,data:binary>"
    )
    scored = score_pairs(df.coalesce(1), failing_model, size=4, batch_size=2)
    assert [r["prediction"] for r in scored.collect()] == [10.0, 0.0, 30.0, 40.0, 0.0, 60.0, 0.0]
    calls = sorted(text.decode() for text in files_below(folder).values())
    # Rows 1 and 2 fail together and are repeated alone; 3 and 4 pass together; 6 is left.
    assert calls == ["(1, 3, 4, 4)"] * 3 + ["(2, 3, 4, 4)"] * 2


def test_record_files(spark, folder):
    df = spark.createDataFrame([(f"d{i % 3}/f{i}.bin", bytes([i])) for i in range(20)], "name string, body binary")
    write_record_files(df, f"{folder}/out")
    assert files_below(f"{folder}/out") == {f"d{i % 3}/f{i}.bin": bytes([i]) for i in range(20)}
    assert os.path.exists(f"{folder}/out/_SUCCESS")
    write_record_files(df.limit(1), f"{folder}/out", mode="overwrite")
    assert len(files_below(f"{folder}/out")) == 1
    with pytest.raises(Exception, match="not a relative file name"):
        write_record_files(spark.createDataFrame([("../x", b"")], "name string, body binary"), f"{folder}/out2")
    assert not os.path.exists(f"{folder}/x")


def test_long_urls_do_not_overwrite_one_another(spark, folder):
    url = "http://h/" + "x" * 200
    df = spark.createDataFrame([(url + "1", 0.95, "a", b"1", "png"), (url + "2", 0.95, "b", b"2", "png")],
                               "url string, prediction double, export_text string, payload binary, extension string")
    write_record_files(text_files(df), f"{folder}/t")
    assert sorted(files_below(f"{folder}/t").values()) == [b"a", b"b"]
    write_record_files(image_files(df), f"{folder}/i")
    names = files_below(f"{folder}/i")
    assert sorted(names.values()) == [b"1", b"2"] and all(n.endswith(".png") for n in names)


def test_pair_folders(spark, folder):
    df = spark.createDataFrame(
        [("http://h/p", f"http://h/{i}.png", "text", f"alt {i}", bytes([i]), "png", 1.0, i) for i in range(3)],
        "text_url string, image_url string, export_text string, alt_text string, payload binary, extension string, prediction double, position int",
    )
    write_pairs(df, f"{folder}/p", ("text_url", "position"))
    pairs = files_below(f"{folder}/p")
    assert len(pairs) == 6 and len({os.path.dirname(p) for p in pairs}) == 3
    write_alt_pairs(df, f"{folder}/a", ("text_url", "position"))
    metas = sorted(v for k, v in files_below(f"{folder}/a").items() if k.endswith("meta.txt"))
    assert metas[0] == b"1.0\nhttp://h/p\nhttp://h/0.png\nalt 0\n"


def test_stats(spark, folder):
    counts = spark.createDataFrame([("b", 2), ("a", 1)], "counter string, n long")
    write_stats(counts, f"{folder}/s")
    (line,) = [v for k, v in files_below(f"{folder}/s").items() if k.endswith(".txt")]
    assert json.loads(line) == {"a": 1, "b": 2}


def test_damaged_shard_is_skipped(spark, folder):
    df = spark.range(100).repartition(4).withColumn("s", F.repeat(F.lit("x"), 50))
    write_dataset(df, f"{folder}/d")
    shards = sorted(n for n in os.listdir(f"{folder}/d") if n.endswith(".parquet"))
    path = f"{folder}/d/{shards[0]}"
    data = open(path, "rb").read()
    with open(path, "wb") as file:
        file.write(data[: len(data) // 2])
    checksum = f"{folder}/d/.{shards[0]}.crc"
    if os.path.exists(checksum):
        os.remove(checksum)
    kept = read_dataset(spark, f"{folder}/d", df.schema).count()
    assert 0 < kept < 100


def test_intermediates_need_a_shared_folder_off_local_masters():
    class Context:
        applicationId = "a"

        def __init__(self, master):
            self.master = master

        def getConf(self):
            return {}

    class Session:
        conf = {}

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://h"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_dir(Session(master), "x")
    for master in ("local", "local[4]", "local[*]", "local[2,3]"):
        assert os.path.isabs(work_dir(Session(master), "x"))


def test_report_shows_every_positive(spark, capsys):
    rows = spark.range(57).select(F.concat(F.lit("http://h/"), "id").alias("url"), F.lit(1.0).alias("prediction"))
    report(rows)
    assert len(capsys.readouterr().out.splitlines()) == 57
    report(rows, n=3)
    assert len(capsys.readouterr().out.splitlines()) == 3
