"""Whole jobs on a small crawl: staged and in-place decoding, fetch modes, skew, counters."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import crawl_fixture
from checks import queries as Q
from crawlsift.operators import joins
from crawlsift.operators.outcome import COUNTERS, funnel_counts
from crawlsift.operators.pages import parse_pages
from crawlsift.plans import pairs
from crawlsift.plans.image import image_outcomes, read_images
from crawlsift.plans.pairs import pair_funnel, pair_rows, pair_tables, pairs_job
from crawlsift.plans.text import read_pages, text_outcomes
from crawlsift.sources.warc import read_warc

SF_DIR = "/root/testdata/sf0.001"


def plain_png_decoder():
    """Decoder for the fixture's own PNGs (8-bit RGB, no row filters)."""

    def decode(payload):
        if b"IEND" not in payload:
            return None
        width, height = (int.from_bytes(payload[at : at + 4], "big") for at in (16, 20))
        at = payload.index(b"IDAT")
        size = int.from_bytes(payload[at - 4 : at], "big")
        rows = np.frombuffer(zlib.decompress(payload[at + 4 : at + 4 + size]), np.uint8)
        return rows.reshape(height, width * 3 + 1)[:, 1:].reshape(height, width, 3)

    return decode


@pytest.fixture(scope="module")
def root(spark):
    return Q.crawl(spark, SF_DIR)


def counts(df):
    return {r["counter"]: r["n"] for r in df.collect()}


def test_outcomes_cover_every_record(spark, root):
    n = read_warc(spark, root, payload=False).count()
    for funnel in (
        counts(funnel_counts(text_outcomes(read_pages(spark, root)))),
        counts(funnel_counts(image_outcomes(read_images(spark, root)))),
    ):
        assert sum(funnel.values()) == n
        assert set(funnel) <= set(COUNTERS)


def test_decoding_in_place_equals_staging(spark, root):
    staged = image_outcomes(read_images(spark, root))
    placed = image_outcomes(read_images(spark, root), decoder=plain_png_decoder())
    columns = ["archive", "record_offset", "outcome", "image"]
    assert sorted(staged.select(columns).collect()) == sorted(placed.select(columns).collect())


def test_pair_jobs_agree_in_every_mode(spark, root, monkeypatch):
    def result(**options):
        tables = pair_tables(spark, root, **options)
        rows = pairs_job(tables).select("text_url", "position", "image_url", "export_text", "image", "payload")
        return sorted(rows.collect()), counts(pair_funnel(tables))

    staged = result()
    assert len(staged[0]) == staged[1]["n_node_results"] > 0
    assert result(fetch_mode="scan", decoder=plain_png_decoder()) == staged
    monkeypatch.setattr(joins, "ROWS_PER_SALT", 3)
    assert result(decoder=plain_png_decoder()) == staged


def test_filters_see_text_and_image(spark, root):
    tables = pair_tables(
        spark,
        root,
        text_filter=lambda text: F.length(text) > 800,
        image_filter=lambda image: image["height"] >= 150,
        decoder=plain_png_decoder(),
    )
    wide = lambda text, image: image["width"] > 150
    rows = pair_rows(tables, wide).select("prediction_text", "image.height", "image.width").collect()
    assert all(len(r[0]) > 800 and r[1] >= 150 and r[2] > 150 for r in rows)
    funnel = counts(pair_funnel(tables, wide))
    assert funnel["n_node_results"] == len(rows) > 0
    for name in ("text", "image", "combined"):
        assert funnel[f"n_distributed_{name}_filter_not_passed"] > 0


def test_texts_and_images_from_one_parse(spark):
    page = "<body><nav>n</nav><main><p>a<img src=x.png alt=A></main></body>"
    df = spark.createDataFrame([("http://h/p", page)], "url string, html string")
    row = parse_pages(df).first()
    assert (row["has_body"], row["prediction_text"], row["export_text"]) == (True, "a", "aA")
    assert [(i["url"], i["alt"]) for i in row["imgs"]] == [("http://h/x.png", "A")]
    assert parse_pages(df).columns == ["url", "html", "has_body", "imgs", "prediction_text", "export_text"]


def test_missing_index(spark, root, folder):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    crawl_fixture.build_crawl(spark, pages, f"file:{folder}/crawl")
    import glob
    import os

    for path in glob.glob(f"{folder}/crawl/*/*.cdx.gz"):
        os.rename(path, path + ".off")
    with pytest.raises(Exception):
        pair_tables(spark, f"file:{folder}/nowhere")
    funnel = counts(pair_funnel(pair_tables(spark, f"file:{folder}/crawl")))
    # 50 pages, of which those ending in 3 show no image
    assert funnel["n_index_file_exception"] == 45
    assert "n_node_results" not in funnel


def test_pairs_get_tasks_by_their_pixels(spark, root, monkeypatch):
    tables = pair_tables(spark, root)
    sizes = tables.table.filter("outcome = 'n_node_results'").selectExpr("sum(length(image.data)) AS n").first()["n"]
    few = pair_rows(tables)
    monkeypatch.setattr(pairs, "PIXEL_BYTES_PER_TASK", sizes // 13)
    many = pair_rows(tables)
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert many.rdd.getNumPartitions() == 13
    columns = ["text_url", "position", "image_url", "export_text", "prediction_text", "image"]
    assert sorted(few.select(columns).collect()) == sorted(many.select(columns).collect())
