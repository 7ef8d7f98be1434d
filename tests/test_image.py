import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.queries import queries
from crawl_fixture import IMAGE_HOST, bmp, image_shape, png
from crawlsift.functions import image
from crawlsift.functions.image import (
    pack_image,
    resize_images,
    resize_pixels,
    similarity_inputs,
    unpack_image,
)
from crawlsift.operators.decode import _decode_staged, decode_images
from crawlsift.operators.filters import image_size_between
from crawlsift.session import materialize


def encoded(spark, kind, height, width, colour, picture_type=1):
    """Image bytes from the JVM's own writer."""
    jvm = spark._jvm
    image = jvm.java.awt.image.BufferedImage(width, height, picture_type)
    rgb = (255 << 24) | (colour[0] << 16) | (colour[1] << 8) | colour[2]
    for y in range(height):
        for x in range(width):
            image.setRGB(x, y, rgb - (1 << 32))
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, kind, out)
    return bytes(out.toByteArray())


def test_formats(spark):
    colour = (200, 100, 50)
    rows = [
        ("png", png(5, 7, colour)),
        ("bmp", bmp(5, 7, colour)),
        ("gif", encoded(spark, "gif", 5, 7, colour)),
        ("jpg", encoded(spark, "jpg", 5, 7, colour)),
        ("alpha", encoded(spark, "png", 5, 7, colour, picture_type=2)),
        ("gray", encoded(spark, "png", 5, 7, (90, 90, 90), picture_type=10)),
        ("cut", png(5, 7, colour)[:60]),
        ("text", b"not an image"),
        ("empty", b""),
        ("none", None),
    ]
    df = spark.createDataFrame(rows, "k string, payload binary")
    check_formats(decode_images(df, ["k"]), rows, colour)
    check_formats(_decode_staged(df, ["k"], "payload"), rows, colour)
    plan = decode_images(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def check_formats(decoded, rows, colour):
    got = {r["k"]: r["image"] for r in decoded.collect()}
    assert len(got) == len(rows)
    assert {k for k, v in got.items() if v is None} == {"cut", "text", "empty", "none"}
    for kind in ("png", "bmp", "gif", "jpg", "alpha"):
        pixels = unpack_image(got[kind])
        assert pixels.shape == (5, 7, 3)
        assert np.abs(pixels.astype(int) - np.array(colour)).max() <= (6 if kind == "jpg" else 0), kind
    assert len(set(unpack_image(got["gray"]).ravel().tolist())) == 1


def test_no_payload_at_all(spark):
    df = spark.createDataFrame([("a", None)], "k string, payload binary")
    assert decode_images(df, ["k"]).first()["image"] is None


def test_decoder_hook(spark):
    def raw_decoder(payload):
        return np.frombuffer(payload, np.uint8).reshape(2, 2, 3) if len(payload) == 12 else None

    df = spark.createDataFrame([("a", bytes(range(12))), ("b", b"x"), ("c", None)], "k string, payload binary")
    got = {r["k"]: r["image"] for r in decode_images(df, ["k"], raw_decoder).collect()}
    assert unpack_image(got["a"]).ravel().tolist() == list(range(12))
    assert got["b"] is None and got["c"] is None


def brute_resize(pixels, height, width):
    def axis(size_in, size_out):
        out = np.zeros((size_out, size_in))
        scale = size_in / size_out
        reach = max(1.0, scale)
        for i in range(size_out):
            centre = (i + 0.5) * scale
            for j in range(size_in):
                out[i, j] = max(0.0, 1 - abs(j + 0.5 - centre) / reach)
            out[i] /= out[i].sum()
        return out

    a, b = axis(pixels.shape[0], height), axis(pixels.shape[1], width)
    return np.stack([a @ (pixels[:, :, c] / 255.0) @ b.T for c in range(3)], axis=2)


@pytest.mark.parametrize("shape", [(9, 7, 4, 3), (3, 4, 9, 8), (5, 5, 5, 5), (1, 1, 3, 2), (40, 3, 2, 6)])
def test_resize_against_brute_force(shape):
    h, w, out_h, out_w = shape
    pixels = np.random.default_rng(1).integers(0, 256, (h, w, 3)).astype(np.uint8)
    got = resize_pixels(pixels, out_h, out_w)
    assert got.shape == (out_h, out_w, 3) and got.dtype == np.float32
    assert np.allclose(got, brute_resize(pixels, out_h, out_w), atol=1e-5)


def test_resize_column_and_inputs(spark):
    pixels = np.full((4, 6, 3), (255, 0, 51), np.uint8)
    df = spark.createDataFrame(
        [(pack_image(pixels), "a b"), (None, "c")],
        "image struct<height:int,width:int,channels:int,data:binary>, alt string",
    )
    first, second = df.select(resize_images(F.col("image"), 2, 2).alias("r")).collect()
    assert np.allclose(first["r"], [1, 0, 0.2] * 4) and second["r"] is None
    tokens = lambda c: F.struct(F.array(F.lit(1)).alias("input_ids"), F.array(F.lit(1)).alias("attention_mask"))
    row = df.select(similarity_inputs(F.col("alt"), F.col("image"), tokens, 2).alias("x")).first()["x"]
    assert row["input_ids"] == [1] and len(row["pixels"]) == 12
    assert np.allclose(row["pixels"][:4], (1 - 0.48145466) / 0.26862954)
    assert np.allclose(row["pixels"][8:], (0.2 - 0.40821073) / 0.27577711, atol=1e-5)


def test_model_pixels_leave_a_worker_a_few_images_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(image, "PIXEL_BYTES", 100)
    shape = "i int, image struct<height:int,width:int,channels:int,data:binary>"
    rows = [(i, None if i % 3 == 1 else pack_image(np.full((2 + i, 3, 3), (i, 0, 255), np.uint8))) for i in range(7)]
    df = spark.createDataFrame(rows, shape).coalesce(1)
    got = {r["i"]: r["p"] for r in df.select("i", image.similarity_pixels(F.col("image"), 2).alias("p")).collect()}
    assert {i for i, p in got.items() if p is None} == {1, 4}
    for i in (0, 2, 3, 5, 6):
        assert np.allclose(got[i], np.repeat((np.array([i / 255, 0, 1]) - image.CHANNEL_MEAN) / image.CHANNEL_STD, 4), atol=1e-5)
    empty = df.filter("i < 0").select(image.similarity_pixels(F.col("image"), 2))
    assert empty.collect() == []


def test_query_makes_inputs_of_the_models_size(spark, folder):
    """Its images were once shrunk to two by two pixels."""
    pages = [(p, f"https://example.org/{p}", f"<html><article><p>page {p}</p></article></html>") for p in range(1, 9)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([("the picture of a page",)], "text string").write.parquet(f"{folder}/documents.parquet")
    got = {r["url"]: r for r in queries()["similarity_inputs"](spark, folder).collect()}
    assert set(got) == {f"{IMAGE_HOST}/{p}.png" for p in (1, 2, 3, 4, 5, 6)}
    for p in (1, 2, 3, 4, 5, 6):
        row = got[f"{IMAGE_HOST}/{p}.png"]
        assert (row["n_pixels"], row["n_ids"], row["n_mask"]) == (3 * 224 * 224, 9, 9)
        assert (row["red"], row["green"], row["blue"]) == image_shape(p)[2]


def test_size_band_is_inclusive_and_height_first(spark):
    rows = [((h, w, 3, b""),) for h, w in [(150, 1000), (149, 500), (500, 1001), (1000, 150)]]
    df = spark.createDataFrame(rows, "image struct<height:int,width:int,channels:int,data:binary>")
    assert [r[0] for r in df.select(image_size_between(F.col("image"))).collect()] == [True, False, False, True]


def test_decoding_needs_no_files_and_images_are_read_by_rows(spark, folder):
    df = spark.createDataFrame([("a", png(5, 7, (1, 2, 3)))], "k string, payload binary")
    stored = materialize(decode_images(df, ["k"]), "decoded", f"{folder}/d")
    assert stored.first()["image"]["width"] == 7
    assert not spark._jvm.javax.imageio.ImageIO.getUseCache()
    plan = stored.select("k", "image")._jdf.queryExecution().executedPlan().toString()
    assert "Batched: false" in plan
    plain = stored.select("k", "payload")._jdf.queryExecution().executedPlan().toString()
    assert "Batched: true" in plain
