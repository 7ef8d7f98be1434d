"""Decoding image payloads."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.functions.image import IMAGE, decode_with, rgb_from_bgr
from crawlsift.functions.jvm_image import jvm_decoder
from crawlsift.operators.pages import evaluate_once
from crawlsift.session import materialize, read_by_rows, work_dir
from crawlsift.sinks.record_files import write_record_files
from crawlsift.sources.paths import base_name


def decode_images(
    df: DataFrame,
    keys: list[str],
    decoder: Callable[[bytes], np.ndarray | None] | None = None,
    payload: str = "payload",
) -> DataFrame:
    """Add ``image`` (height, width, channels, RGB data); NULL where the bytes do not decode.

    Images are decoded where they lie, by Spark's own decoder in the JVM or by a Python
    ``decoder``: no shuffle, no files, batch or stream.

    Only where the driver runs on a JRE, which cannot compile the few lines that call Spark's
    decoder, Spark's image source does the work: payloads are staged as files named by a hash of
    ``keys`` (which must identify the row), and pixels are joined back.

    Tables of decoded images are read by rows from then on, see ``read_by_rows``.
    """
    read_by_rows(df.sparkSession)
    if decoder is not None:
        return df.withColumn("image", decode_with(decoder)(F.col(payload)))
    decode = jvm_decoder(df.sparkSession)
    if decode is not None:
        return evaluate_once(df, image=decode(F.col(payload)))
    return _decode_staged(df, keys, payload)


def _decode_staged(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    spark = df.sparkSession
    name = F.sha2(F.concat_ws("\n", *[F.col(k).cast("string") for k in keys]), 256)
    table = materialize(df.withColumn("_name", name), "images")
    folder = work_dir(spark, "image-files")
    staged = table.filter(F.length(payload) > 0).select(
        # two leading characters spread the files over 256 folders
        F.concat(F.substring("_name", 1, 2), F.lit("/"), F.col("_name")).alias("name"),
        F.col(payload).alias("body"),
    )
    write_record_files(staged, folder)
    if not staged.head(1):
        return table.withColumn("image", F.lit(None).cast(IMAGE)).drop("_name")
    pixels = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select(
            base_name(F.col("image.origin")).alias("_name"),
            rgb_from_bgr(F.col("image")).alias("image"),
        )
    )
    # Pixels are many times larger than the files the planner sizes them by: never broadcast.
    return table.join(pixels.hint("merge"), "_name", "left").drop("_name")

