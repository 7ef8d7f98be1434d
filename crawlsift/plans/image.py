"""Image jobs: classification and raw dataset export."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.functions.naming import image_extension
from crawlsift.operators.decode import decode_images
from crawlsift.operators.filters import (
    IMAGE_TYPES,
    above_threshold,
    image_size_between,
    is_response,
    is_supported_image,
)
from crawlsift.operators.outcome import NODE_RESULTS, outcome_image
from crawlsift.operators.score import BATCH_SIZE, score_decoded, score_passthrough
from crawlsift.sources.dataset import write_dataset
from crawlsift.sources.warc import SLIM_COLUMNS, read_warc

# Fixed values of the image jobs.
IMAGE_CAP = 4_000_000
MODEL_SIZE = (150, 150)
IMAGE_THRESHOLD = 0.95

ImageFilter = Callable[[Column], Column]


def pass_all(_: Column) -> Column:
    return F.lit(True)


def read_images(
    spark: SparkSession, paths: str | list[str], max_content_length: int = IMAGE_CAP
) -> DataFrame:
    """All records below the paths; only image records carry their bytes."""
    return read_warc(
        spark, paths, max_content_length, payload=list(IMAGE_TYPES), columns=SLIM_COLUMNS
    )


def image_outcomes(
    records: DataFrame, image_filter: ImageFilter = pass_all, decoder=None
) -> DataFrame:
    """Every record with its ``outcome``; images also with decoded ``image``."""
    candidate = F.col("error").isNull() & is_response() & is_supported_image()
    slim = records.withColumn("payload", F.when(candidate, F.col("payload")))
    decoded = decode_images(slim, ["archive", "record_offset"], decoder)
    return decoded.withColumn("outcome", outcome_image(image_filter(F.col("image"))))


def image_rows(
    records: DataFrame, image_filter: ImageFilter = pass_all, decoder=None
) -> DataFrame:
    """``(archive, record_offset, url, extension, payload, image)`` of kept images."""
    kept = image_outcomes(records, image_filter, decoder).filter(
        F.col("outcome") == NODE_RESULTS
    )
    return kept.select(
        "archive",
        "record_offset",
        F.col("target_uri").alias("url"),
        image_extension(F.col("content_type")).alias("extension"),
        "payload",
        "image",
    )


def image_job(
    records: DataFrame,
    make_predict_fn: Callable[[], Callable],
    image_filter: ImageFilter = image_size_between,
    threshold: float = IMAGE_THRESHOLD,
    size: tuple[int, int] = MODEL_SIZE,
    decoder=None,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Images of the wanted size that the model flags, with ``prediction``."""
    rows = image_rows(records, image_filter, decoder)
    scored = score_decoded(rows, make_predict_fn, *size, batch_size=batch_size)
    return above_threshold(scored, threshold)


def dataset_job(
    records: DataFrame,
    directory: str,
    decoder=None,
    mode: str = "errorifexists",
) -> None:
    """Store all images, unscored (prediction 1.0), as a dataset of
    ``(prediction, image, url)``."""
    rows = image_rows(records, decoder=decoder)
    scored = score_passthrough(rows).select("prediction", "image", "url")
    write_dataset(scored, directory, mode)
