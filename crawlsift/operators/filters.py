"""Predicates on records, pages, texts, images and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the record checks and the example jobs.
MIN_BODY_BYTES = 128
MIN_TEXT_CHARS = 1000
IMAGE_SIZE_BAND = (150, 1000)
HTML_TYPE = "text/html"
IMAGE_TYPES = ("image/jpeg", "image/gif", "image/bmp", "image/png")


def has_record_headers() -> Column:
    return F.col("has_headers")


def has_http_headers() -> Column:
    return F.col("has_http_headers")


def is_response(min_len: int = MIN_BODY_BYTES) -> Column:
    """A response whose HTTP body has at least ``min_len`` bytes."""
    return (F.col("warc_type") == "response") & (F.col("content_length") >= min_len)


def is_html(content_type: str = "content_type") -> Column:
    return F.col(content_type).startswith(HTML_TYPE)


def is_supported_image(content_type: str = "content_type") -> Column:
    kinds = "|".join(kind.removeprefix("image/") for kind in IMAGE_TYPES)
    return F.col(content_type).rlike(f"^image/({kinds})")


def within_content_length(n: int) -> Column:
    """Whole record block (HTTP headers included) within ``n`` bytes.

    ``read_warc(max_content_length=n)`` applies the same rule without keeping the bytes.
    """
    return F.col("block_length") <= n


def min_text_length(text: Column, n: int = MIN_TEXT_CHARS) -> Column:
    """At least ``n`` characters (code points)."""
    return F.length(text) >= n


def count_matches(text: Column, pattern: str) -> Column:
    """Non-overlapping, case-sensitive matches (Java pattern syntax)."""
    return F.regexp_count(text, F.lit(pattern))


def matches_regex(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def is_language(language: Column, code: str = "en") -> Column:
    """Filter on the output of a ``language_detector``."""
    return language == code


def image_size_between(
    image: Column, lo: int = IMAGE_SIZE_BAND[0], hi: int = IMAGE_SIZE_BAND[1]
) -> Column:
    """Height and width both within the band, ends included."""
    return image["height"].between(lo, hi) & image["width"].between(lo, hi)


def has_images(images: Column) -> Column:
    return F.size(images) > 0


def has_alt(image: Column) -> Column:
    """The image carries a non-empty alt text."""
    return F.length(image["alt"]) > 0


def with_alt(images: Column) -> Column:
    """Only the images that carry a non-empty alt text."""
    return F.filter(images, has_alt)


def image_url_matches(requested: str = "url", target: str = "target_uri") -> Column:
    """The fetched record is the one asked for."""
    return F.col(target) == F.col(requested)


def above_threshold(
    df: DataFrame, threshold: float, inclusive: bool = False, score: str = "prediction"
) -> DataFrame:
    """Rows whose score passes: strictly above, or also equal with ``inclusive``."""
    value = F.col(score)
    return df.filter(value >= threshold if inclusive else value > threshold)
