"""Names and bodies of exported files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How many leading bytes of a URL enter a name.
FILE_URL_BYTES = 128
PAIR_URL_BYTES = 64
# Extension by content type.
EXTENSIONS = {
    "image/jpeg": "jpg",
    "image/gif": "gif",
    "image/bmp": "bmp",
    "image/png": "png",
}


def url_token(url: Column, n_bytes: int = FILE_URL_BYTES) -> Column:
    """URL-safe base64 of the first ``n_bytes`` bytes of a URL."""
    head = F.substring(F.encode(url, "utf-8"), 1, n_bytes)
    # base64() breaks lines in some configurations; a file name must not
    encoded = F.regexp_replace(F.base64(head), r"[\r\n]", "")
    return F.translate(encoded, "+/", "-_")


def score_token(score: Column) -> Column:
    return F.format_string("%1.4f", score.cast("double"))


def export_name(url: Column, score: Column, extension: Column | str) -> Column:
    """``<url token>_<score with four decimals>.<extension>``."""
    ext = F.lit(extension) if isinstance(extension, str) else extension
    return F.concat(url_token(url), F.lit("_"), score_token(score), F.lit("."), ext)


def pair_directory(text_url: Column, image_url: Column, score: Column | None = None) -> Column:
    """Directory of a page-image pair; with ``score`` its four-decimal form is appended."""
    parts = [url_token(text_url, PAIR_URL_BYTES), url_token(image_url, PAIR_URL_BYTES)]
    if score is not None:
        parts.append(score_token(score))
    return F.concat_ws("_", *parts)


def image_extension(content_type: Column) -> Column:
    """File extension of an accepted image type."""
    out = F.lit(None).cast("string")
    for prefix, extension in EXTENSIONS.items():
        out = F.when(content_type.startswith(prefix), extension).otherwise(out)
    return out


def alt_metadata(score: Column, text_url: Column, image_url: Column, alt: Column) -> Column:
    """Four lines: score, page URL, image URL, alt text."""
    return F.concat(F.concat_ws("\n", score.cast("string"), text_url, image_url, alt), F.lit("\n"))
