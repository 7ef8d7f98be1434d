"""Joins of pages, index and records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlsift.session import materialize

KEYS = ["item_dir", "url"]
#: A key with more rows than this is spread over several salts.
ROWS_PER_SALT = 50_000
#: So many keys may be broadcast.
MAX_HOT_KEYS = 200_000


def page_images(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One slim row per image reference of a page: page keys, position, URL, alt text."""
    return pages.select(*keys, F.posexplode("imgs").alias("position", "img")).select(
        *keys, "position", F.col("img.url").alias("url"), F.col("img.alt").alias("alt")
    )


def image_references(images: DataFrame) -> DataFrame:
    """``(item_dir, url, n_refs)``: every referenced URL once, counted before the shuffle."""
    return images.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_refs"))


def _join_distinct(images: DataFrame, captures: DataFrame, how: str) -> DataFrame:
    """Join every distinct reference once, then give the result to all rows that hold it."""
    counts = materialize(image_references(images), "references")
    total = counts.agg(F.sum("n_refs")).first()[0] or 0
    found = counts.select(*KEYS).join(captures, KEYS, how)
    return join_unique(images, found, KEYS, counts, total)


def locate_images(images: DataFrame, captures: DataFrame) -> DataFrame:
    """Image URLs found in their item's index, with archive and offset."""
    return _join_distinct(images, captures, "inner")


def missing_images(images: DataFrame, captures: DataFrame) -> DataFrame:
    """Image URLs their item's index does not hold."""
    return _join_distinct(images, captures, "left_anti")


def join_unique(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    counts: DataFrame,
    n_rows: int,
    heavy: bool = False,
    salt_on: list[str] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Inner join of many ``rows`` to a ``table`` that holds each key once.

    ``counts`` is ``(keys, n_refs)``, how many rows each key has; ``n_rows`` their total. Keys
    above ROWS_PER_SALT are salted: their rows scatter over ceil(n / ROWS_PER_SALT) salts by a
    hash of ``salt_on`` (slim columns that tell rows apart; all columns if not given), and the
    table repeats the key once per salt. Where n_rows / ROWS_PER_SALT keys would be too many to
    broadcast, only keys above n_rows / MAX_HOT_KEYS rows are salted; there are at most
    MAX_HOT_KEYS of those, and any other key is less than that share of all rows. Nothing is
    dropped.

    A ``heavy`` table (pixels) outgrows the file sizes the planner sees, so it is joined by
    sort-merge, which spills, and never broadcast. Its compressed shuffle is small, too: with
    ``tasks`` the join has that many, and adaptive execution does not pack them into few.
    """

    def dealt(df: DataFrame, on: list[str]) -> DataFrame:
        return df.repartition(tasks, *on) if tasks else df

    def side(df: DataFrame) -> DataFrame:
        return df.hint("merge") if heavy else df

    least = max(ROWS_PER_SALT, -(-n_rows // MAX_HOT_KEYS))
    hot = counts.filter(F.col("n_refs") > least).select(
        *keys, F.ceil(F.col("n_refs") / ROWS_PER_SALT).cast("int").alias("_salts")
    )
    # over an empty table adaptive execution would plan anew and shuffle a dealt side once more
    if n_rows <= least or (tasks and hot.isEmpty()):
        return dealt(rows, keys).join(side(dealt(table, keys)), keys, "inner")
    hot = F.broadcast(hot)  # at most n_rows / least rows, so never above MAX_HOT_KEYS
    salts = F.coalesce("_salts", F.lit(1))
    scattered = rows.join(hot, keys, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_on or rows.columns]), salts).cast("int")
    )
    repeated = table.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))
    )
    salted = [*keys, "_salt"]
    return (
        dealt(scattered.drop("_salts"), salted)
        .join(side(dealt(repeated.drop("_salts"), salted)), salted, "inner")
        .drop("_salt")
    )


def pair_pages_images(pages: DataFrame, images: DataFrame, keys: list[str]) -> DataFrame:
    """Page columns joined to the page's valid images, one row per image.

    ``images`` should still be slim here (URLs, no pixels): then a page's text crosses the
    shuffle once, and pixels are attached afterwards, once per distinct image.
    """
    return images.join(pages, keys, "inner")
