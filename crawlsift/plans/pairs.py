"""Pair jobs: pages with the images they show, images with their alt texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.functions.html import body_html, has_body, main_content, render
from crawlsift.functions.naming import image_extension
from crawlsift.functions.urls import extract_images
from crawlsift.operators.decode import decode_images
from crawlsift.operators.filters import (
    above_threshold,
    image_url_matches,
    is_response,
    is_supported_image,
    with_alt,
)
from crawlsift.operators.joins import (
    KEYS,
    image_references,
    join_unique,
    page_images,
    pair_pages_images,
)
from crawlsift.operators.outcome import (
    COMBINED_FILTER_NOT_PASSED,
    NODE_RESULTS,
    funnel_counts,
    outcome_indexed,
    outcome_page,
    outcome_pairs,
)
from crawlsift.operators.pages import evaluate_once
from crawlsift.operators.score import score_pairs, score_passthrough
from crawlsift.plans.text import html_only, pass_all, read_pages
from crawlsift.session import broadcast_if_bounded, materialize
from crawlsift.sources.cdx import latest_captures, read_index, usable_items
from crawlsift.sources.fetch import fetch_records
from crawlsift.sources.paths import parent

# Fixed values of the pair jobs.
PAIR_CAP = 4_000_000
SIMILARITY_THRESHOLD = 20.0

PAGE_KEYS = ["archive", "record_offset"]
#: Records one task fetches by offset.
REFERENCES_PER_TASK = 2_000
#: Pixels, and pairs, that one task joins and scores.
PIXEL_BYTES_PER_TASK = 128 << 20
PAIRS_PER_TASK = 5_000

CombinedFilter = Callable[[Column, Column], Column]


@dataclass
class PairTables:
    """What a pair job works on. ``records`` has one row per archive record with its page
    outcome (empty for pages that go on to their images), ``images`` one slim row per image
    reference, ``table`` each referenced image once with its outcome."""

    records: DataFrame
    images: DataFrame
    table: DataFrame

    def pages(self) -> DataFrame:
        return self.records.filter(F.col("outcome") == "")


def pair_tables(
    spark: SparkSession,
    roots: str | list[str],
    text_filter: Callable[[Column], Column] = pass_all,
    image_filter: Callable[[Column], Column] = pass_all,
    alt_only: bool = False,
    texts: bool = True,
    max_content_length: int = PAIR_CAP,
    decoder=None,
    fetch_mode: str = "range",
) -> PairTables:
    """Extract pages, look their images up in the index, fetch and decode each image once.

    The archives are parsed once: pages are written as a table that later steps read by
    column. Image URLs are counted per item before any join, so an image that many pages show
    is located, fetched and decoded a single time. Indexes are read once, after the pages: what
    leaves the tasks that read them are the lines of URLs that pages show.
    """
    records = read_pages(spark, roots, max_content_length)
    body = evaluate_once(
        html_only(records), _body=body_html(F.col("html")), has_body=has_body(F.col("html"))
    )
    images = extract_images(F.col("_body"), F.col("target_uri"))
    parsed = body.withColumn("imgs", with_alt(images) if alt_only else images)
    if texts:
        shown = F.when(F.size("imgs") > 0, F.col("_body"))
        parsed = evaluate_once(
            parsed, prediction_text=render(main_content(shown), "prediction")
        )
    else:
        parsed = parsed.withColumn("prediction_text", F.lit(None).cast("string"))
    passed = parsed.withColumn("item_dir", parent(F.col("archive"))).withColumn(
        "_passed", text_filter(F.col("prediction_text"))
    )
    outcome = outcome_page(F.col("_passed"))
    judged = evaluate_once(passed, outcome=outcome)
    going_on = F.col("outcome") == ""
    export = F.when(going_on, render(main_content(F.col("_body")), "export"))
    pages = materialize(
        judged.select(
            *PAGE_KEYS,
            "item_dir",
            F.col("target_uri").alias("text_url"),
            "outcome",
            F.when(going_on, F.col("imgs")).alias("imgs"),
            F.when(going_on, F.col("prediction_text")).alias("prediction_text"),
            (export if texts else F.lit(None).cast("string")).alias("export_text"),
        ),
        "pages",
    )
    keys = [*PAGE_KEYS, "item_dir"]
    asked = page_images(pages.filter(F.col("outcome") == ""), keys)
    wanted = materialize(image_references(asked), "wanted")
    index = read_index(spark, roots, wanted)
    items = broadcast_if_bounded(usable_items(index.files), index.files.count())
    indexed = pages.join(items.withColumn("index_usable", F.lit(True)), "item_dir", "left")
    records = indexed.withColumn(
        "outcome", outcome_indexed(F.col("outcome"), F.col("index_usable"))
    ).drop("index_usable")
    table = image_table(
        wanted.join(items, "item_dir", "left_semi"), latest_captures(index.lines), roots,
        max_content_length, decoder, fetch_mode, image_filter,
    )
    references = page_images(records.filter(F.col("outcome") == ""), keys)
    return PairTables(records, references, table)


def image_table(
    references: DataFrame,
    captures: DataFrame,
    roots: str | list[str],
    max_content_length: int = PAIR_CAP,
    decoder=None,
    fetch_mode: str = "range",
    image_filter: Callable[[Column], Column] = pass_all,
) -> DataFrame:
    """Each referenced image once: where it lies, its bytes and pixels, and its outcome."""
    spark = references.sparkSession
    located = materialize(references.join(captures, KEYS, "left"), "located")
    indexed = F.col("warc_path").isNotNull()
    n_fetched = located.filter(indexed).count()
    fetched = fetch_records(
        located.filter(indexed),
        max_content_length,
        fetch_mode,
        roots,
        keep=[*KEYS, "n_refs"],
        tasks=max(n_fetched // REFERENCES_PER_TASK, spark.sparkContext.defaultParallelism),
    )
    # The bytes stay where they were fetched; only references without a capture are added.
    found = fetched.unionByName(located.filter(~indexed), allowMissingColumns=True)
    valid = (
        F.col("error").isNull() & is_response() & is_supported_image() & image_url_matches()
    )
    slim = found.withColumn("payload", F.when(valid, F.col("payload")))
    decoded = decode_images(slim, KEYS, decoder)
    judged = decoded.withColumn(
        "outcome", outcome_pairs(image_filter(F.col("image")), F.lit(True))
    )
    return materialize(
        judged.select(
            *KEYS,
            "n_refs",
            "outcome",
            image_extension(F.col("content_type")).alias("extension"),
            "payload",
            "image",
        ),
        "image-table",
    )


def pair_rows(tables: PairTables, combined_filter: CombinedFilter | None = None) -> DataFrame:
    """One row per page and valid image, repeats kept, with page texts and image.

    With ``combined_filter`` rows failing it are dropped.
    """
    good = F.col("outcome") == NODE_RESULTS
    valid = tables.table.filter(good)
    counts = tables.table.select(*KEYS, "n_refs")
    size = F.col("image.height").cast("long") * F.col("image.width") * F.col("image.channels")
    found = tables.table.agg(
        F.sum("n_refs").alias("all"),
        F.sum(F.when(good, F.col("n_refs"))).alias("pairs"),
        F.sum(F.when(good, size)).alias("pixel_bytes"),
    ).first()
    total = found["all"] or 0
    spark = tables.table.sparkSession
    # with fewer tasks than the session's shuffles have the planner would deal the pixels once more
    tasks = max(
        (found["pairs"] or 0) // PAIRS_PER_TASK,
        (found["pixel_bytes"] or 0) // PIXEL_BYTES_PER_TASK,
        spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    # Slim rows first: which references lead to a valid image, then the texts of their pages.
    # Bytes and pixels come last, so they are shuffled once per image and not once per page.
    row = [*PAGE_KEYS, "position"]
    slim = join_unique(tables.images, valid.select(*KEYS), KEYS, counts, total, salt_on=row)
    pages = tables.pages().select(*PAGE_KEYS, "text_url", "prediction_text", "export_text")
    texts = pair_pages_images(pages, slim, PAGE_KEYS)
    images = valid.drop("outcome", "n_refs")
    pairs = join_unique(texts, images, KEYS, counts, total, heavy=True, salt_on=row, tasks=tasks)
    if combined_filter is not None:
        pairs = pairs.filter(combined_filter(F.col("prediction_text"), F.col("image")))
    return pairs.withColumnsRenamed({"url": "image_url", "alt": "alt_text"})


def pair_funnel(tables: PairTables, combined_filter: CombinedFilter | None = None) -> DataFrame:
    """``(counter, n)`` over records and image references of a pair job.

    Images are counted from the table of distinct images, weighted by their references; no
    join is needed unless a combined filter has to see page and image together.
    """
    page_level = funnel_counts(tables.records.filter(F.col("outcome") != ""))
    image_level = tables.table.groupBy(F.col("outcome").alias("counter")).agg(
        F.sum("n_refs").alias("n")
    )
    if combined_filter is None:
        return page_level.union(image_level).groupBy("counter").agg(F.sum("n").alias("n"))
    passed = F.coalesce(
        combined_filter(F.col("prediction_text"), F.col("image")), F.lit(False)
    )
    judged = funnel_counts(
        pair_rows(tables).select(
            F.when(passed, NODE_RESULTS).otherwise(COMBINED_FILTER_NOT_PASSED).alias("outcome")
        )
    )
    dropped = image_level.filter(F.col("counter") != NODE_RESULTS)
    return (
        page_level.union(dropped).union(judged).groupBy("counter").agg(F.sum("n").alias("n"))
    )


def pairs_job(tables: PairTables, combined_filter: CombinedFilter | None = None) -> DataFrame:
    """Page-image pairs, all of them scored 1.0."""
    return score_passthrough(pair_rows(tables, combined_filter))


def alt_text_job(
    tables: PairTables,
    tokenize: Callable[[Column], Column],
    make_predict_fn: Callable[[], Callable],
    threshold: float = SIMILARITY_THRESHOLD,
    pixels: int = 224,
) -> DataFrame:
    """Image and alt-text pairs whose similarity reaches the threshold.

    ``tables`` come from ``pair_tables(..., alt_only=True, texts=False)``.
    """
    rows = pair_rows(tables).withColumn("_tokens", tokenize(F.col("alt_text")))
    scored = score_pairs(rows, make_predict_fn, tokens="_tokens", size=pixels)
    return above_threshold(scored, threshold, inclusive=True).drop("_tokens")
