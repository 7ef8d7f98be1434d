"""Registered queries: each runs one operator or job over whole given tables, or over the crawl
that Spark derives from the whole ``pages`` table."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

import crawl_fixture
from checks.sql import CAP, HAN, KANA, LATIN, MODEL_PIXELS, PATTERN, SUBWORD_MERGES, UNDECLARED, VOCABULARY_SIZE
from crawlsift.functions.charset import charset_detector, charset_profile, decode_html
from crawlsift.functions.html import body_html, extract_text, has_body
from crawlsift.functions.image import CHANNEL_MEAN, CHANNEL_STD, resize_images, similarity_inputs
from crawlsift.functions.language import language_detector, language_profile
from crawlsift.functions.naming import alt_metadata, export_name, pair_directory
from crawlsift.functions.numeric import class_probability
from crawlsift.functions.subwords import learn_merges, subword_decoder, subword_encoder, subword_vocabulary
from crawlsift.functions.tokens import build_vocabulary, tokenizer
from crawlsift.functions.urls import extract_images, resolve_url
from crawlsift.operators import filters as K
from crawlsift.operators import joins as J
from crawlsift.operators import outcome as O
from crawlsift.operators import score as S
from crawlsift.operators.decode import decode_images
from crawlsift.plans import image as image_plans
from crawlsift.plans import pairs as pair_plans
from crawlsift.plans import text as text_plans
from crawlsift.session import attach, materialize, spread, work_dir
from crawlsift.sinks.record_files import write_alt_pairs, write_pairs, write_record_files
from crawlsift.sinks.stats import report_rows, write_stats
from crawlsift.sources.cdx import latest_captures, not_revisit, read_cdx
from crawlsift.sources.dataset import dataset_shards, read_dataset, write_dataset
from crawlsift.sources.fetch import fetch_records
from crawlsift.sources.listing import list_archives, read_files
from crawlsift.sources.paths import base_name
from crawlsift.sources.warc import SLIM_COLUMNS, read_warc
from crawlsift.streaming.feed import (
    finish,
    finished_archives_of,
    funnel_snapshots,
    small_state,
    stream_dataset,
    stream_warc,
)

Query = Callable[[SparkSession, str], DataFrame]

#: Text bytes of a shard of the damaged dataset, all languages together.
SHARD_BYTES = 64 << 20

_shared: dict[tuple, object] = {}


def _once(build):
    """Keep one result per session and data folder: the crawl and models serve many queries."""

    @wraps(build)
    def get(spark: SparkSession, sf_dir: str):
        key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
        if key not in _shared:
            _shared[key] = build(spark, sf_dir)
        return _shared[key]

    return get


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    attach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a text table for CPU-bound work, spread when few tasks would scan it."""
    return spread(_table(spark, sf_dir, name).select(*columns))


@_once
def crawl(spark: SparkSession, sf_dir: str) -> str:
    """Root of the crawl derived from ``pages``."""
    attach(spark)
    spark.sparkContext.addPyFile(os.path.abspath(crawl_fixture.__file__))
    root = work_dir(spark, "crawl")
    crawl_fixture.build_crawl(spark, _table(spark, sf_dir, "pages"), root)
    return root


@_once
def detector(spark: SparkSession, sf_dir: str) -> Callable[[Column], Column]:
    return language_detector(
        language_profile(_texts(spark, sf_dir, "documents", "text", "lang"), "text", "lang")
    )


@_once
def vocabulary_tokenizer(spark: SparkSession, sf_dir: str) -> Callable[[Column], Column]:
    return tokenizer(
        build_vocabulary(_texts(spark, sf_dir, "documents", "text"), "text", VOCABULARY_SIZE)
    )


@_once
def decoded_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(image_plans.image_rows(_images(spark, sf_dir)), "decoded")


@_once
def tables(spark: SparkSession, sf_dir: str) -> pair_plans.PairTables:
    return pair_plans.pair_tables(spark, crawl(spark, sf_dir))


@_once
def alt_tables(spark: SparkSession, sf_dir: str) -> pair_plans.PairTables:
    return pair_plans.pair_tables(spark, crawl(spark, sf_dir), alt_only=True, texts=False)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_warc(spark, crawl(spark, sf_dir), columns=SLIM_COLUMNS, payload=[])


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_plans.read_pages(spark, crawl(spark, sf_dir))


def _regex_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_plans.read_regex_pages(spark, crawl(spark, sf_dir))


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_plans.read_images(spark, crawl(spark, sf_dir))


def _token_weights() -> np.ndarray:
    ids = np.arange(VOCABULARY_SIZE + 1)
    return ((ids * 37 + 50) % 101 - 50) / 1000.0


def _red_similarity() -> Callable:
    """Closed-form stand-in for a similarity model: mean red value, 0..100.

    Models are local functions, so they travel to the workers by value.
    """

    def make() -> Callable:
        def predict(ids, mask, pixels) -> list[float]:
            red = pixels[:, 0].mean(axis=(1, 2)) * CHANNEL_STD[0] + CHANNEL_MEAN[0]
            return [round(float(r) * 100, 2) for r in red]

        return predict

    return make


def _sum_model() -> Callable:
    def make() -> Callable:
        return lambda vectors: vectors.astype(np.float64).sum(axis=1)

    return make


# --- sources --------------------------------------------------------------------------------


def list_archives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_archives(spark, crawl(spark, sf_dir)).select(
        base_name(F.col("path")).alias("name")
    )


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        base_name(F.col("archive")).alias("archive"),
        "warc_type",
        "target_uri",
        "content_type",
        "has_http_headers",
    )


def warc_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of all sound records, and the errors of each archive, read in small splits."""
    attach(spark)
    spark.sparkContext.addPyFile(os.path.abspath(crawl_fixture.__file__))
    root = work_dir(spark, "damaged")
    crawl_fixture.build_damaged_crawl(spark, _table(spark, sf_dir, "pages"), root)
    records = read_warc(
        spark, root, columns=["archive", "target_uri", "error"], payload=[], split_bytes=4_000
    )
    broken = F.col("error").isNotNull()
    return (
        records.groupBy(
            base_name(F.col("archive")).alias("archive"), F.col("target_uri").alias("url"), broken.alias("broken")
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def warc_page_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = text_plans.html_only(_pages(spark, sf_dir)).filter(F.col("html").isNotNull())
    pages = _table(spark, sf_dir, "pages").select(F.col("url").alias("target_uri"))
    return html.join(pages, "target_uri", "left_semi").select(
        F.col("target_uri").alias("url"), F.md5(F.col("html")).alias("html_md5")
    )


def within_content_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir).filter(K.within_content_length(CAP))
    return records.groupBy("warc_type").agg(F.count(F.lit(1)).alias("n"))


def _item(df: DataFrame) -> DataFrame:
    return df.withColumn("item", base_name(F.col("item_dir")))


def cdx_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every index line with the record it points at: archive, URL, and records before it there."""
    order = W.partitionBy("archive").orderBy("record_offset")
    records = _records(spark, sf_dir).select(
        F.col("archive").alias("warc_path"), F.col("record_offset").alias("offset"), "target_uri",
        (F.row_number().over(order) - 1).cast("long").alias("place"),
    )
    rows = _item(read_cdx(spark, crawl(spark, sf_dir))).join(records, ["warc_path", "offset"], "left")
    stored = not_revisit(F.col("mime"))
    return rows.select(
        "item", "url", "mime", base_name(F.col("warc_path")).alias("archive"),
        F.when(stored, F.col("target_uri")).alias("target_uri"), F.when(stored, F.col("place")).alias("place"),
    )


def cdx_wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of the images that pages show, from indexes read for these URLs only."""
    wanted = _page_images(spark, sf_dir).select("item_dir", "url")
    lines = read_cdx(spark, crawl(spark, sf_dir), wanted)
    return _positions(J.locate_images(_page_images(spark, sf_dir), latest_captures(lines)))


def latest_captures_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item(latest_captures(read_cdx(spark, crawl(spark, sf_dir)))).select("item", "url")


def _fetched(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    root = crawl(spark, sf_dir)
    captures = latest_captures(read_cdx(spark, root))
    records = fetch_records(captures, mode=mode, roots=root)
    kept = records.filter(K.is_response() & K.is_supported_image())
    # an index line may point at the record of another URL: the record counts once
    images = decode_images(kept, ["warc_path", "offset"])
    return images.filter(F.col("image").isNotNull()).select(
        "target_uri", "image.height", "image.width"
    )


def fetch_records_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetched(spark, sf_dir, "range")


def fetch_records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetched(spark, sf_dir, "scan")


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["archive", "record_offset", "warc_type"]
    stream = stream_warc(
        spark, crawl(spark, sf_dir), max_files_per_trigger=_archives_a_batch(spark, sf_dir), payload=[], columns=columns
    )
    target = work_dir(spark, "streamed")
    stream_dataset(stream, target, work_dir(spark, "stream-checkpoint")).awaitTermination()
    return (
        spark.read.schema(stream.schema)
        .parquet(target)
        .groupBy(base_name(F.col("archive")).alias("archive"), "warc_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def warc_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page responses by filters that the archive source takes over."""
    records = read_warc(spark, crawl(spark, sf_dir), columns=SLIM_COLUMNS)
    whole = F.length("payload") == F.col("content_length")
    return records.filter(K.is_response() & K.is_html()).select(
        base_name(F.col("archive")).alias("archive"), "target_uri", whole.alias("whole")
    )


def _byte_stream(spark: SparkSession, sf_dir: str, columns: list[str], payload: list[str], cap: int = 150_000) -> DataFrame:
    """The crawl as a stream whose batches are far smaller than its archives."""
    return stream_warc(
        spark,
        crawl(spark, sf_dir),
        payload=payload,
        columns=columns,
        split_bytes=40_000,
        log=work_dir(spark, "stream-log"),
        max_bytes_per_trigger=max(cap, _crawl_bytes(spark, sf_dir) // 12),
        marks=True,
    )


@_once
def _crawl_bytes(spark: SparkSession, sf_dir: str) -> int:
    return list_archives(spark, crawl(spark, sf_dir)).agg(F.sum("length")).first()[0] or 0


@_once
def _archives_a_batch(spark: SparkSession, sf_dir: str) -> int:
    """Archives of this crawl are small: a batch takes 16 of them, or a twelfth of a larger crawl."""
    return max(16, -(-list_archives(spark, crawl(spark, sf_dir)).count() // 12))


def stream_byte_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a stream with batches of bounded bytes, stopped once and started again."""
    stream = _byte_stream(spark, sf_dir, ["archive", "record_offset", "warc_type"], [])
    target, checkpoint = work_dir(spark, "streamed"), work_dir(spark, "stream-checkpoint")
    first = stream_dataset(stream, target, checkpoint)  # one batch of what is there
    first.awaitTermination()
    finish(stream_dataset(stream, target, checkpoint, "0 seconds"))
    records = spark.read.schema(stream.schema).parquet(target).filter("range_end IS NULL")
    return records.groupBy(base_name(F.col("archive")).alias("archive"), "warc_type").agg(F.count(F.lit(1)).alias("n"))


def stream_finished_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of a stream once they have been read to their end, with what was in them."""
    done = finished_archives_of(_byte_stream(spark, sf_dir, ["archive"], []))
    target = work_dir(spark, "finished")
    with small_state(spark):
        query = stream_dataset(done, target, work_dir(spark, "finished-checkpoint"), "0 seconds")
    finish(query)
    rows = spark.read.schema(done.schema).parquet(target)
    return rows.select(base_name(F.col("archive")).alias("archive"), "n_records", "n_errors")


def stream_funnel_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals of outcomes and of archives read to their end."""
    stream = _byte_stream(spark, sf_dir, SLIM_COLUMNS, [K.HTML_TYPE])
    target = work_dir(spark, "funnel")
    finish(
        funnel_snapshots(
            text_plans.text_outcomes(stream, _long),
            checkpoint=work_dir(spark, "funnel-checkpoint"),
            table_dir=target,
            interval="0 seconds",
            finished=True,
        )
    )
    return spark.read.schema("counter string, n long").parquet(target)


# --- predicates -----------------------------------------------------------------------------


def is_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _records(spark, sf_dir).groupBy(K.is_response().alias("passed"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def content_type_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.lit(False)
    return (
        _records(spark, sf_dir)
        .groupBy(
            F.coalesce(K.is_html(), no).alias("is_html"),
            F.coalesce(K.is_supported_image(), no).alias("is_image"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def header_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _records(spark, sf_dir)
        .groupBy(
            K.has_record_headers().alias("has_record_headers"),
            K.has_http_headers().alias("has_http_headers"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def min_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return documents.filter(K.min_text_length(F.col("text"))).select("doc_id")


def matches_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return documents.filter(K.matches_regex(F.col("text"), PATTERN)).select(
        "doc_id", K.count_matches(F.col("text"), PATTERN).alias("n_matches")
    )


def image_size_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = decoded_images(spark, sf_dir).filter(K.image_size_between(F.col("image")))
    return images.select("url", "image.height", "image.width")


def page_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = text_plans.html_only(_pages(spark, sf_dir)).filter(
        F.col("html").isNotNull()
    )
    images = extract_images(body_html(F.col("html")), F.col("target_uri"))
    found = html.withColumn("imgs", images)
    return found.select(
        F.col("target_uri").alias("url"),
        has_body(F.col("html")).alias("has_body"),
        K.has_images(F.col("imgs")).alias("has_images"),
        F.size(K.with_alt(F.col("imgs"))).cast("long").alias("n_with_alt"),
    )


def above_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding")[0].cast("double").alias("prediction")
    )
    strict = K.above_threshold(scored, 0.1).select("vec_id", F.lit(True).alias("strict"))
    inclusive = K.above_threshold(scored, 0.1, inclusive=True).select("vec_id")
    return inclusive.join(strict, "vec_id", "left").select(
        "vec_id",
        F.coalesce("strict", F.lit(False)).alias("strict"),
        F.lit(True).alias("inclusive"),
    )


# --- scalar functions -----------------------------------------------------------------------


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _texts(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", extract_text(F.col("html")).alias("text"))


def page_export_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _texts(spark, sf_dir, "pages", "page_id", "html")
    return pages.select("page_id", extract_text(F.col("html"), "export").alias("text"))


def decode_html_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _texts(spark, sf_dir, "pages", "page_id", "html")
    html = F.col("html")
    # the charset named by HTTP; NULL leaves it to detection
    encoded = F.array(
        *[
            F.struct(F.lit(i).alias("variant"), F.encode(html, wire).alias("payload"), F.lit(name).alias("charset"))
            for i, (wire, name) in enumerate(
                [("utf-8", "utf-8"), ("utf-8", None), ("iso-8859-1", "latin-1"), ("utf-16", "utf-16")]
            )
        ]
    )
    rows = pages.select("page_id", F.inline(encoded))
    decoded = decode_html(F.col("payload"), F.col("charset").cast("string"))
    return rows.select("page_id", "variant", F.md5(decoded).alias("html_md5"))


def charset_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charset_profile(_texts(spark, sf_dir, "documents", "text"), "text", ["windows-1252"])


#: Bytes of text that become pages in undeclared charsets at once.
UNDECLARED_BYTES = 2 << 20
_UNDECLARED_TYPE = T.ArrayType(T.StructType([T.StructField("charset", T.StringType()), T.StructField("payload", T.BinaryType())]))
_SCRIPTS = {"kana": KANA, "han": HAN}


@F.arrow_udf(_UNDECLARED_TYPE)
def _undeclared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Charset and bytes of a text's pages; those with too little to guess from are left out."""
    kind = pa.list_(pa.struct([("charset", pa.string()), ("payload", pa.binary())]))

    letters = np.array([ord(c) for c in LATIN])
    tables = {}
    for script, signs in _SCRIPTS.items():
        tables[script] = np.arange(letters.max() + 2, dtype=np.uint32)
        tables[script][letters] = [ord(c) for c in signs]

    def pages(text: str | None, lower: str | None) -> list[tuple[str, bytes | None]]:
        if text is None:
            return [(name, None) for name, _ in UNDECLARED if name in ("utf-8", "utf-16-le")]
        small = np.frombuffer(lower.encode("utf-32-le"), np.uint32)
        codes = {"latin": np.frombuffer(text.encode("utf-32-le"), np.uint32)}
        for script, table in tables.items():
            codes[script] = np.where(small < len(table), table[np.minimum(small, len(table) - 1)], small)
        beyond = {script: np.count_nonzero(c > 127) for script, c in codes.items()}
        shown = {script: c.tobytes().decode("utf-32-le") for script, c in codes.items()}
        kept = [(name, script) for name, script in UNDECLARED if not 1 <= beyond[script] <= 7 or name in ("utf-8", "utf-16-le")]
        return [(name, shown[script].encode(name)) for name, script in kept]

    for texts, lowers in batches:
        rows, size = [], 0
        for text, lower in zip(texts, lowers):
            rows.append([{"charset": name, "payload": data} for name, data in pages(text.as_py(), lower.as_py())])
            size += len(text.as_py() or "")
            if size > UNDECLARED_BYTES:
                yield pa.array(rows, kind)
                rows, size = [], 0
        if rows:
            yield pa.array(rows, kind)


def undeclared_charsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page in nine charsets that nothing declares, decoded by the guess.

    Two scripts come from the Latin letters one by one. Texts with fewer than eight letters beyond
    ASCII give a guess too little to go by and are left out, but those without any.
    """
    texts = _texts(spark, sf_dir, "documents", "doc_id", "text")
    profile = charset_profile(texts, "text", ["windows-1252", "cp850", "mac-roman"])
    rows = texts.select("doc_id", F.inline(_undeclared("text", F.lower("text"))))
    decoded = decode_html(F.col("payload"), F.lit(None).cast("string"), charset_detector(profile))
    return rows.select("doc_id", "charset", F.md5(decoded).alias("text_md5"))


def page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_images(spark, sf_dir).select(
        "text_url", F.col("position").cast("long").alias("position"),
        F.col("url").alias("image_url"), "alt",
    )


def _page_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.page_images(tables(spark, sf_dir).pages(), ["item_dir", "text_url"])


def resolve_url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = _table(spark, sf_dir, "pages").select(
        F.col("url").alias("page_url"),
        F.explode(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), 1)).alias("ref"),
    )
    return links.withColumn("resolved", resolve_url(F.col("page_url"), F.col("ref")))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocabulary(
        _texts(spark, sf_dir, "documents", "text"), "text", VOCABULARY_SIZE
    ).withColumn("id", F.col("id").cast("long"))


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = vocabulary_tokenizer(spark, sf_dir)(F.col("text"))
    rows = _texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tokens.alias("t"))
    weighted = F.transform("t.input_ids", lambda x, i: x.cast("long") * (i + 1))
    total = F.aggregate(weighted, F.lit(0).cast("long"), lambda s, x: s + x)
    mask = F.aggregate("t.attention_mask", F.lit(0).cast("long"), lambda s, x: s + x)
    return rows.select(
        "doc_id",
        F.size("t.input_ids").cast("long").alias("n_tokens"),
        total.alias("checksum"),
        mask.alias("mask_sum"),
    )


def subword_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pair merges of all documents, one at a time."""
    merges = learn_merges(_texts(spark, sf_dir, "documents", "text"), "text", SUBWORD_MERGES, per_round=1)
    rows = [(n, left, right, count) for n, (left, right, count) in enumerate(merges)]
    return spark.createDataFrame(rows, "step long, left string, right string, n long")


def subword_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as subword ids and back, and whether each id has its mask."""
    documents = _texts(spark, sf_dir, "documents", "doc_id", "text")
    vocabulary = subword_vocabulary(documents, "text", 256, per_round=64)
    encoded = documents.select("doc_id", subword_encoder(vocabulary)(F.col("text")).alias("t"))
    masked = F.size("t.input_ids") == F.aggregate("t.attention_mask", F.lit(0), lambda s, x: s + x)
    back = subword_decoder(vocabulary)(F.col("t.input_ids"))
    return encoded.select("doc_id", F.md5(back).alias("text_md5"), masked.alias("masked"))


def similarity_inputs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model inputs of every image with a text of its own, in the size that models take: ids, and
    the colour of the pixels."""
    images = decoded_images(spark, sf_dir).withColumn("alt", F.concat(F.lit("the picture of "), "url"))
    tokenize = vocabulary_tokenizer(spark, sf_dir)
    inputs = images.select("url", similarity_inputs(F.col("alt"), F.col("image"), tokenize, MODEL_PIXELS).alias("x"))
    n = MODEL_PIXELS**2

    def channel(k: int) -> Column:
        """The colour that the mean of a channel's scaled pixels stands for."""
        values = F.slice("x.pixels", 1 + n * k, n)
        mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x.cast("double")) / n
        return F.round((mean * CHANNEL_STD[k] + CHANNEL_MEAN[k]) * 255).cast("long")

    return inputs.select(
        "url",
        F.size("x.input_ids").cast("long").alias("n_ids"),
        F.size("x.attention_mask").cast("long").alias("n_mask"),
        F.size("x.pixels").cast("long").alias("n_pixels"),
        *[channel(k).alias(name) for k, name in enumerate(("red", "green", "blue"))],
    )


def language_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_profile(_texts(spark, sf_dir, "documents", "text", "lang"), "text", "lang")


def detect_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    detect = detector(spark, sf_dir)
    return _texts(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", detect(F.col("text")).alias("language")
    )


def language_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = text_plans.long_texts_in(detector(spark, sf_dir))
    return _texts(spark, sf_dir, "documents", "doc_id", "text").filter(passed(F.col("text"))).select("doc_id")


def class_probability_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.round(class_probability(F.col("embedding"), 0), 6).alias("p0"),
        F.round(class_probability(F.col("embedding"), 2), 6).alias("p2"),
    )


def export_name_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = (F.col("page_id") % 1000) / 1000.0
    return _table(spark, sf_dir, "pages").select(
        "page_id",
        export_name(F.col("url"), score, "txt").alias("name"),
        pair_directory(F.col("url"), F.concat("url", F.lit("/i.png"))).alias("pair_name"),
    )


def alt_metadata_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = alt_metadata(F.lit(1.5), F.col("source"), F.col("lang"), F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", meta.alias("meta"))


# --- images ---------------------------------------------------------------------------------


def decode_images_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded_images(spark, sf_dir).select(
        "url",
        "image.height",
        "image.width",
        "image.channels",
        F.length("image.data").cast("long").alias("n_bytes"),
        F.lower(F.hex(F.substring("image.data", 1, 3))).alias("first_pixel"),
    )


@F.pandas_udf(T.BinaryType())
def _text_png(texts: pd.Series, widths: pd.Series) -> pd.Series:
    """Texts as PNG images: their bytes are the pixels' channels, row by row, zeros at the end."""
    return pd.Series([crawl_fixture.png_of(t.encode("utf-8"), w) for t, w in zip(texts, widths)], dtype=object)


def decode_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an image, decoded: unlike those of one colour these tell rows, columns and
    channels apart."""
    crawl(spark, sf_dir)  # ships the module that makes images
    texts = _texts(spark, sf_dir, "documents", "doc_id", "text").filter("text <> ''")
    images = texts.select("doc_id", _text_png("text", 5 + F.col("doc_id") % 60).alias("payload"))
    return decode_images(images, ["doc_id"]).select(
        "doc_id", "image.height", "image.width", F.md5("image.data").alias("pixels_md5")
    )


def resize_images_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = decoded_images(spark, sf_dir).select(
        "url", resize_images(F.col("image"), 2, 3).alias("pixels")
    )

    def channel(k: int) -> Column:
        values = F.filter("pixels", lambda _, i: i % 3 == k)
        total = F.aggregate(values, F.lit(0.0), lambda s, x: s + x.cast("double"))
        return F.round(total * 255).cast("long")

    return images.select(
        "url",
        F.size("pixels").cast("long").alias("n_values"),
        channel(0).alias("red"),
        channel(1).alias("green"),
        channel(2).alias("blue"),
    )


# --- joins ----------------------------------------------------------------------------------


def locate_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = latest_captures(read_cdx(spark, crawl(spark, sf_dir)))
    return _positions(J.locate_images(_page_images(spark, sf_dir), captures))


def missing_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = latest_captures(read_cdx(spark, crawl(spark, sf_dir)))
    return _positions(J.missing_images(_page_images(spark, sf_dir), captures))


def _positions(df: DataFrame) -> DataFrame:
    return df.select("text_url", F.col("position").cast("long").alias("position"), "url")


def image_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _item(J.image_references(_page_images(spark, sf_dir))).select("item", "url", "n_refs")


def pairs_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_plans.pairs_job(tables(spark, sf_dir)).select(
        "text_url",
        F.col("position").cast("long").alias("position"),
        "image_url",
        "alt_text",
        "image.height",
        "image.width",
        "export_text",
        F.col("prediction").cast("double").alias("prediction"),
    )


def pairs_combined_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    def wide(text: Column, image: Column) -> Column:
        return F.length(text) > 10 * image["width"]

    return pair_plans.pairs_job(tables(spark, sf_dir), wide).select(
        "text_url", F.col("position").cast("long").alias("position"), "image_url"
    )


def _alt_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_plans.alt_text_job(
        alt_tables(spark, sf_dir), vocabulary_tokenizer(spark, sf_dir), _red_similarity()
    )


def alt_text_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alt_pairs(spark, sf_dir).select("text_url", "image_url", "alt_text", "prediction")


# --- aggregations ---------------------------------------------------------------------------


def _long(text: Column) -> Column:
    return K.min_text_length(text)


def funnel_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _pages(spark, sf_dir)
    return O.funnel_counts(text_plans.text_outcomes(records, _long))


def stream_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_warc(
        spark,
        crawl(spark, sf_dir),
        max_files_per_trigger=_archives_a_batch(spark, sf_dir),
        payload=[K.HTML_TYPE],
        columns=SLIM_COLUMNS,
    )
    target = work_dir(spark, "funnel")
    funnel_snapshots(
        text_plans.text_outcomes(stream, _long),
        checkpoint=work_dir(spark, "funnel-checkpoint"),
        table_dir=target,
    ).awaitTermination()
    return spark.read.schema("counter string, n long").parquet(target)


def stream_regex_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_warc(
        spark,
        crawl(spark, sf_dir),
        max_files_per_trigger=_archives_a_batch(spark, sf_dir),
        max_content_length=text_plans.REGEX_CAP,
        payload=[K.HTML_TYPE],
        columns=SLIM_COLUMNS,
    )
    passed = text_plans.regex_filter(PATTERN, detector(spark, sf_dir))
    judged = text_plans.text_outcomes(stream, passed)
    matches = K.count_matches(F.col("prediction_text"), PATTERN)
    target = work_dir(spark, "regex-stats")
    funnel_snapshots(
        judged,
        checkpoint=work_dir(spark, "regex-stats-checkpoint"),
        totals={O.REGEX_MATCHES: F.when(F.col("outcome") == O.NODE_RESULTS, matches)},
        table_dir=target,
    ).awaitTermination()
    counts = spark.read.schema("counter string, n long").parquet(target)
    return counts.filter(F.col("counter").isin(O.REGEX_MATCHES, O.NODE_RESULTS))


def funnel_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.funnel_counts(
        image_plans.image_outcomes(_images(spark, sf_dir), K.image_size_between)
    )


def funnel_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_plans.pair_funnel(tables(spark, sf_dir))


def finished_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.finished_archives(
        list_archives(spark, crawl(spark, sf_dir)), _records(spark, sf_dir)
    )


def regex_match_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").filter(
        K.min_text_length(F.col("text")) & K.is_language(F.col("lang"))
    )
    counted = rows.withColumn("n_matches", K.count_matches(F.col("text"), PATTERN))
    return O.regex_match_total(counted.filter(F.col("n_matches") > 0))


def write_stats_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_dir(spark, "stats")
    write_stats(funnel_text(spark, sf_dir), target)
    return spark.read.text(target)


# --- scoring --------------------------------------------------------------------------------


def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = vocabulary_tokenizer(spark, sf_dir)(F.col("text"))
    rows = _texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", tokens.alias("tokens"))
    scored = S.score_text(rows, S.linear_token_model(_token_weights()))
    return scored.select("doc_id", F.round("prediction", 6).alias("prediction"))


def score_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = decoded_images(spark, sf_dir).withColumn(
        "resized", resize_images(F.col("image"), 2, 3)
    )
    scored = S.score_image(images, S.mean_brightness_model(2, 3), 2, 3)
    return scored.select("url", F.round("prediction", 6).alias("prediction"))


def _similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    following = vectors.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("image_embedding")
    )
    pairs = vectors.join(following, "vec_id", "left")
    return S.score_similarity(pairs, "embedding", "image_embedding")


def score_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similarities(spark, sf_dir).select(
        "vec_id", F.round("prediction", 6).alias("prediction")
    )


def similarity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = K.above_threshold(_similarities(spark, sf_dir), 20.0, inclusive=True)
    return passed.select("vec_id", F.round("prediction", 6).alias("prediction"))


def score_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = S.score_passthrough(_table(spark, sf_dir, "documents"))
    return scored.select("doc_id", F.col("prediction").cast("double").alias("prediction"))


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = S.score(
        _table(spark, sf_dir, "embeddings"),
        _sum_model(),
        ["embedding"],
        return_type=T.DoubleType(),
        input_tensor_shapes=[[64]],
    )
    return scored.select("vec_id", F.round("prediction", 4).alias("prediction"))


# --- sinks ----------------------------------------------------------------------------------


def write_record_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = page_text(spark, sf_dir).select(
        F.concat(F.col("page_id").cast("string"), F.lit(".txt")).alias("name"),
        F.col("text").alias("body"),
    )
    target = work_dir(spark, "texts")
    write_record_files(texts, target)
    files = read_files(spark, target, "*.txt")
    return files.select(
        F.regexp_extract("path", r"/(\d+)\.txt$", 1).cast("long").alias("page_id"),
        F.md5("content").alias("body_md5"),
    )


def write_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_dir(spark, "pairs")
    keys = ("archive", "record_offset", "position")
    write_pairs(pair_plans.pairs_job(tables(spark, sf_dir)), target, keys)
    return _written_pairs(spark, target)


def _written_pairs(spark: SparkSession, target: str) -> DataFrame:
    """Every file of the pair folders: texts by their digest, images by what they show."""
    files = read_files(spark, target, "*").filter(F.col("length") > 0)
    text = base_name(F.col("path")).endswith(".txt")
    decoded = decode_images(files.withColumn("payload", F.when(~text, F.col("content"))), ["path"])
    pixels = F.col("image.data")
    return decoded.select(
        F.regexp_extract("path", r"/([^/]*)-[0-9a-f]{12}/[^/]*$", 1).alias("folder"),
        base_name(F.col("path")).alias("file"),
        F.when(base_name(F.col("path")).endswith(".txt"), F.md5("content")).alias("text_md5"),
        "image.height",
        "image.width",
        F.md5(pixels).alias("pixels_md5"),
    )


def write_alt_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_dir(spark, "alt-pairs")
    keys = ("archive", "record_offset", "position")
    write_alt_pairs(_alt_pairs(spark, sf_dir), target, keys)
    lines = F.split(F.col("content").cast("string"), "\n")
    meta = read_files(spark, target, "meta.txt").select(
        F.regexp_extract("path", r"/([^/]*)/[^/]*$", 1).alias("folder"),
        lines[0].cast("double").alias("score"),
        F.array_join(F.slice(lines, 2, 3), "\n").alias("meta"),
    )
    images = _written_pairs(spark, target).filter("text_md5 IS NULL").drop("text_md5")
    named = meta.withColumn("folder", F.regexp_extract("folder", "(.*)-[0-9a-f]{12}$", 1))
    return named.unionByName(images, allowMissingColumns=True)


def overwrite_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an output that was overwritten after a job that failed half-way."""
    pages = _table(spark, sf_dir, "pages").select(F.concat("page_id", F.lit(".txt")).alias("name"), F.col("url").alias("body"), "page_id")
    target = work_dir(spark, "overwritten")
    write_record_files(pages, target)

    @F.udf("string")
    def failing(body: str) -> str:
        raise ValueError("no more")

    half = F.col("page_id") % 2 == 0
    try:
        write_record_files(pages.withColumn("body", F.when(half, "new").otherwise(failing("body"))), target, mode="overwrite")
        outcome = "wrote"
    except Exception:
        outcome = "failed"
    after_failure = _files_of(spark, target, outcome)
    write_record_files(pages.filter(half).withColumn("body", F.lit("new")), target, mode="overwrite")
    return after_failure.union(_files_of(spark, target, "overwritten"))


def _files_of(spark: SparkSession, target: str, state: str) -> DataFrame:
    files = read_files(spark, target, "*.txt").select(
        F.lit(state).alias("state"), base_name(F.col("path")).alias("name"), F.col("content").cast("string").alias("body")
    )
    return materialize(files, "files")


def dataset_shards_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of a dataset of which those of one language are cut off and those of another have
    bytes changed: which are sound, and how many rows are read."""
    target = work_dir(spark, "shards")
    rows = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = -(-size // SHARD_BYTES) or 1
    dealt = rows.withColumn("n", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_shards)))
    dealt.repartition(n_shards, "lang", "n").drop("n").write.partitionBy("lang").parquet(target)
    damage = (
        read_files(spark, target, "*.parquet")
        .select(F.regexp_extract("path", "/lang=([^/]*)/", 1).alias("lang"), F.regexp_extract("path", "(lang=[^/]*/[^/]*)$", 1).alias("name"), "content", "length")
        .filter(F.col("lang").isin("fr", "es"))
    )
    half = (F.col("length") / 2).cast("int")
    body = F.when(F.col("lang") == "fr", F.substring("content", F.lit(1), half)).otherwise(
        F.overlay("content", F.unhex(F.repeat(F.lit("a5"), F.lit(400))), half)
    )
    write_record_files(damage.select("name", body.alias("body")), target)
    schema = "doc_id long, text string, lang string"
    read = read_dataset(spark, target, schema).groupBy("lang").agg(F.count(F.lit(1)).alias("n_read"))
    shards = dataset_shards(spark, target, deep=True).select(
        F.regexp_extract("shard", "/lang=([^/]*)/", 1).alias("lang"), "sound", F.col("problem").substr(1, 6).alias("problem"), "rows"
    )
    shards = shards.groupBy("lang").agg(
        F.bool_and("sound").alias("sound"), F.min("problem").alias("problem"), F.sum("rows").alias("rows")
    )
    # How much of a shard with changed bytes can be read depends on where its pages lie.
    spoiled = F.col("lang") == "es"
    return shards.join(read, "lang", "left").select(
        "lang",
        "sound",
        "problem",
        F.when(~spoiled, F.col("rows")).alias("rows"),
        F.when(~spoiled, F.coalesce("n_read", F.lit(0))).alias("n_read"),
    )


def write_dataset_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_dir(spark, "dataset")
    scored = S.score_passthrough(
        _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    )
    write_dataset(scored, target)
    return read_dataset(spark, target, scored.schema).withColumn(
        "prediction", F.col("prediction").cast("double")
    )


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select(
        F.col("source").alias("url"),
        F.round(F.col("n_chars") / 1000.0, 3).alias("prediction"),
        "text",
    )
    return report_rows(rows, "url")


# --- jobs -----------------------------------------------------------------------------------


def regex_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    detect = detector(spark, sf_dir)
    documents = _texts(spark, sf_dir, "documents", "text")
    return O.regex_match_total(text_plans.regex_texts(documents, "text", PATTERN, detect))


def regex_job_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_plans.regex_job(_regex_pages(spark, sf_dir), PATTERN, detector(spark, sf_dir))


def regex_job_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text_plans.regex_job(
        _regex_pages(spark, sf_dir), PATTERN, detector(spark, sf_dir), keep_texts=True
    )
    return rows.select("url", F.col("n_matches").cast("long").alias("n_matches"), "export_text")


def text_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text_plans.text_job(
        _pages(spark, sf_dir),
        text_plans.long_texts_in(detector(spark, sf_dir)),
        vocabulary_tokenizer(spark, sf_dir),
        S.linear_token_model(_token_weights()),
    )
    return rows.select("url", "export_text", F.round("prediction", 6).alias("prediction"))


def image_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = image_plans.image_job(
        _images(spark, sf_dir), S.mean_brightness_model(*image_plans.MODEL_SIZE)
    )
    return rows.select(
        "url", "image.height", "image.width", F.round("prediction", 6).alias("prediction")
    )


def dataset_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = work_dir(spark, "image-dataset")
    image_plans.dataset_job(_images(spark, sf_dir), target)
    return read_dataset(spark, target).select(
        "url", "image.height", "image.width", F.col("prediction").cast("double").alias("prediction")
    )


def queries() -> dict[str, Query]:
    return {
        "list_archives": list_archives_query,
        "warc_records": warc_records,
        "warc_damaged": warc_damaged,
        "warc_page_roundtrip": warc_page_roundtrip,
        "within_content_length": within_content_length,
        "cdx_rows": cdx_rows,
        "cdx_wanted": cdx_wanted,
        "latest_captures": latest_captures_query,
        "fetch_records_range": fetch_records_range,
        "fetch_records_scan": fetch_records_scan,
        "stream_records": stream_records,
        "warc_pushed": warc_pushed,
        "stream_byte_batches": stream_byte_batches,
        "stream_finished_archives": stream_finished_archives,
        "stream_funnel_finished": stream_funnel_finished,
        "is_response": is_response,
        "content_type_predicates": content_type_predicates,
        "header_predicates": header_predicates,
        "min_text_length": min_text_length,
        "matches_regex": matches_regex,
        "image_size_between": image_size_between,
        "page_features": page_features,
        "above_threshold": above_threshold,
        "page_text": page_text,
        "page_export_text": page_export_text,
        "decode_html": decode_html_query,
        "charset_profile": charset_profile_query,
        "undeclared_charsets": undeclared_charsets,
        "page_images": page_images,
        "resolve_url": resolve_url_query,
        "vocabulary": vocabulary,
        "tokenize": tokenize,
        "subword_merges": subword_merges,
        "subword_round_trip": subword_round_trip,
        "similarity_inputs": similarity_inputs_query,
        "language_profile": language_profile_query,
        "detect_language": detect_language,
        "language_filter": language_filter,
        "class_probability": class_probability_query,
        "export_name": export_name_query,
        "alt_metadata": alt_metadata_query,
        "decode_images": decode_images_query,
        "decode_pixels": decode_pixels,
        "resize_images": resize_images_query,
        "locate_images": locate_images,
        "missing_images": missing_images,
        "image_references": image_references,
        "pairs_job": pairs_job,
        "pairs_combined_filter": pairs_combined_filter,
        "alt_text_job": alt_text_job,
        "funnel_text": funnel_text,
        "stream_funnel": stream_funnel,
        "stream_regex_stats": stream_regex_stats,
        "funnel_image": funnel_image,
        "funnel_pairs": funnel_pairs,
        "finished_archives": finished_archives,
        "regex_match_total": regex_match_total,
        "write_stats": write_stats_query,
        "score_text": score_text,
        "score_image": score_image,
        "score_similarity": score_similarity,
        "similarity_filter": similarity_filter,
        "score_passthrough": score_passthrough,
        "score_batch": score_batch,
        "write_record_files": write_record_files_query,
        "write_pairs": write_pairs_query,
        "write_alt_pairs": write_alt_pairs_query,
        "overwrite_record_files": overwrite_record_files,
        "write_dataset": write_dataset_query,
        "dataset_shards": dataset_shards_query,
        "report": report,
        "regex_job": regex_job,
        "regex_job_archives": regex_job_archives,
        "regex_job_texts": regex_job_texts,
        "text_job": text_job,
        "image_job": image_job,
        "dataset_job": dataset_job,
    }
