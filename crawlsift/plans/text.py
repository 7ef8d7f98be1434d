"""Text jobs: classification and regex counting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlsift.functions.html import extract_text
from crawlsift.operators.filters import (
    HTML_TYPE,
    above_threshold,
    count_matches,
    is_html,
    is_language,
    is_response,
    min_text_length,
)
from crawlsift.operators.outcome import NODE_RESULTS, outcome_text, regex_match_total
from crawlsift.operators.pages import decode_pages, evaluate_once, with_texts
from crawlsift.operators.score import BATCH_SIZE, score_text
from crawlsift.sources.warc import SLIM_COLUMNS, read_warc

# Fixed values of the text jobs.
TEXT_CAP = 4_000_000
REGEX_CAP = 1_000_000_000
TEXT_THRESHOLD = 0.9

TextFilter = Callable[[Column], Column]


def pass_all(_: Column) -> Column:
    return F.lit(True)


def long_texts_in(detect: Callable[[Column], Column], code: str = "en") -> TextFilter:
    """Long texts in one language; short ones are dropped before the detector sees them."""

    def passed(text: Column) -> Column:
        long_text = F.when(min_text_length(text), text)
        return min_text_length(text) & is_language(detect(long_text), code)

    return passed


def read_pages(
    spark: SparkSession, paths: str | list[str], max_content_length: int = TEXT_CAP
) -> DataFrame:
    """All records below the paths; only HTML records carry their bytes."""
    return read_warc(
        spark, paths, max_content_length, payload=[HTML_TYPE], columns=SLIM_COLUMNS
    )


def read_regex_pages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``read_pages`` for ``regex_job``, which counts in far longer pages than models read."""
    return read_pages(spark, paths, REGEX_CAP)


def html_only(records: DataFrame) -> DataFrame:
    """Records with decoded ``html`` where they are HTML responses, NULL elsewhere."""
    page = F.col("error").isNull() & is_response() & is_html()
    return decode_pages(records.withColumn("payload", F.when(page, F.col("payload"))))


def text_outcomes(records: DataFrame, text_filter: TextFilter = pass_all) -> DataFrame:
    """Every record with its ``outcome``; pages also with ``html`` and ``prediction_text``."""
    texts = with_texts(html_only(records), modes=("prediction",))
    passed = texts.withColumn("_passed", text_filter(F.col("prediction_text")))
    return passed.withColumn("outcome", outcome_text(F.col("_passed"))).drop("_passed")


def text_job(
    records: DataFrame,
    text_filter: TextFilter,
    tokenize: Callable[[Column], Column],
    make_predict_fn: Callable[[], Callable],
    threshold: float = TEXT_THRESHOLD,
    batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """``(archive, record_offset, url, export_text, prediction)`` of pages the model flags.

    One pass without a shuffle. The export text is rendered only for rows above the threshold.
    """
    kept = text_outcomes(records, text_filter).filter(F.col("outcome") == NODE_RESULTS)
    tokens = kept.withColumn("tokens", tokenize(F.col("prediction_text")))
    scored = score_text(tokens, make_predict_fn, batch_size=batch_size)
    positives = above_threshold(scored, threshold)
    return positives.select(
        "archive",
        "record_offset",
        F.col("target_uri").alias("url"),
        extract_text(F.col("html"), "export").alias("export_text"),
        "prediction",
    )


def regex_texts(
    df: DataFrame, text: str, pattern: str, detect: Callable[[Column], Column], code: str = "en"
) -> DataFrame:
    """Texts that are long, match, and are in the language, with ``n_matches``.

    The checks run in that order: the detector sees only long texts that match.
    """
    counted = evaluate_once(
        df.filter(min_text_length(F.col(text))), n_matches=count_matches(F.col(text), pattern)
    )
    return counted.filter(F.col("n_matches") > 0).filter(is_language(detect(F.col(text)), code))


def regex_filter(
    pattern: str, detect: Callable[[Column], Column], code: str = "en"
) -> TextFilter:
    """The same three checks as one predicate for ``text_outcomes``."""

    def passed(text: Column) -> Column:
        hit = min_text_length(text) & (count_matches(text, pattern) > 0)
        return hit & is_language(detect(F.when(hit, text)), code)

    return passed


def regex_job(
    records: DataFrame,
    pattern: str,
    detect: Callable[[Column], Column],
    code: str = "en",
    keep_texts: bool = False,
) -> DataFrame:
    """Count a pattern in long texts of one language, over the records of ``read_regex_pages``.

    Gives ``(n_regex_matches)``, or the passing rows with ``keep_texts``.
    """
    page = F.col("error").isNull() & is_response() & is_html() & F.col("target_uri").isNotNull()
    texts = with_texts(decode_pages(records.filter(page)), modes=("prediction",))
    kept = regex_texts(texts, "prediction_text", pattern, detect, code)
    if not keep_texts:
        return regex_match_total(kept)
    return kept.select(
        "archive",
        "record_offset",
        F.col("target_uri").alias("url"),
        "n_matches",
        extract_text(F.col("html"), "export").alias("export_text"),
        F.lit(1.0).cast("float").alias("prediction"),
    )
