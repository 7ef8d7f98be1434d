"""Why each record was kept or dropped, and the counters that sum it up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from crawlsift.operators.filters import (
    has_http_headers,
    has_record_headers,
    is_html,
    is_response,
    is_supported_image,
)

# Counter names.
RECORD_HEADERS_NONE = "n_record_headers_none"
HTTP_HEADERS_NONE = "n_http_headers_none"
WRONG_WARC_TYPE = "n_wrong_warc_type"
WRONG_CONTENT_TYPE = "n_wrong_content_type"
PARSING_EXCEPTION = "n_parsing_exception"
DECODING_EXCEPTION = "n_decoding_exception"
FILTER_NOT_PASSED = "n_distributed_filter_not_passed"
UNHANDLED = "n_unhandled_record_exceptions"
NODE_RESULTS = "n_node_results"
NO_BODY = "n_no_body"
NO_IMG_ELEMENTS = "n_no_img_elements"
TEXT_FILTER_NOT_PASSED = "n_distributed_text_filter_not_passed"
IMAGE_FILTER_NOT_PASSED = "n_distributed_image_filter_not_passed"
COMBINED_FILTER_NOT_PASSED = "n_distributed_combined_filter_not_passed"
INDEX_FILE_EXCEPTION = "n_index_file_exception"
IMG_NOT_FOUND = "n_img_not_found"
IMG_MISPLACED = "n_img_misplaced"
IMG_WRONG_CONTENT_TYPE = "n_img_wrong_content_type"
IMG_WRONG_WARC_TYPE = "n_img_wrong_warc_type"
FINISHED_ARCHIVES = "n_finished_warc_files"
REGEX_MATCHES = "n_regex_matches"

COUNTERS = [
    RECORD_HEADERS_NONE,
    HTTP_HEADERS_NONE,
    WRONG_WARC_TYPE,
    WRONG_CONTENT_TYPE,
    PARSING_EXCEPTION,
    DECODING_EXCEPTION,
    FILTER_NOT_PASSED,
    UNHANDLED,
    NODE_RESULTS,
]


def first_failure(checks: list[tuple[Column, str]], passed: str = NODE_RESULTS) -> Column:
    """Name of the first check whose condition is not true, else ``passed``."""
    out = F.lit(passed)
    for condition, counter in reversed(checks):
        out = F.when(F.coalesce(condition, F.lit(False)), out).otherwise(F.lit(counter))
    return out


def record_checks(accepted: Column) -> list[tuple[Column, str]]:
    """Checks on headers alone; ``accepted`` is the content-type predicate."""
    return [
        (F.col("error").isNull(), UNHANDLED),
        (has_record_headers(), RECORD_HEADERS_NONE),
        (has_http_headers(), HTTP_HEADERS_NONE),
        (F.col("warc_type").isNotNull(), UNHANDLED),
        (is_response(), WRONG_WARC_TYPE),
        (accepted, WRONG_CONTENT_TYPE),
        (F.col("target_uri").isNotNull(), UNHANDLED),
    ]


def html_checks() -> list[tuple[Column, str]]:
    return record_checks(is_html())


def image_checks() -> list[tuple[Column, str]]:
    return record_checks(is_supported_image())


def outcome_text(passed_filter: Column, text: str = "prediction_text") -> Column:
    """Terminal outcome of a record in a text job."""
    return first_failure(
        [
            *html_checks(),
            (F.col(text).isNotNull(), PARSING_EXCEPTION),
            (passed_filter, FILTER_NOT_PASSED),
        ]
    )


def outcome_image(passed_filter: Column, image: str = "image") -> Column:
    """Terminal outcome of a record in an image job."""
    return first_failure(
        [
            *image_checks(),
            (F.col(image).isNotNull(), DECODING_EXCEPTION),
            (passed_filter, FILTER_NOT_PASSED),
        ]
    )


def outcome_page(passed_filter: Column) -> Column:
    """Outcome of a page in a pair job by itself; empty for pages that go on to their images."""
    return first_failure(
        [
            *html_checks(),
            (F.col("html").isNotNull(), PARSING_EXCEPTION),
            (F.col("has_body"), NO_BODY),
            (F.size("imgs") > 0, NO_IMG_ELEMENTS),
            (passed_filter, TEXT_FILTER_NOT_PASSED),
        ],
        passed="",
    )


def outcome_indexed(outcome: Column, index_usable: Column) -> Column:
    """Outcome of a page once its item's index is known: images need a sound one."""
    usable = F.coalesce(index_usable, F.lit(False))
    return F.when((outcome == "") & ~usable, INDEX_FILE_EXCEPTION).otherwise(outcome)


def outcome_pairs(passed_image: Column, passed_both: Column, requested: str = "url") -> Column:
    """Outcome of one image of a page, from the located and fetched record.

    A reference that is no URL at all (NULL) counts as unhandled.
    """
    return first_failure(
        [
            (F.col(requested).isNotNull(), UNHANDLED),
            (F.col("warc_path").isNotNull(), IMG_NOT_FOUND),
            (F.col("error").isNull() & F.col("warc_type").isNotNull(), UNHANDLED),
            (is_response(), IMG_WRONG_WARC_TYPE),
            (is_supported_image(), IMG_WRONG_CONTENT_TYPE),
            (F.col("target_uri") == F.col(requested), IMG_MISPLACED),
            (F.col("image").isNotNull(), DECODING_EXCEPTION),
            (passed_image, IMAGE_FILTER_NOT_PASSED),
            (passed_both, COMBINED_FILTER_NOT_PASSED),
        ]
    )


def funnel_counts(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """``(counter, n)``: rows by outcome. Counts combine before the shuffle, so at most one
    row per counter leaves a task."""
    return df.groupBy(F.col(outcome).alias("counter")).agg(F.count(F.lit(1)).alias("n"))


def observe_funnel(
    df: DataFrame, observation: Observation, outcome: str = "outcome", counters=COUNTERS
) -> DataFrame:
    """Count outcomes beside the data: the observation fills while ``df`` is consumed."""
    counts = [F.count_if(F.col(outcome) == name).alias(name) for name in counters]
    return df.observe(observation, *counts)


def finished_archives(listing: DataFrame, records: DataFrame) -> DataFrame:
    """``(n_finished_warc_files)``: listed archives read to their end, also those without
    a record."""
    broken = records.filter(F.col("error").isNotNull()).select("archive").distinct()
    return (
        listing.join(broken, listing["path"] == broken["archive"], "left_anti")
        .agg(F.count_distinct("path").alias(FINISHED_ARCHIVES))
    )


def regex_match_total(df: DataFrame, n_matches: str = "n_matches") -> DataFrame:
    """``(n_regex_matches)``: matches summed over the rows given (those that passed)."""
    return df.agg(F.coalesce(F.sum(n_matches), F.lit(0)).alias(REGEX_MATCHES))
