"""Pages: decoded markup, texts and images as columns, each evaluated once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlsift.functions.charset import decode_as, page_charset
from crawlsift.functions.html import body_html, has_body, main_content, render
from crawlsift.functions.urls import extract_images


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters must not recompute.

    The optimizer copies a projected expression into every filter pushed below it. Predicates
    on generated columns stay above the generator, so a costly text is computed once a row.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def decode_pages(records: DataFrame, output: str = "html") -> DataFrame:
    """Replace ``payload`` by decoded markup (NULL when the charset is unknown)."""
    charset = page_charset(F.col("payload"), F.col("http_charset"))
    known = evaluate_once(records, _charset=charset)
    html = decode_as(F.col("payload"), F.col("_charset"))
    return known.withColumn(output, html).drop("payload", "_charset")


def _texts_of_body(df: DataFrame, modes: tuple[str, ...]) -> DataFrame:
    """Replace ``_body`` by ``<mode>_text`` columns; the main content is found once."""
    found = df.withColumn("_main", main_content(F.col("_body")))
    texts = {f"{mode}_text": render(F.col("_main"), mode) for mode in modes}
    return evaluate_once(found, **texts).drop("_main", "_body")


def with_texts(
    df: DataFrame, html: str = "html", modes: tuple[str, ...] = ("prediction", "export")
) -> DataFrame:
    """Add ``<mode>_text`` columns."""
    return _texts_of_body(evaluate_once(df, _body=body_html(F.col(html))), modes)


def parse_pages(
    df: DataFrame,
    html: str = "html",
    url: str = "url",
    modes: tuple[str, ...] = ("prediction", "export"),
) -> DataFrame:
    """Add ``has_body``, ``imgs`` (``array<struct<url, alt>>``) and ``<mode>_text`` columns
    from one pass over the markup."""
    body = evaluate_once(df, _body=body_html(F.col(html)), has_body=has_body(F.col(html)))
    images = body.withColumn("imgs", extract_images(F.col("_body"), F.col(url)))
    return _texts_of_body(images, modes)
