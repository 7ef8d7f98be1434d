"""URL resolution and the images a page shows."""

from __future__ import annotations

import html
import re
from html.entities import html5
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crawlsift.functions.html import attribute

IMAGE_REFERENCE = T.StructType(
    [T.StructField("url", T.StringType()), T.StructField("alt", T.StringType())]
)

_LEGACY = {name for name in html5 if not name.endswith(";")}
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)(?=([=A-Za-z0-9]?))")


def unescape_attribute(value: str) -> str:
    """Resolve references in an attribute value: unlike in text, a reference without ``;``
    stays when ``=`` or an alphanumeric follows (as in ``?a=1&copy=2``)."""
    if "&" not in value:
        return value

    def one(match: re.Match) -> str:
        source = match.group(0)
        if source.endswith(";") or source.startswith("&#"):
            return html.unescape(source)
        if source[1:] in _LEGACY and not match.group(1):
            return html.unescape(source)
        return source

    return _REFERENCE.sub(one, value)


def join_url(base: str | None, reference: str | None) -> str | None:
    """Absolute URL of a reference; a missing reference gives the base, an invalid one NULL."""
    if base is None:
        return None
    try:
        return urljoin(base, reference)
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def _resolve(base: pd.Series, reference: pd.Series) -> pd.Series:
    return pd.Series([join_url(b, r) for b, r in zip(base, reference)], dtype=object)


def resolve_url(base: Column, reference: Column) -> Column:
    """Absolute URL of ``reference`` on the page ``base``."""
    return _resolve(base, reference)


@F.arrow_udf(T.ArrayType(IMAGE_REFERENCE))
def _image_references(base: pa.Array, sources: pa.Array, alts: pa.Array) -> pa.Array:
    rows = []
    for url, srcs, texts in zip(base.to_pylist(), sources.to_pylist(), alts.to_pylist()):
        if srcs is None:
            rows.append(None)
            continue
        rows.append(
            [
                {
                    "url": join_url(url, unescape_attribute(src)),
                    "alt": unescape_attribute(alt),
                }
                for src, alt in zip(srcs, texts)
            ]
        )
    kind = pa.list_(pa.struct([("url", pa.string()), ("alt", pa.string())]))
    return pa.array(rows, kind)


def image_tags(body: Column) -> Column:
    """Source text of every ``<img>`` start tag in body markup, in order.

    A tag that is cut off by the end of the page, or whose quotes do not pair, is none.
    """
    name, whole = r"<img(?=[\s/>])", r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
    # the name stands before the alternatives, so that a page is searched for it once
    found = F.regexp_extract_all(body, F.lit(rf"(?is){name}(?:{whole}(?:>|\z)|[^>]*+(?:>|\z))"), 0)
    return F.filter(found, lambda tag: tag.rlike(rf"(?is)\A{name}{whole}>\z"))


def extract_images(body: Column, page_url: Column) -> Column:
    """Images of a page as ``array<struct<url, alt>>`` in document order, repeats kept.

    Tags and attributes are read natively; only the short attribute values go to Python for
    URL resolution.
    """
    tags = image_tags(body)
    return _image_references(
        page_url,
        F.transform(tags, lambda t: attribute(t, "img", "src")),
        F.transform(tags, lambda t: attribute(t, "img", "alt")),
    )
