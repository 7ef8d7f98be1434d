"""HTML to text and images as native column expressions.

Everything that touches page-sized strings is built from Spark's own string functions, so it
runs inside the JVM and pages never travel to Python.

All quantified groups are possessive: they match in a loop, not by recursion, so long pages
cannot exhaust the JVM stack. A pattern that has read past its tag name always matches (a tag also
ends at the end of the page) or stops at the next ``<``, so no part of a page is read again and
again: time grows with the page, whatever is left unclosed in it.
"""

from __future__ import annotations

import json as _json
from html.entities import html5 as _html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element groups of the text rules.
INVISIBLE = "script|style|template|iframe|noframes|noembed|title"
BOILERPLATE = "nav|header|footer|aside|form"
FORM_FIELDS = "textarea|select|button"
BLOCKS = (
    "address|article|aside|blockquote|body|br|caption|center|dd|details|dialog|dir|div|dl|dt|"
    "fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|legend|li|main|"
    "menu|nav|ol|optgroup|option|p|pre|section|summary|table|tbody|td|tfoot|th|thead|tr|ul"
)
# Character references replaced without leaving the JVM; "&amp;" must be last.
REFERENCES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]

_BLOCK_PIECES = 512

_NAME_END = r"(?=[\s/>])"
_ATTRS = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
# A tag ends at ">", after a stray quote at the next one, and anyway at the end of the page.
_TAG_END = rf"(?:{_ATTRS}(?:>|\z)|[^>]*+(?:>|\z))"
_TAG_REST = _NAME_END + _TAG_END


def _element(names: str) -> str:
    """Pattern of a whole element whose content is skipped up to its own end tag."""
    return rf"<({names}){_TAG_REST}.*?(?:</\1{_NAME_END}[^>]*+(?:>|\z)|\z)"


_HIDDEN = (
    r"(?is)<(?:!--(?:-?>|.*?(?:--!?>|\z))"
    rf"|{_element(INVISIBLE)[1:]}"
    r"|[!?][^>]*+(?:>|\z))"
)
_TO_BODY = rf"(?is)\A(?:.*?<body{_TAG_REST}|.*?</head\s*+>)"
_ENDS_HEAD = r"(?i)<(?:body[\s/>]|/head\s*+>)"
_BLOCK_TAG = rf"(?i)</?(?:{BLOCKS}){_TAG_REST}"
_ANY_TAG = rf"</?[a-zA-Z]{_TAG_END}"
_OTHER_REFERENCE = (
    "&(?!(?:" + "|".join(name[1:-1] for name, _ in REFERENCES) + ");)(?:#|[A-Za-z])"
)
# Named references and the windows-1252 characters of 128..159 come from the standard library.
_NAMED = dict(_html5)
_LEGACY = "|".join(
    sorted((name for name in _NAMED if not name.endswith(";")), key=len, reverse=True)
)
_REFERENCE = rf"&(?:#[xX][0-9a-fA-F]+;?|#[0-9]+;?|[A-Za-z][A-Za-z0-9]*;|(?:{_LEGACY}))"
_WINDOWS_1252 = {
    str(code): bytes([code]).decode("windows-1252", "ignore") or chr(code)
    for code in range(0x80, 0xA0)
}
# A single plain space needs no replacement, so it is not matched.
_SPACES = r"[\t\n\x0B\f\r\u00a0][\s\u00a0]*+| [\s\u00a0]++"
_LINE_SPACES = r"[\t\x0B\f\r\u00a0][ \t\x0B\f\r\u00a0]*+| [ \t\x0B\f\r\u00a0]++"


def _up_to(tag: str, name: str) -> str:
    """Pattern of a start tag up to the value of one attribute.

    Attributes before it are skipped one by one, so a value that merely contains
    ``src=`` is never mistaken for the attribute. A ``<`` outside quotes ends the search.
    """
    other = (
        rf"[\s/]*+(?!{name}[\s=])[^\s=<>/\"']++"
        r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'<>]++))?+"""
    )
    return rf"(?is)<{tag}{_NAME_END}(?:{other})*+[\s/]*+{name}\s*+=\s*+"


def _attribute(tag: str, name: str) -> str:
    """Pattern that reads one attribute of a start tag in groups 1..3 (by quoting style)."""
    return _up_to(tag, name) + r"""(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""


def attribute(tag_source: Column, tag: str, name: str) -> Column:
    """Value of an attribute of the given start tag; empty when absent."""
    pattern = _attribute(tag, name)
    return F.concat(*[F.regexp_extract(tag_source, pattern, i) for i in (1, 2, 3)])


def strip_hidden(html: Column) -> Column:
    """Remove comments, declarations and elements that never show text."""
    return F.regexp_replace(html, F.lit(_HIDDEN), F.lit(""))


def body_html(html: Column) -> Column:
    """Markup of the page body without hidden parts.

    A page without a ``<body>`` tag has an implied body: all that follows the head.
    """

    def from_body(shown: Column) -> Column:
        # a page with neither tag is all body: it is not searched for the one, then the other
        cut = F.regexp_replace(shown, F.lit(_TO_BODY), F.lit(""))
        return F.when(shown.rlike(_ENDS_HEAD), cut).otherwise(shown)

    return let(strip_hidden(html), from_body)


def has_body(html: Column) -> Column:
    """False only for frameset documents, the one kind of page without a body."""
    return html.rlike(r"(?i)<body[\s/>]") | ~html.rlike(r"(?i)<frameset[\s/>]")


def let(value: Column, body) -> Column:
    """Bind ``value`` to a name: ``body`` may use it many times, it is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan_elements(markup: Column, names: str, keep) -> Column:
    """Concatenate the pieces between the named tags for which ``keep(depth, closed)`` holds.

    ``depth`` counts open named elements after the piece's own tag; ``closed`` says that an
    outermost element ended before or at the piece.
    """

    def step(state: Column, piece: Column) -> Column:
        depth = (
            F.when(piece.rlike(rf"(?i)\A<(?:{names})[\s/>]"), state.depth + 1)
            .when(
                piece.rlike(rf"(?i)\A</(?:{names})[\s/>]"),
                F.greatest(state.depth - 1, F.lit(0)),
            )
            .otherwise(state.depth)
        )
        closed = state.closed | ((state.depth > 0) & (depth == 0))
        return F.struct(
            depth.alias("depth"),
            closed.alias("closed"),
            F.when(keep(depth, closed), F.concat(state.kept, piece))
            .otherwise(state.kept)
            .alias("kept"),
        )

    def start(depth: Column, closed: Column) -> Column:
        return F.struct(depth.alias("depth"), closed.alias("closed"), F.lit("").alias("kept"))

    # Kept text grows within a block only, and blocks are joined: a page of very many pieces
    # would otherwise be copied once per piece.
    def block(state: Column, pieces: Column, at: Column) -> Column:
        part = F.aggregate(F.slice(pieces, at, _BLOCK_PIECES), start(state.depth, state.closed), step)
        return let(
            part,
            lambda p: F.struct(
                p.depth.alias("depth"),
                p.closed.alias("closed"),
                F.concat(state.kept, p.kept).alias("kept"),
            ),
        )

    def scan(pieces: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(pieces), F.lit(_BLOCK_PIECES))
        return F.aggregate(
            firsts,
            start(F.lit(0), F.lit(False)),
            lambda state, at: block(state, pieces, at),
            lambda state: state.kept,
        )

    return let(F.split(markup, rf"(?i)(?=</?(?:{names})[\s/>])"), scan)


def first_element(markup: Column, name: str) -> Column:
    """Markup of the first such element, up to its matching end tag."""
    return _scan_elements(markup, name, lambda depth, closed: (depth > 0) & ~closed)


def without_elements(markup: Column, names: str) -> Column:
    """Markup without the named elements, nested ones included."""
    return _scan_elements(markup, names, lambda depth, closed: depth == 0)


def main_content(body: Column) -> Column:
    """Main part of a body: first ``article``, else first ``main``, else the body without
    navigation, header, footer, sidebar and forms."""
    return (
        F.when(body.rlike(r"(?i)<article[\s/>]"), first_element(body, "article"))
        .when(body.rlike(r"(?i)<main[\s/>]"), first_element(body, "main"))
        .otherwise(without_elements(body, BOILERPLATE))
    )


def _character(code: Column) -> Column:
    """Character of a numeric reference, with the replacements HTML prescribes."""
    table = F.from_json(F.lit(_json.dumps(_WINDOWS_1252)), "map<string,string>")
    return (
        F.when(code.between(0x80, 0x9F), F.try_element_at(table, code.cast("string")))
        .when(
            (code <= 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit("\ufffd")
        )
        .when((code < 0x20) & ~code.isin(0x09, 0x0A, 0x0C, 0x0D) | (code == 0x7F), F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _resolve(reference: Column, names: Column) -> Column:
    digits = F.regexp_extract(reference, r"&#[xX]?([0-9a-fA-F]+)", 1)
    code = F.when(F.length(F.ltrim(digits, F.lit("0"))) > 8, F.lit(0x110000)).otherwise(
        F.when(reference.rlike("^&#[xX]"), F.conv(digits, 16, 10))
        .otherwise(digits)
        .cast("long")
    )
    legacy = F.regexp_extract(reference, rf"^&({_LEGACY})", 1)
    prefix_value = F.concat(
        F.try_element_at(names, legacy),
        F.substring(reference, F.length(legacy) + 2, F.length(reference)),
    )
    return F.when(reference.startswith("&#"), _character(code)).otherwise(
        F.coalesce(
            F.try_element_at(names, F.substring(reference, F.lit(2), F.length(reference))),
            prefix_value,
            reference,
        )
    )


def _unescape_any(text: Column) -> Column:
    table = F.from_json(F.lit(_json.dumps(_NAMED)), "map<string,string>")
    found = F.regexp_extract_all(text, F.lit(_REFERENCE), 0)
    references = let(table, lambda names: F.transform(found, lambda r: _resolve(r, names)))
    return F.array_join(
        F.zip_with(
            F.split(text, _REFERENCE),
            F.concat(references, F.array(F.lit(""))),
            lambda part, char: F.concat(part, char),
        ),
        "",
    )


def unescape(text: Column) -> Column:
    """Resolve character references the way HTML text does.

    Texts holding only the common references take a few plain replacements; any other
    reference takes the general way.
    """

    def replaced(t: Column) -> Column:
        plain = t
        for name, char in REFERENCES:
            plain = F.replace(plain, F.lit(name), F.lit(char))
        return (
            F.when(~t.contains("&"), t)
            .when(t.rlike(_OTHER_REFERENCE), _unescape_any(t))
            .otherwise(plain)
        )

    return let(text, replaced)


def prediction_markup(main: Column) -> Column:
    """Tag-free main content for models: no form fields, no noscript, blocks become spaces."""
    text = F.regexp_replace(main, F.lit(rf"(?is){_element('noscript|' + FORM_FIELDS)}"), F.lit(""))
    text = F.regexp_replace(text, F.lit(_BLOCK_TAG), F.lit(" "))
    return F.regexp_replace(text, F.lit(_ANY_TAG), F.lit(""))


def export_markup(main: Column) -> Column:
    """Tag-free main content for people: line breaks, bullets, image texts, links, fields."""
    text = F.regexp_replace(main, F.lit(_SPACES), F.lit(" "))
    text = F.regexp_replace(text, F.lit(_attribute("img", "alt") + _TAG_END), F.lit("$1$2$3"))
    # A link that is not closed ends where the next one begins.
    inside = r"[^<]*+(?:<(?!/?a[\s/>])[^<]*+)*+"
    text = F.regexp_replace(
        text,
        F.lit(_attribute("a", "href") + rf"{_TAG_END}({inside})(?:</a\s*+>|(?=<a[\s/>])|\z)"),
        F.lit("$4 ($1$2$3)"),
    )
    hidden = _up_to("input", "type") + rf"[\"']?+hidden[\"']?+{_NAME_END}{_TAG_END}"
    text = F.regexp_replace(text, F.lit(hidden), F.lit(""))
    text = F.regexp_replace(
        text, F.lit(_attribute("input", "value") + _TAG_END), F.lit("[ $1$2$3 ]")
    )
    text = F.regexp_replace(
        text, F.lit(rf"(?is)<textarea{_TAG_REST}(.*?)(?:</textarea\s*+>|\z)"), F.lit("[ $1 ]")
    )
    inside = r"[^<]*+(?:<(?!/?button[\s/>])[^<]*+)*+"
    text = F.regexp_replace(
        text,
        F.lit(rf"(?is)<button{_TAG_REST}({inside})(?:</button\s*+>|(?=<button[\s/>])|\z)"),
        F.lit("[ $1 ]"),
    )
    text = F.regexp_replace(text, F.lit(rf"(?i)<li{_TAG_REST}"), F.lit("\n• "))
    text = F.regexp_replace(text, F.lit(_BLOCK_TAG), F.lit("\n"))
    return F.regexp_replace(text, F.lit(_ANY_TAG), F.lit(""))


def squeeze(text: Column) -> Column:
    """One line: runs of whitespace become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(text, F.lit(_SPACES), F.lit(" ")))


def squeeze_lines(text: Column) -> Column:
    """Lines kept: blank lines and spaces around line breaks are removed."""
    text = F.regexp_replace(text, F.lit(_LINE_SPACES), F.lit(" "))
    text = F.regexp_replace(text, F.lit(r" ?+\n[ \n]*+"), F.lit("\n"))
    return F.trim(F.regexp_replace(text, F.lit(r"\A[ \n]++|[ \n]++\z"), F.lit("")))


def render(main: Column, mode: str) -> Column:
    """Text of main-content markup; ``mode`` is ``prediction`` or ``export``."""
    if mode == "prediction":
        return squeeze(unescape(prediction_markup(main)))
    if mode == "export":
        return squeeze_lines(unescape(export_markup(main)))
    raise ValueError(f"unknown mode {mode!r}: use 'prediction' or 'export'")


def extract_text(html: Column, mode: str = "prediction") -> Column:
    """Main text of a page. ``mode`` is ``prediction`` (plain) or ``export`` (formatted)."""
    return render(let(body_html(html), main_content), mode)
