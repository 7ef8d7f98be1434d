"""Page bytes to text.

A page whose charset nobody declares and whose bytes are no UTF-8 is guessed from its bytes: by the
rules of multi-byte encodings, which few other texts obey, and by byte-pair profiles of single-byte
ones, learnt from labelled texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_META = r"(?i)<meta[\s/](?:[^<>c]++|c(?!harset\s*+=))*+charset\s*+=\s*+[\"']?+\s*+([a-z0-9_:.\-]++)"
# Byte-order marks (hex) and the codecs that read them; longer ones come first.
BYTE_ORDER_MARKS = [
    ("0000FEFF", "utf-32"),
    ("FFFE0000", "utf-32"),
    ("EFBBBF", "utf-8-sig"),
    ("FEFF", "utf-16"),
    ("FFFE", "utf-16"),
]
# Charset labels the JVM path reads itself.
_UTF8 = ["utf-8", "utf8", "utf_8", "us-ascii", "ascii"]
# Multi-byte encodings as patterns of their characters, and the lead (and trail) bytes
# of kana and of the characters in daily use, which the standards put into blocks of their own.
#: name: (one character, kana or None, daily characters)
MULTI_BYTE = {
    "shift_jis": (
        rb"[\x00-\x7f\xa1-\xdf]|[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc]",
        rb"\x82[\x9f-\xf1]|\x83[\x40-\x96]",
        rb"\x81[\x40-\xac]|\x82[\x4f-\xf1]|\x83[\x40-\x96]|[\x88-\x97][\x40-\xfc]|\x98[\x40-\x72]",
    ),
    "euc_jp": (
        rb"[\x00-\x7f]|\x8e[\xa1-\xdf]|\x8f[\xa1-\xfe]{2}|[\xa1-\xfe]{2}",
        rb"[\xa4\xa5][\xa1-\xf6]",
        rb"[\xa1\xa3-\xa5\xb0-\xcf][\xa1-\xfe]",
    ),
    "gb18030": (
        rb"[\x00-\x80]|[\x81-\xfe](?:[\x40-\x7e\x80-\xfe]|[\x30-\x39][\x81-\xfe][\x30-\x39])",
        None,
        rb"[\xa1\xa3\xb0-\xd7][\xa1-\xfe]",
    ),
    "big5": (
        rb"[\x00-\x7f]|[\x81-\xfe][\x40-\x7e\xa1-\xfe]",
        None,
        rb"[\xa1-\xa3][\x40-\xfe]|[\xa4-\xc5][\x40-\xfe]|\xc6[\x40-\x7e]",
    ),
}
#: A multi-byte guess needs so many of its characters, half of them next to another one (accented
#: letters of single-byte texts stand alone), so large a share of them in daily use, and where a
#: script has kana, so large a share of kana.
LEAST_CHARACTERS = 4
LEAST_NEIGHBOURS = 0.5
LEAST_DAILY = 0.7
LEAST_KANA = 0.15
#: A page of UTF-16 without a mark has zero bytes on one side of so many of its pairs.
LEAST_ZEROS = 0.3
#: Profiles of more charsets than this are refused, as they travel to the workers.
MAX_CHARSETS = 64
WEIGHT_SCALE = 1_000_000
_PAIRS = 1 << 16
#: First bytes of a page that show most encodings to be another one's.
_HEAD = 1 << 10
#: What a character that a codec has read is: of several bytes, kana, in daily use, or one that bytes
#: of different kinds stand for.
_WIDE, _KANA, _DAILY, _UNCLEAR = 1, 2, 4, 8
_FALLBACK = "windows-1252"


def high_pairs(data: bytes) -> np.ndarray:
    """The pairs of neighbouring bytes of which one is not ASCII, as numbers."""
    values = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
    left, right = values[:-1], values[1:]
    return (left << 8 | right)[(left | right) >= 128]


def _count_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``high_pairs`` in order, and how often each occurs."""
    found = high_pairs(data)
    if len(found) < _PAIRS // 8:
        return np.unique(found, return_counts=True)
    counts = np.bincount(found, minlength=_PAIRS)
    (pairs,) = np.nonzero(counts)
    return pairs, counts[pairs]


def charset_profile(df: DataFrame, text: str, charsets: list[str]) -> DataFrame:
    """``(charset, pair, n, weight)``: the byte pairs of texts written in each of ``charsets``.

    A text counts for the charsets that have all of its characters. ``weight`` is the logarithm of
    the pair's smoothed share, in millionths. Counts combine before the shuffle; there are at most
    65,536 rows a charset.
    """
    if len(charsets) > MAX_CHARSETS:
        raise ValueError(f"more than {MAX_CHARSETS} charsets")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = {name: np.zeros(_PAIRS, dtype=np.int64) for name in charsets}
        for batch in batches:
            for body in batch["text"].dropna():
                if body.isascii():
                    continue
                for name in charsets:
                    try:
                        data = body.encode(name)
                    except UnicodeEncodeError:
                        continue
                    pairs, n = _count_pairs(data)
                    totals[name][pairs] += n
        for name, total in totals.items():
            (pairs,) = np.nonzero(total)
            yield pd.DataFrame({"charset": name, "pair": pairs.astype(np.int32), "n": total[pairs]})

    counts = (
        df.select(F.col(text).cast("string").alias("text"))
        .mapInPandas(count, "charset string, pair int, n long")
        .groupBy("charset", "pair")
        .agg(F.sum("n").alias("n"))
    )
    total = F.sum("n").over(W.partitionBy("charset"))  # at most _PAIRS rows a charset
    weight = F.round(WEIGHT_SCALE * F.log((F.col("n") + 1.0) / (total + float(_PAIRS))))
    return counts.select("charset", "pair", "n", weight.cast("long").alias("weight"))


@dataclass
class MultiByte:
    """An encoding's rules as tables over a byte or two: which bytes are characters, which bytes begin
    longer ones, which pairs are characters, kana, and characters in daily use. ``whole`` reads a
    short text by the same rules. ``kinds`` has the kind of each character that the codec knows."""

    whole: regex.Pattern
    single: np.ndarray
    lead: np.ndarray
    two: np.ndarray
    kana: np.ndarray | None
    daily: np.ndarray
    kinds: np.ndarray


def _kinds(name: str, two: np.ndarray, kana: np.ndarray | None, daily: np.ndarray) -> np.ndarray:
    """The kind of each code point that the codec ``name`` makes of bytes that obey the rules."""
    # four bytes of gb18030 are all that is left there
    out = np.full(0x110000, _WIDE if name == "gb18030" else _UNCLEAR, dtype=np.uint8)
    seen = set()
    pairs = np.flatnonzero(two).tolist()
    found = [(bytes([i]), 0) for i in range(256)]
    found += [(i.to_bytes(2, "big"), _WIDE | _KANA * (kana is not None and bool(kana[i])) | _DAILY * bool(daily[i])) for i in pairs]
    if name == "euc_jp":
        found += [(bytes([0x8F, i, j]), _WIDE) for i in range(0xA1, 0xFF) for j in range(0xA1, 0xFF)]
    for data, kind in found:
        try:
            text = data.decode(name)
        except UnicodeDecodeError:
            continue
        code = ord(text)
        out[code] = kind if code not in seen or out[code] == kind else _UNCLEAR
        seen.add(code)
    return out


@lru_cache
def _multi_byte_tables() -> dict[str, MultiByte]:
    def table(pattern: bytes, size: int) -> np.ndarray:
        rule = regex.compile(pattern)
        return np.array([rule.fullmatch(i.to_bytes(size, "big")) is not None for i in range(256**size)])

    out = {}
    for name, (one, kana, daily) in MULTI_BYTE.items():
        two = table(one, 2)
        lead = two.reshape(256, 256).any(axis=1)
        lead[0x8F] |= name == "euc_jp"
        whole = regex.compile(rb"(?:" + one + rb")*+")
        kana, daily = None if kana is None else table(kana, 2), table(daily, 2)
        out[name] = MultiByte(whole, table(one, 1), lead, two, kana, daily, _kinds(name, two, kana, daily))
    return out


def _wide_characters(name: str, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Characters of several bytes: where they begin, how long they are, their first two bytes as a
    number; and how far the bytes obey the rules.

    Bytes that begin longer characters may also end them. In a run of such bytes every second one
    begins a character, counted from the run's first byte, which no character before it takes.
    """
    rules = _multi_byte_tables()[name]
    values = np.frombuffer(data, dtype=np.uint8)
    size = len(values)
    place = np.arange(size, dtype=np.int32)
    lead = rules.lead[values]
    run = np.where(lead, 0, place + 1)
    if name == "euc_jp":  # bytes that set another character set begin characters only
        shift, third = values == 0x8E, values == 0x8F
        lead_only = shift | third
        run[shift], run[third] = place[shift] + 2, place[third] + 3
    np.maximum.accumulate(run, out=run)
    begins = np.empty(size, dtype=bool)
    begins[:1] = True
    ahead = place[1:] - run[:-1]
    begins[1:] = (ahead & 1 == 0) & (ahead >= 0)
    if name == "euc_jp":
        begins |= lead_only | ~lead
    wide = np.flatnonzero(begins & lead)
    ends = np.append(values, np.zeros(3, dtype=np.uint8))  # zero is no character's second byte
    pairs = values[wide].astype(np.int32) << 8 | ends[wide + 1]
    sound = rules.two[pairs]
    lengths = np.full(len(wide), 2)
    if name == "euc_jp":
        long = values[wide] == 0x8F
        lengths[long] = 3
        at = wide[long]
        sound[long] = np.all([(ends[at + k] >= 0xA1) & (ends[at + k] <= 0xFE) for k in (1, 2)], axis=0)
    elif name == "gb18030":  # four bytes are two pairs side by side that end in digits
        half = ~sound & (pairs & 255 >= 0x30) & (pairs & 255 <= 0x39)
        if half.any():
            order = np.arange(len(wide))
            goes_on = np.zeros(len(wide), dtype=bool)
            goes_on[1:] = half[1:] & half[:-1] & (np.diff(wide) == 2)
            odd = (order - np.maximum.accumulate(np.where(goes_on, 0, order))) & 1 == 1
            second = goes_on & odd
            first = np.zeros(len(wide), dtype=bool)
            first[:-1] = second[1:]
            sound |= first
            lengths[first] = 4
            kept = ~second
            wide, pairs, sound, lengths = wide[kept], pairs[kept], sound[kept], lengths[kept]
    wrong = np.flatnonzero(begins & ~lead & ~rules.single[values])
    end = min([size, *wrong[:1], *wide[~sound][:1]])
    within = int(np.searchsorted(wide, end))
    return wide[:within], lengths[:within], pairs[:within], int(end)


def _tally(name: str, data: bytes) -> tuple[int, int, int, int] | None:
    """How many characters of several bytes there are, are next to another one, are kana and are in
    daily use; None when the bytes do not obey the rules.

    The encoding's codec knows fewer characters than the rules allow and reads those that it knows
    alike. Only bytes that it does not know, and characters of two kinds, are looked at by the rules.
    """
    rules = _multi_byte_tables()[name]
    known = 0
    try:
        text = data.decode(name)
    except UnicodeDecodeError as error:
        known = error.start
    else:
        kinds = rules.kinds[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        if not (kinds & _UNCLEAR).any():
            wide = kinds & _WIDE != 0
            return np.count_nonzero(wide), _beside(wide[1:] & wide[:-1]), np.count_nonzero(kinds & _KANA), np.count_nonzero(kinds & _DAILY)
    head = data[:_HEAD]
    # a page may be cut off inside its last character
    if known < len(head) and len(head) - rules.whole.match(head, known).end() > 3:
        return None
    wide, lengths, pairs, end = _wide_characters(name, data)
    if len(data) - end > 3:
        return None
    pairs = pairs[lengths == 2]
    kana = 0 if rules.kana is None else np.count_nonzero(rules.kana[pairs])
    return len(wide), _beside(wide[1:] == wide[:-1] + lengths[:-1]), kana, np.count_nonzero(rules.daily[pairs])


def _beside(next_to: np.ndarray) -> int:
    """How many characters are next to another one, by which ones are next to the one before."""
    return np.count_nonzero(next_to) + np.count_nonzero(next_to[:1]) + np.count_nonzero(next_to[1:] & ~next_to[:-1])


def _multi_byte(data: bytes) -> str | None:
    """The multi-byte encoding whose rules the bytes obey and whose daily characters they are."""
    best, chosen = 0.0, None
    for name, rules in _multi_byte_tables().items():
        if best == 1:  # no later one has a larger share
            break
        found = _tally(name, data)
        if found is None:
            continue
        wide, beside, kana, daily = found
        if wide < LEAST_CHARACTERS or beside < LEAST_NEIGHBOURS * wide:
            continue
        if rules.kana is not None and kana < LEAST_KANA * wide:
            continue
        share = daily / wide
        if share >= LEAST_DAILY and share > best:
            best, chosen = share, name
    return chosen


def _unmarked_utf16(data: bytes) -> str | None:
    """UTF-16 without a byte-order mark, told by the zero bytes of its ASCII characters."""
    if len(data) < 4 or b"\0" not in data:
        return None
    even, half = len(data) & ~1, len(data) // 2
    first, second = data[:even:2].count(0) / half, data[1:even:2].count(0) / half
    if max(first, second) < LEAST_ZEROS or min(first, second) > LEAST_ZEROS / 4:
        return None
    return "utf-16-be" if first > second else "utf-16-le"


class CharsetGuess:
    """Guesses the charset of bytes that are no UTF-8; holds the profiles' weights."""

    def __init__(self, weights: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.names = sorted(weights)
        self.weights = np.zeros((len(self.names), _PAIRS))
        for i, name in enumerate(self.names):
            pairs, values = weights[name]
            # Pairs that a profile lacks weigh less than any that it has.
            self.weights[i] = min(values, default=0.0) - WEIGHT_SCALE
            self.weights[i, pairs] = values

    def guess(self, data: bytes) -> str:
        found = _unmarked_utf16(data) or _multi_byte(data)
        if found is not None:
            return found
        pairs, n = _count_pairs(data)
        if not self.names or not len(pairs):
            return _FALLBACK
        scores = self.weights[:, pairs] @ n
        best = int(scores.argmax())
        # Between charsets that read the page alike the usual one is taken.
        if _FALLBACK in self.names and scores[self.names.index(_FALLBACK)] >= scores[best]:
            return _FALLBACK
        return self.names[best]


class CharsetDetector:
    """Function ``bytes column -> charset`` for bytes that are no UTF-8 and declare none.

    The guess travels with the function. Null bytes give null.
    """

    def __init__(self, guess: CharsetGuess):
        @F.pandas_udf(T.StringType())
        def detect(payload: pd.Series) -> pd.Series:
            return pd.Series([None if data is None else guess.guess(bytes(data)) for data in payload], dtype=object)

        @F.pandas_udf(T.StringType())
        def decode(payload: pd.Series, charset: pd.Series) -> pd.Series:
            names = [guess.guess(bytes(d)) if c is None and d is not None else c for d, c in zip(payload, charset)]
            return pd.Series([_decoded(d, c) for d, c in zip(payload, names)], dtype=object)

        self.detect, self.decode = detect, decode

    def __call__(self, payload: Column) -> Column:
        return self.detect(payload)


def charset_detector(profile: DataFrame | None = None) -> CharsetDetector:
    """Function ``bytes column -> charset`` for bytes that are no UTF-8 and declare none.

    The profile has a proven bound (MAX_CHARSETS x 65,536 numbers) and travels with the function.
    Without one, single-byte pages are windows-1252. Null bytes give null.
    """
    weights: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    if profile is not None:
        bound = MAX_CHARSETS * _PAIRS
        rows = profile.select("charset", "pair", "weight").limit(bound + 1).toPandas()
        if len(rows) > bound:
            raise ValueError(f"profile exceeds {MAX_CHARSETS} charsets")
        for name, part in rows.groupby("charset"):
            weights[name] = part["pair"].to_numpy(), part["weight"].to_numpy(dtype=float)
    return CharsetDetector(CharsetGuess(weights))


def _decoded(data, name: str | None) -> str | None:
    """Text of bytes in a charset; None for one that has no codec."""
    if data is None or name is None:
        return None
    try:
        return bytes(data).decode(name, "replace")
    except LookupError:
        return None


@F.pandas_udf(T.StringType())
def _decode_other(payload: pd.Series, charset: pd.Series) -> pd.Series:
    return pd.Series([_decoded(d, c) for d, c in zip(payload, charset)], dtype=object)


def _known_charset(payload: Column, http_charset: Column) -> Column:
    """The HTTP charset, else the one of the byte-order mark, else the first that a ``<meta>`` declares."""
    declared = F.lower(F.regexp_extract(payload.cast("string"), _META, 1))
    head = F.hex(F.substring(payload, 1, 4))
    marked = F.lit(None).cast("string")
    for mark, name in reversed(BYTE_ORDER_MARKS):
        marked = F.when(head.startswith(mark), name).otherwise(marked)
    return F.coalesce(F.lower(http_charset), marked, F.when(declared != "", declared))


def _needs_guess(payload: Column) -> Column:
    return F.contains(payload, F.lit(b"\0")) | ~F.is_valid_utf8(payload.cast("string"))


def page_charset(
    payload: Column, http_charset: Column, detect: Callable[[Column], Column] | None = None
) -> Column:
    """Charset of a page: the HTTP one, else the one of its byte-order mark, else the first one
    that a ``<meta>`` declares, else UTF-8 when the bytes are valid UTF-8, else what ``detect``
    (a ``charset_detector``) makes of them, else windows-1252.

    Only pages that come to ``detect`` are sent to Python. UTF-16 of ASCII characters is valid
    UTF-8 with zero bytes, which no page in UTF-8 holds, so these go to ``detect``, too.
    """
    known = _known_charset(payload, http_charset)
    if detect is None:
        utf8 = F.is_valid_utf8(payload.cast("string"))
        return F.coalesce(known, F.when(utf8, F.lit("utf-8")), F.lit(_FALLBACK))
    unknown = known.isNull() & payload.isNotNull() & _needs_guess(payload)
    return F.coalesce(known, detect(F.when(unknown, payload)), F.lit("utf-8"))


def decode_as(payload: Column, charset: Column) -> Column:
    """Decode page bytes by a known charset; NULL when nobody knows the charset.

    UTF-8 stays in the JVM (malformed bytes become U+FFFD); only pages in another charset are
    sent to Python, where the codecs live.
    """
    utf8 = charset.isin(_UTF8)
    other = payload.isNotNull() & ~utf8
    return F.when(utf8, F.make_valid_utf8(payload.cast("string"))).otherwise(
        _decode_other(F.when(other, payload), F.when(other, charset))
    )


def decode_html(
    payload: Column, http_charset: Column, detect: Callable[[Column], Column] | None = None
) -> Column:
    """Decode page bytes by their HTTP charset, else the declared or detected one.

    A ``charset_detector`` guesses and decodes on one way through Python.
    """
    if not isinstance(detect, CharsetDetector):
        return decode_as(payload, page_charset(payload, http_charset, detect))
    known = _known_charset(payload, http_charset)
    jvm = F.when(known.isNull(), ~_needs_guess(payload)).otherwise(known.isin(_UTF8))
    text = detect.decode(F.when(~jvm, payload), known)
    return F.coalesce(text, F.when(jvm, F.make_valid_utf8(payload.cast("string"))))
