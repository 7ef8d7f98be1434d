"""Charsets of pages that declare none."""

import random
import time

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from checks.queries import queries
from crawlsift.functions import charset
from crawlsift.functions.charset import MULTI_BYTE, CharsetGuess, _multi_byte_tables, _tally, _wide_characters, charset_detector, charset_profile, decode_html

JAPANESE = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所で泣いていた事だけは記憶している。"
CHINESE = "学而时习之，不亦说乎？有朋自远方来，不亦乐乎？人不知而不愠，不亦君子乎？我们今天去北京看了很多地方。"
TRADITIONAL = "學而時習之，不亦說乎？有朋自遠方來，不亦樂乎？人不知而不慍，不亦君子乎？我們今天去臺北看了很多地方。"
RUSSIAN = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему. Всё смешалось в доме."
POLISH = "Zażółć gęślą jaźń. Litwo, ojczyzno moja, ty jesteś jak zdrowie; ile cię trzeba cenić, ten tylko się dowie, kto cię stracił. Źdźbło trawy, śnieg i łąka."
FRENCH = "Longtemps, je me suis couché de bonne heure. Parfois, à peine ma bougie éteinte, mes yeux se fermaient si vite que je n'avais pas été prêt."
GREEK = "Άνδρα μοι έννεπε, μούσα, πολύτροπον, ος μάλα πολλά πλάγχθη, επεί Τροίης ιερόν πτολίεθρον έπερσε."
SINGLE = ["windows-1251", "koi8-r", "iso-8859-2", "windows-1250", "windows-1252", "cp850", "iso-8859-7", "mac-roman", "cp866"]


@pytest.fixture(scope="module")
def detect(spark):
    texts = [(RUSSIAN[::2] + RUSSIAN,), (RUSSIAN,), (POLISH,), (FRENCH,), (GREEK,), ("Größe, Straße, Äpfel, über, öffnen; niño, señor, mañana",), (None,)]
    return charset_detector(charset_profile(spark.createDataFrame(texts, "text string"), "text", SINGLE))


CASES = [
    (JAPANESE[5:], "shift_jis"), (JAPANESE[5:], "euc_jp"), (CHINESE[3:], "gb18030"), (TRADITIONAL[3:], "big5"),
    (RUSSIAN[10:80], "windows-1251"), (RUSSIAN[10:80], "koi8-r"), (RUSSIAN[10:80], "cp866"), (POLISH[8:90], "iso-8859-2"),
    (POLISH[8:90], "windows-1250"), (FRENCH[20:], "windows-1252"), (FRENCH[20:], "cp850"), (FRENCH[20:], "mac-roman"),
    (GREEK[:60], "iso-8859-7"), (FRENCH, "utf-16-le"), (FRENCH, "utf-16-be"), (FRENCH, "utf-8"), ("plain words", "ascii"),
]


def test_undeclared_pages(spark, detect):
    rows = [(i, f"<html><body><p>{text}</p></body></html>".encode(name), f"<html><body><p>{text}</p></body></html>") for i, (text, name) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, payload binary, want string")
    got = df.select("i", decode_html(F.col("payload"), F.lit(None).cast("string"), detect).alias("got"), "want").collect()
    assert {CASES[r.i] for r in got if r.got != r.want} == set()


def test_pages_that_say_their_charset_are_not_guessed(spark, detect):
    rows = [
        (RUSSIAN.encode("koi8-r"), "windows-1251", RUSSIAN.encode("koi8-r").decode("windows-1251")),
        (b"<meta charset=iso-8859-2>" + POLISH.encode("iso-8859-2"), None, "<meta charset=iso-8859-2>" + POLISH),
        (JAPANESE.encode("utf-16"), None, JAPANESE),
        (None, None, None),
        (b"", None, ""),
        (b"x", "utf-8", "x"),
    ]
    df = spark.createDataFrame(rows, "p binary, c string, want string")
    for r in df.select(decode_html(F.col("p"), F.col("c"), detect).alias("got"), "want").collect():
        assert r.got == r.want


def test_guesses_from_little():
    guess = CharsetGuess({}).guess
    assert guess("naïve café".encode("windows-1252")) == "windows-1252"
    assert guess(b"\xff\xfe\xfd\x80") == "windows-1252" and guess(b"\x80") == "windows-1252"
    assert guess(JAPANESE.encode("shift_jis")[:-1]) == "shift_jis"  # cut inside the last character
    assert guess(b"a" * 3_000_000 + b"\xe9") == "windows-1252"
    assert guess(JAPANESE.encode("euc_jp") * 3000) == "euc_jp"


def test_wide_characters_are_those_of_the_rules():
    rng = random.Random(5)
    kinds = [b"A 90", bytes(range(0x80, 0xA1)), bytes(range(0xA1, 0xFF)), b"\x8e\x8f", b"\xff", bytes(range(0x40, 0x7F)), bytes(range(0x30, 0x3A))]
    texts = [bytes(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(0, 24))) for _ in range(5000)]
    texts += [t.encode(name, "ignore")[cut:] for t in (JAPANESE, CHINESE, "𠀀é" * 9) for name in MULTI_BYTE for cut in (0, 1)]
    for name, (one, _, _) in MULTI_BYTE.items():
        whole, one = regex.compile(rb"(?:" + one + rb")*+"), regex.compile(one)
        for text in texts:
            end = whole.match(text).end()
            want = [(m.start(), len(m[0])) for m in one.finditer(text[:end]) if len(m[0]) > 1]
            places, lengths, _, got_end = _wide_characters(name, text)
            assert (list(zip(places.tolist(), lengths.tolist())), got_end) == (want, end), (name, text)


def test_characters_that_a_codec_reads_are_counted_as_by_the_rules():
    def pair(name, kind):
        first, second = rng.choice(pairs[name, kind])
        return bytes([first, second])

    rng = random.Random(6)
    pairs = {}
    for name, rules in _multi_byte_tables().items():
        for kind, table in (("any", rules.two), ("kana", rules.two if rules.kana is None else rules.kana), ("daily", rules.daily)):
            pairs[name, kind] = [divmod(int(i), 256) for i in np.flatnonzero(table)]
    odd = [b"A 90", bytes(range(0x80, 0xA1)), bytes(range(0xA1, 0xFF)), b"\x8e\x8f", b"\xff", bytes(range(0x40, 0x7F)), bytes(range(0x30, 0x3A))]
    texts = [bytes(rng.choice(rng.choice(odd)) for _ in range(rng.randint(0, 24))) for _ in range(3000)]
    for name in MULTI_BYTE:
        for _ in range(1500):
            kinds = rng.choice([["any"], ["kana"], ["daily"], ["any", "kana", "daily"]])
            texts.append(b"".join(rng.choice([b" a", b"x1", b""]) + pair(name, rng.choice(kinds)) for _ in range(rng.randint(1, 9))))
    texts += [TRADITIONAL.encode("big5") + b"\xa2\xcc\xa1\xc3", "丂ｱ亜".encode("euc_jp") * 9, "ｱｲ表示".encode("shift_jis") * 9, "㐀é中".encode("gb18030") * 9]
    read = 0
    for name, rules in _multi_byte_tables().items():
        for text in texts:
            wide, lengths, two, end = _wide_characters(name, text)
            want = None
            if len(text) - end <= 3:
                beside = np.zeros(len(wide), dtype=bool)
                beside[1:] |= wide[1:] == wide[:-1] + lengths[:-1]
                beside[:-1] |= wide[1:] == wide[:-1] + lengths[:-1]
                two = two[lengths == 2]
                want = (len(wide), beside.sum(), 0 if rules.kana is None else rules.kana[two].sum(), rules.daily[two].sum())
                read += len(wide) > 0
            assert _tally(name, text) == want, (name, text)
    assert read > 1000


def test_pages_that_a_codec_reads_are_not_read_by_the_rules(monkeypatch):
    """The rules take ten times as long."""
    monkeypatch.setattr(charset, "_wide_characters", None)
    for text, name in ((JAPANESE, "shift_jis"), (JAPANESE, "euc_jp"), (CHINESE, "gb18030"), (TRADITIONAL, "big5")):
        assert _tally(name, text.encode(name))[0] == len(text)


def test_undeclared_pages_go_through_python_once(spark, detect):
    df = spark.createDataFrame([(b"x", "utf-8")], "p binary, c string")
    plan = df.select(decode_html(F.col("p"), F.col("c"), detect))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_charsets_of_no_name_are_not_guessed(spark, detect):
    rows = [(FRENCH.encode("cp850"), "", None), (FRENCH.encode("cp850"), "no-such", None), (FRENCH.encode("cp850"), None, FRENCH), (b"", None, "")]
    df = spark.createDataFrame(rows, "p binary, c string, want string")
    for r in df.select(decode_html(F.col("p"), F.col("c"), detect).alias("got"), "want").collect():
        assert r.got == r.want


def test_query_of_undeclared_pages_leaves_out_those_with_too_little(spark, folder):
    texts = [(1, None), (2, ""), (3, "plain"), (4, "Ünï" * 2), (5, "1 ü 2 Ä 3"), (6, "größer " * 9), (7, "ΑΣ😀" * 3), (7, "ab")]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    with pytest.raises(Exception, match="UnicodeEncodeError"):
        queries()["undeclared_charsets"](spark, folder).collect()
    spark.createDataFrame(texts[:6], "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/x/documents.parquet")
    got = [(r.doc_id, r.charset) for r in queries()["undeclared_charsets"](spark, f"{folder}/x").collect()]
    always, latin, kana = ["utf-8", "utf-16-le"], ["windows-1252", "cp850", "mac-roman"], ["shift_jis", "euc_jp", "gb18030", "big5"]
    want = {1: always, 2: always + latin + kana, 3: always + latin, 4: always, 5: always, 6: always + latin + kana}
    assert sorted(got) == sorted((i, name) for i, names in want.items() for name in names)


def test_long_pages_are_guessed_without_a_python_step_a_character():
    """When its characters were looked at one by one, such a page ended in a MemoryError."""
    page = JAPANESE.encode("euc_jp") * 50_000
    started = time.process_time()
    assert CharsetGuess({}).guess(page) == "euc_jp"
    assert time.process_time() - started < 5


def test_profile(spark):
    table = spark.createDataFrame([("aé",), ("éé",), ("plain",), (None,), ("日é",)], "t string")
    got = {(r.charset, r.pair): r.n for r in charset_profile(table, "t", ["windows-1252", "cp850"]).collect()}
    assert got == {
        ("windows-1252", 0x61E9): 1, ("windows-1252", 0xE9E9): 1, ("cp850", 0x6182): 1, ("cp850", 0x8282): 1,
    }
    assert charset_profile(table.limit(0), "t", ["cp850"]).collect() == []
    with pytest.raises(ValueError, match="charsets"):
        charset_profile(table, "t", ["cp850"] * 65)
