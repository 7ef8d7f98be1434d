"""Oracle SQL (DuckDB) for the registered queries.

Everything is computed from the given tables. For queries on archives the expected rows follow
from what the crawl fixture documents about page ``p``; the archives themselves are not read.
"""

from __future__ import annotations

# Parameters shared with the queries.
PATTERN = "and the|of the|is on|the th"
VOCABULARY_SIZE = 2000
SUBWORD_MERGES = 6
# Height and width of the images that text-image models take.
MODEL_PIXELS = 224
CAP = 200_000
# The text of a page of 300,000 bytes: so many paragraphs of the same sentence.
LARGE_SENTENCE, LARGE_PARAGRAPHS = "The house of the town is on the hill, she said.", 5_556

# Charsets of pages that declare none, with the script of their text; letters and what stands for
# them in the other scripts.
UNDECLARED = [
    ("utf-8", "latin"), ("windows-1252", "latin"), ("cp850", "latin"), ("mac-roman", "latin"), ("utf-16-le", "latin"),
    ("shift_jis", "kana"), ("euc_jp", "kana"), ("gb18030", "han"), ("big5", "han"),
]
LATIN = "abcdefghijklmnopqrstuvwxyzäçèéêíñóöüß"
KANA = "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆ"
HAN = "的一是不了人我在有他中大上年生到地子出也自可下天心日成小水月山工力口文方手"

HOST = "http://img.example.org"

# --- pages of the crawl ---------------------------------------------------------------------

# tags: the <img> tags of a page; alts: what they add to the export text
PG = f"""
pg AS (
  SELECT page_id AS p, url, html, page_id // 100 AS item, page_id // 50 AS archive,
    CASE WHEN page_id % 10 = 3 THEN '' ELSE concat(
      '<img src="{HOST}/', page_id, '.png" alt="picture ', page_id, '">',
      '<img src="{HOST}/', page_id - page_id % 100, '.png" alt="">',
      CASE WHEN page_id % 2 = 0 THEN concat('<img class="x" src="/local/', page_id, '.png">') ELSE '' END,
      CASE WHEN page_id % 3 = 0 THEN concat('<img alt="none ', page_id, '">') ELSE '' END,
      CASE WHEN page_id % 10 = 6 THEN concat('<img alt=moved src={HOST}/moved-', page_id, '.png>') ELSE '' END,
      CASE WHEN page_id % 10 = 9 THEN concat('<img src=''{HOST}/revisit-', page_id, '.png'' alt=''gone''/>') ELSE '' END
    ) END AS tags,
    CASE WHEN page_id % 10 = 3 THEN '' ELSE concat(
      'picture ', page_id,
      CASE WHEN page_id % 3 = 0 THEN concat('none ', page_id) ELSE '' END,
      CASE WHEN page_id % 10 = 6 THEN 'moved' ELSE '' END,
      CASE WHEN page_id % 10 = 9 THEN 'gone' ELSE '' END
    ) END AS alts
  FROM pages
)"""


def _article(html: str) -> str:
    return f"regexp_extract({html}, '(?s)<article>(.*?)</article>', 1)"


def _entities(text: str) -> str:
    """The references pages use; HTML also reads them without their semicolon."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def page_text_sql(html: str) -> str:
    blocks = f"regexp_replace({_article(html)}, '</?(p|h1|br|li|ul|div)[^>]*>', ' ', 'g')"
    plain = f"regexp_replace({blocks}, '<[^>]+>', '', 'g')"
    return f"trim(regexp_replace({_entities(plain)}, '\\s+', ' ', 'g'))"


def export_text_sql(html: str, suffix: str = "''") -> str:
    flat = f"regexp_replace({_article(html)}, '\\s+', ' ', 'g')"
    lines = f"regexp_replace({flat}, '</?(p|h1|br|li|ul|div)[^>]*>', chr(10), 'g')"
    plain = f"concat(regexp_replace({lines}, '<[^>]+>', '', 'g'), {suffix})"
    squeezed = f"regexp_replace(regexp_replace({_entities(plain)}, ' +', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"trim({squeezed}, chr(10) || ' ')"


# --- language, tokens, scores ---------------------------------------------------------------

PROFILE = """
doc_codes AS (
  SELECT lang, list_transform(string_split(text, ''), lambda x: unicode(x)) AS c FROM documents
),
doc_grams AS (
  SELECT lang, unnest(list_transform(range(1, len(c) - 1),
    lambda i: (961 * c[i] + 31 * c[i + 1] + c[i + 2]) % 4096)) AS bucket
  FROM doc_codes WHERE len(c) >= 3
),
gram_counts AS (SELECT lang, bucket, count(*) AS n FROM doc_grams GROUP BY ALL),
gram_totals AS (SELECT lang, sum(n) AS total FROM gram_counts GROUP BY ALL),
profile AS (
  SELECT t.lang, b.bucket,
    CAST(round(1000000 * ln((coalesce(g.n, 0) + 1.0::DOUBLE) / (t.total + 4096.0::DOUBLE))) AS BIGINT) AS weight
  FROM gram_totals t CROSS JOIN (SELECT unnest(range(0, 4096)) AS bucket) b
  LEFT JOIN gram_counts g ON g.lang = t.lang AND g.bucket = b.bucket
)"""


def detect_sql(source: str, key: str, text: str) -> str:
    """CTEs ending in ``detected(key, language)`` for the texts of a relation."""
    return f"""
codes AS (
  SELECT {key} AS k, list_transform(string_split({text}, ''), lambda x: unicode(x)) AS c FROM {source}
),
grams AS (
  SELECT k, unnest(list_transform(range(1, len(c) - 1),
    lambda i: (961 * c[i] + 31 * c[i + 1] + c[i + 2]) % 4096)) AS bucket
  FROM codes WHERE len(c) >= 3
),
gram_n AS (SELECT k, bucket, count(*) AS n FROM grams GROUP BY ALL),
lang_scores AS (
  SELECT k, lang, sum(n * weight) AS s FROM gram_n JOIN profile USING (bucket) GROUP BY ALL
),
best AS (SELECT k, lang, row_number() OVER (PARTITION BY k ORDER BY s DESC, lang) AS rn FROM lang_scores),
detected AS (SELECT k AS {key}, lang AS language FROM best WHERE rn = 1)"""


VOCABULARY = f"""
words AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS token FROM documents),
word_counts AS (SELECT token, count(*) AS n FROM words GROUP BY ALL),
vocabulary AS (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS id FROM word_counts
  QUALIFY id <= {VOCABULARY_SIZE}
)"""

def text_score_sql(source: str, key: str, text: str) -> str:
    """CTE ``text_scores(key, prediction)``; words outside the vocabulary weigh 0."""
    return f"""
text_words AS (
  SELECT {key} AS k, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS token FROM {source}
),
logits AS (
  SELECT k, sum(((coalesce(id, 0) * 37 + 50) % 101 - 50) / 1000.0::DOUBLE) AS s
  FROM text_words LEFT JOIN vocabulary USING (token) GROUP BY k
),
text_scores AS (
  SELECT s.{key}, 1 / (1 + exp(-coalesce(l.s, 0))) AS prediction
  FROM {source} s LEFT JOIN logits l ON l.k = s.{key}
)"""


# --- images of the crawl --------------------------------------------------------------------

# every image capture: n = 0 first, 1 second; p % 10 = 0 has two
CAPTURES = """
captures AS (
  SELECT p, item, archive, 0 AS n, (120 + (p * 7) % 100)::INTEGER AS height, (130 + (p * 13) % 100)::INTEGER AS width,
    (p * 37) % 256 AS r, (p * 59) % 256 AS g, (p * 83) % 256 AS b FROM pg
  UNION ALL
  SELECT p, item, archive, 1, (121 + (p * 7) % 100)::INTEGER, (131 + (p * 13) % 100)::INTEGER,
    255 - (p * 37) % 256, 255 - (p * 59) % 256, 255 - (p * 83) % 256 FROM pg WHERE p % 10 = 0
),
good_captures AS (SELECT * FROM captures WHERE p % 10 NOT IN (7, 8)),
latest_images AS (
  SELECT * FROM good_captures c
  WHERE n = CASE WHEN p % 10 = 0 THEN 1 ELSE 0 END
)"""

#: Digest of an image's pixels, three bytes each (red, green, blue), row by row.
PIXELS_MD5 = "md5(unhex(repeat(printf('%02x%02x%02x', l.r::BIGINT, l.g::BIGINT, l.b::BIGINT), (l.height * l.width)::BIGINT)))"

# image references of pages: ord gives document order; target: page whose image is meant
REFERENCES = f"""
refs AS (
  SELECT p, url AS text_url, item, 0 AS ord, concat('{HOST}/', p, '.png') AS url,
    concat('picture ', p) AS alt, p AS target FROM pg WHERE p % 10 <> 3
  UNION ALL
  SELECT p, url, item, 1, concat('{HOST}/', p - p % 100, '.png'), '', p - p % 100 FROM pg WHERE p % 10 <> 3
  UNION ALL
  SELECT p, url, item, 2, concat(regexp_extract(url, '^(https?://[^/?#]+)', 1), '/local/', p, '.png'), '', NULL
  FROM pg WHERE p % 10 <> 3 AND p % 2 = 0
  UNION ALL
  SELECT p, url, item, 3, url, concat('none ', p), NULL FROM pg WHERE p % 10 <> 3 AND p % 3 = 0
  UNION ALL
  SELECT p, url, item, 4, concat('{HOST}/moved-', p, '.png'), 'moved', NULL FROM pg WHERE p % 10 = 6
  UNION ALL
  SELECT p, url, item, 5, concat('{HOST}/revisit-', p, '.png'), 'gone', NULL FROM pg WHERE p % 10 = 9
),
images AS (
  SELECT *, row_number() OVER (PARTITION BY p ORDER BY ord) - 1 AS position,
    CASE WHEN ord IN (0, 1) AND target % 10 = 7 THEN 'n_img_wrong_content_type'
         WHEN ord IN (0, 1) AND target % 10 = 8 THEN 'n_decoding_exception'
         WHEN ord IN (0, 1) THEN 'n_node_results'
         WHEN ord = 3 THEN 'n_img_wrong_content_type'
         WHEN ord = 4 THEN 'n_img_misplaced'
         ELSE 'n_img_not_found' END AS outcome
  FROM refs
)"""

# records of the crawl as (p, archive, kind)
RECORDS = """
records AS (
  SELECT p, item, archive, url, 'request' AS kind FROM pg
  UNION ALL SELECT p, item, archive, url, 'page' FROM pg
  UNION ALL SELECT p, item, archive, concat('http://img.example.org/', p, '.png'),
    CASE p % 10 WHEN 7 THEN 'svg' WHEN 8 THEN 'broken' ELSE 'image' END FROM pg
  UNION ALL SELECT p, item, archive, concat('http://img.example.org/', p, '.png'), 'image2' FROM pg WHERE p % 10 = 0
  UNION ALL SELECT p, item, archive, url, 'metadata' FROM pg WHERE p % 10 = 1
  UNION ALL SELECT p, item, archive, concat(url, '#short'), 'short' FROM pg WHERE p % 10 = 2
  UNION ALL SELECT p, item, archive, concat(url, '#pdf'), 'pdf' FROM pg WHERE p % 10 = 3
  UNION ALL SELECT p, item, archive, concat(url, '#frames'), 'frames' FROM pg WHERE p % 10 = 5
  UNION ALL SELECT p, item, archive, concat(url, '#large'), 'large' FROM pg WHERE p % 25 = 0
  UNION ALL SELECT NULL, any_value(item), archive, NULL, 'warcinfo' FROM pg GROUP BY archive
)"""

# the same with the number of records before each in its archive
PLACED = """
placed AS (
  SELECT *, row_number() OVER (PARTITION BY archive ORDER BY p NULLS FIRST, list_position(
    ['request', 'page', 'svg', 'broken', 'image', 'image2', 'metadata', 'short', 'pdf', 'frames', 'large'], kind)) - 1 AS place
  FROM records
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts)


_ARCHIVE_NAME = "printf('item-%06d-%d.warc.gz', item, archive)"
_RECORD_TYPE = """
  CASE WHEN kind = 'request' THEN 'request' WHEN kind = 'metadata' THEN 'metadata'
       WHEN kind = 'warcinfo' THEN 'warcinfo' ELSE 'response' END"""
_CONTENT_TYPE = """
  CASE WHEN kind = 'request' THEN 'none' WHEN kind IN ('metadata', 'warcinfo') THEN NULL
       WHEN kind = 'page' THEN CASE p % 10 WHEN 5 THEN 'text/html'
            WHEN 6 THEN 'text/html; charset=windows-1252' ELSE 'text/html; charset=utf-8' END
       WHEN kind IN ('short', 'frames', 'large') THEN 'text/html'
       WHEN kind = 'pdf' THEN 'application/pdf' WHEN kind = 'svg' THEN 'image/svg+xml'
       ELSE 'image/png' END"""


def _merges_sql(steps: int) -> str:
    """Pair merges one at a time, unrolled: symbols of a word are wrapped in braces."""
    parts = [
        """words AS (
  SELECT regexp_replace(word, '(.)', '{\\1}', 'g') AS w0, count(*) AS times
  FROM (SELECT unnest(regexp_extract_all(text, '[ ]?[\\p{L}\\p{N}]+')) AS word FROM documents) GROUP BY word
)"""
    ]
    for n in range(steps):
        source = "words" if n == 0 else f"merged{n}"
        parts.append(f"""split{n} AS (SELECT times, regexp_extract_all(w{n}, '\\{{([^}}]*)\\}}', 1) AS s FROM {source}),
best{n} AS (
  SELECT a AS "left", b AS "right", sum(times)::BIGINT AS n FROM (
    SELECT times, unnest(s[:-2]) AS a, unnest(s[2:]) AS b FROM split{n} WHERE len(s) > 1
  ) GROUP BY ALL ORDER BY n DESC, "left", "right" LIMIT 1
),
merged{n + 1} AS (
  SELECT times, replace(w{n}, concat('{{', "left", '}}{{', "right", '}}'), concat('{{', "left", "right", '}}')) AS w{n + 1}
  FROM {source}, best{n}
)""")
    rows = " UNION ALL ".join(f"SELECT {n}::BIGINT AS step, * FROM best{n}" for n in range(steps))
    return _with(*parts) + "\n" + rows


def oracle_sql() -> dict[str, str]:
    text_len = "length(text) >= 1000"
    long_pages = f"""
page_texts AS (
  SELECT p, url, {page_text_sql('html')} AS text, {export_text_sql('html', 'alts')} AS export_text FROM pg
  UNION ALL SELECT -1 - p, concat(url, '#large'), trim(repeat('{LARGE_SENTENCE} ', {LARGE_PARAGRAPHS})),
    trim(repeat('{LARGE_SENTENCE}' || chr(10), {LARGE_PARAGRAPHS}), chr(10)) FROM pg WHERE p % 25 = 0
)"""
    page_detect = detect_sql("page_texts", "p", "text")
    doc_detect = detect_sql("documents", "doc_id", "text")
    out: dict[str, str] = {}

    # sources
    out["list_archives"] = _with(PG) + f"""
SELECT DISTINCT {_ARCHIVE_NAME} AS name FROM pg"""
    out["warc_records"] = _with(PG, RECORDS) + f"""
SELECT {_ARCHIVE_NAME} AS archive, {_RECORD_TYPE} AS warc_type, url AS target_uri,
  {_CONTENT_TYPE} AS content_type, kind NOT IN ('metadata', 'warcinfo') AS has_http_headers
FROM records"""
    out["warc_page_roundtrip"] = _with(PG) + """
SELECT url, md5(regexp_replace(html, '</article>', concat(tags, '</article>'))) AS html_md5 FROM pg"""
    out["within_content_length"] = _with(PG, RECORDS) + f"""
SELECT {_RECORD_TYPE} AS warc_type, count(*) AS n FROM records WHERE kind <> 'large' GROUP BY ALL"""
    out["cdx_rows"] = _with(PG, RECORDS, PLACED) + f"""
SELECT printf('item-%06d', item) AS item, url, mime, {_ARCHIVE_NAME} AS archive, target_uri, place FROM (
  SELECT item, archive, url, CASE kind WHEN 'page' THEN 'text/html' WHEN 'svg' THEN 'image/svg+xml' ELSE 'image/png' END AS mime,
    url AS target_uri, place
  FROM placed WHERE kind IN ('page', 'image', 'image2', 'broken', 'svg')
  UNION ALL SELECT item, archive, concat('{HOST}/moved-', p, '.png'), 'image/png', url, place
  FROM placed WHERE p % 10 = 6 AND kind = 'image'
  UNION ALL SELECT item, archive, concat('{HOST}/revisit-', p, '.png'), 'warc/revisit', NULL, NULL FROM pg WHERE p % 10 = 9
)"""
    out["cdx_wanted"] = _with(PG, REFERENCES) + """
SELECT text_url, position, url FROM images WHERE outcome <> 'n_img_not_found'"""
    out["latest_captures"] = _with(PG) + f"""
SELECT item, url FROM (
  SELECT printf('item-%06d', item) AS item, url FROM pg
  UNION ALL SELECT printf('item-%06d', item), concat('{HOST}/', p, '.png') FROM pg
  UNION ALL SELECT printf('item-%06d', item), concat('{HOST}/moved-', p, '.png') FROM pg WHERE p % 10 = 6
)"""
    fetched = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS target_uri, height, width FROM latest_images"""
    out["fetch_records_range"] = fetched
    out["fetch_records_scan"] = fetched
    out["stream_records"] = _with(PG, RECORDS) + f"""
SELECT {_ARCHIVE_NAME} AS archive, {_RECORD_TYPE} AS warc_type, count(*) AS n FROM records GROUP BY ALL"""

    out["stream_byte_batches"] = out["stream_records"]
    out["stream_finished_archives"] = _with(PG, RECORDS) + f"""
SELECT {_ARCHIVE_NAME} AS archive, count(*) AS n_records, 0::BIGINT AS n_errors FROM records GROUP BY ALL"""
    out["warc_pushed"] = _with(PG, RECORDS) + f"""
SELECT {_ARCHIVE_NAME} AS archive, url AS target_uri, true AS whole FROM records WHERE kind IN ('page', 'frames', 'large')"""

    # predicates
    out["is_response"] = _with(PG, RECORDS) + """
SELECT kind IN ('page', 'image', 'image2', 'broken', 'svg', 'pdf', 'frames', 'large') AS passed, count(*) AS n
FROM records GROUP BY ALL"""
    out["content_type_predicates"] = _with(PG, RECORDS) + """
SELECT coalesce(kind IN ('page', 'short', 'frames', 'large'), false) AS is_html,
  coalesce(kind IN ('image', 'image2', 'broken'), false) AS is_image, count(*) AS n
FROM records GROUP BY ALL"""
    out["header_predicates"] = _with(PG, RECORDS) + """
SELECT true AS has_record_headers, kind NOT IN ('metadata', 'warcinfo') AS has_http_headers, count(*) AS n
FROM records GROUP BY ALL"""
    out["min_text_length"] = f"SELECT doc_id FROM documents WHERE {text_len}"
    out["matches_regex"] = f"""
SELECT doc_id, len(regexp_extract_all(text, '{PATTERN}'))::INTEGER AS n_matches
FROM documents WHERE regexp_matches(text, '{PATTERN}')"""
    out["image_size_between"] = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS url, height, width FROM good_captures
WHERE height BETWEEN 150 AND 1000 AND width BETWEEN 150 AND 1000"""
    out["page_features"] = _with(PG, REFERENCES) + """
SELECT pg.url, true AS has_body, pg.p % 10 <> 3 AS has_images, coalesce(n, 0) AS n_with_alt
FROM pg LEFT JOIN (SELECT p, count(*) AS n FROM refs WHERE alt <> '' GROUP BY p) USING (p)
UNION ALL SELECT concat(url, '#frames'), false, false, 0 FROM pg WHERE p % 10 = 5
UNION ALL SELECT concat(url, '#large'), true, false, 0 FROM pg WHERE p % 25 = 0"""
    out["above_threshold"] = """
WITH s AS (SELECT vec_id, embedding[1]::DOUBLE AS prediction FROM embeddings)
SELECT vec_id, prediction > 0.1 AS strict, true AS inclusive FROM s WHERE prediction >= 0.1"""

    # scalar functions
    out["page_text"] = f"SELECT page_id, {page_text_sql('html')} AS text FROM pages"
    out["page_export_text"] = f"SELECT page_id, {export_text_sql('html')} AS text FROM pages"
    out["decode_html"] = """
SELECT page_id, v.variant::INTEGER AS variant, md5(html) AS html_md5
FROM pages CROSS JOIN (SELECT unnest(range(0, 4)) AS variant) v"""
    out["charset_profile"] = """
WITH codes AS (SELECT list_transform(string_split(text, ''), lambda x: unicode(x)) AS c FROM documents),
pairs AS (
  SELECT unnest(list_transform(range(1, len(c)), lambda i: CASE WHEN c[i] >= 128 OR c[i + 1] >= 128 THEN 256 * c[i] + c[i + 1] END)) AS pair
  FROM codes WHERE list_max(c) < 256 AND len(list_filter(c, lambda x: x BETWEEN 128 AND 159)) = 0
),
counts AS (SELECT pair, count(*) AS n FROM pairs WHERE pair IS NOT NULL GROUP BY pair)
SELECT 'windows-1252' AS charset, pair::INTEGER AS pair, n,
  CAST(round(1000000 * ln((n + 1.0::DOUBLE) / (sum(n) OVER () + 65536.0::DOUBLE))) AS BIGINT) AS weight FROM counts"""
    shown = {
        "latin": "text",
        "kana": f"translate(lower(text), '{LATIN}', '{KANA}')",
        "han": f"translate(lower(text), '{LATIN}', '{HAN}')",
    }
    variants = " UNION ALL ".join(f"SELECT doc_id, '{name}' AS charset, {shown[script]} AS shown FROM documents" for name, script in UNDECLARED)
    out["undeclared_charsets"] = f"""
SELECT doc_id, charset, md5(shown) AS text_md5 FROM ({variants})
WHERE len(regexp_extract_all(shown, '[^\\x00-\\x7f]')) NOT BETWEEN 1 AND 7 OR charset IN ('utf-8', 'utf-16-le')"""
    out["page_images"] = _with(PG, REFERENCES) + """
SELECT text_url, position, url AS image_url, alt FROM images"""
    out["resolve_url"] = """
WITH links AS (SELECT url, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS ref FROM pages)
SELECT url AS page_url, ref, concat(regexp_extract(url, '^(https?://[^/?#]+)', 1), ref) AS resolved FROM links"""
    out["vocabulary"] = _with(VOCABULARY) + "\nSELECT token, n, id FROM vocabulary"
    out["tokenize"] = _with(VOCABULARY) + """,
w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS token, unnest(range(1, len(ws) + 1)) AS i FROM w),
i AS (SELECT doc_id, sum(coalesce(id, 0) * i) AS checksum, count(*) AS n_tokens FROM x LEFT JOIN vocabulary USING (token) GROUP BY doc_id)
SELECT doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(checksum, 0)::BIGINT AS checksum, coalesce(n_tokens, 0) AS mask_sum
FROM documents LEFT JOIN i USING (doc_id)"""
    out["subword_merges"] = _merges_sql(SUBWORD_MERGES)
    out["subword_round_trip"] = "SELECT doc_id, md5(text) AS text_md5, true AS masked FROM documents"
    out["similarity_inputs"] = _with(PG, CAPTURES) + f"""
SELECT url, n_words AS n_ids, n_words AS n_mask, {3 * MODEL_PIXELS**2}::BIGINT AS n_pixels, r AS red, g AS green, b AS blue
FROM (SELECT *, len(regexp_extract_all(lower(concat('the picture of ', url)), '[\\p{{L}}\\p{{N}}]+')) AS n_words
  FROM (SELECT *, concat('{HOST}/', p, '.png') AS url FROM good_captures))"""
    out["language_profile"] = _with(PROFILE) + "\nSELECT lang, bucket::INTEGER AS bucket, weight FROM profile"
    out["detect_language"] = _with(PROFILE, doc_detect) + """
SELECT doc_id, coalesce(language, 'unknown') AS language FROM documents LEFT JOIN detected USING (doc_id)"""
    out["language_filter"] = _with(PROFILE, doc_detect) + f"""
SELECT doc_id FROM documents JOIN detected USING (doc_id) WHERE {text_len} AND language = 'en'"""
    out["class_probability"] = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)
SELECT vec_id, round(exp(v[1]) / list_sum(list_transform(v, lambda x: exp(x))), 6) AS p0,
  round(exp(v[3]) / list_sum(list_transform(v, lambda x: exp(x))), 6) AS p2
FROM e"""
    out["export_name"] = """
SELECT page_id,
  concat(translate(base64(encode(url)[1:128]), '+/', '-_'), '_', printf('%.4f', (page_id % 1000) / 1000.0::DOUBLE), '.txt') AS name,
  concat_ws('_', translate(base64(encode(url)[1:64]), '+/', '-_'), translate(base64(encode(concat(url, '/i.png'))[1:64]), '+/', '-_')) AS pair_name
FROM pages"""
    out["alt_metadata"] = """
SELECT doc_id, concat('1.5', chr(10), source, chr(10), lang, chr(10), text, chr(10)) AS meta FROM documents"""

    # images
    out["decode_images"] = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS url, height, width, 3 AS channels, (height * width * 3)::BIGINT AS n_bytes,
  printf('%02x%02x%02x', r, g, b) AS first_pixel FROM good_captures"""
    out["decode_pixels"] = """
SELECT doc_id, height, width, md5(bytes || unhex(repeat('00', (height * width * 3 - octet_length(bytes))::BIGINT))) AS pixels_md5
FROM (SELECT doc_id, width, encode(text) AS bytes, ceil(octet_length(encode(text)) / (3.0 * width))::INTEGER AS height
  FROM (SELECT *, (5 + doc_id % 60)::INTEGER AS width FROM documents WHERE text <> ''))"""
    out["resize_images"] = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS url, 18::BIGINT AS n_values,
  r * 6 AS red, g * 6 AS green, b * 6 AS blue FROM good_captures"""

    # joins
    out["locate_images"] = _with(PG, REFERENCES) + """
SELECT text_url, position, url FROM images WHERE outcome <> 'n_img_not_found'"""
    out["missing_images"] = _with(PG, REFERENCES) + """
SELECT text_url, position, url FROM images WHERE outcome = 'n_img_not_found'"""
    out["image_references"] = _with(PG, REFERENCES) + """
SELECT item, url, count(*) AS n_refs FROM (SELECT printf('item-%06d', item) AS item, url FROM images) GROUP BY ALL"""
    pairs = _with(PG, CAPTURES, REFERENCES)
    out["pairs_job"] = pairs + f"""
SELECT i.text_url, i.position, i.url AS image_url, i.alt AS alt_text, l.height, l.width,
  {export_text_sql('pg.html', 'alts')} AS export_text, 1.0::DOUBLE AS prediction
FROM images i JOIN latest_images l ON i.target = l.p JOIN pg ON pg.p = i.p"""
    out["alt_text_job"] = pairs + """
SELECT i.text_url, i.url AS image_url, i.alt AS alt_text, round(l.r * 100 / 255.0::DOUBLE, 2) AS prediction
FROM images i JOIN latest_images l ON i.target = l.p
WHERE i.alt <> '' AND round(l.r * 100 / 255.0::DOUBLE, 2) >= 20"""
    out["pairs_combined_filter"] = pairs + """
SELECT i.text_url, i.position, i.url AS image_url
FROM images i JOIN latest_images l ON i.target = l.p JOIN pg ON pg.p = i.p
WHERE length(%s) > 10 * l.width""" % page_text_sql("pg.html")

    # aggregations
    text_funnel = """
SELECT counter, count(*) AS n FROM (
  SELECT CASE WHEN kind IN ('metadata', 'warcinfo') THEN 'n_http_headers_none'
    WHEN kind IN ('request', 'short') THEN 'n_wrong_warc_type'
    WHEN kind NOT IN ('page', 'frames', 'large') THEN 'n_wrong_content_type'
    WHEN kind = 'frames' OR (kind = 'page' AND length(text) < 1000) THEN 'n_distributed_filter_not_passed'
    ELSE 'n_node_results' END AS counter
  FROM records LEFT JOIN page_texts USING (p)
) GROUP BY ALL"""
    out["funnel_text"] = _with(PG, RECORDS, long_pages) + text_funnel
    out["stream_funnel"] = out["funnel_text"]
    out["stream_funnel_finished"] = out["funnel_text"] + """
UNION ALL SELECT 'n_finished_warc_files', count(DISTINCT page_id // 50) FROM pages"""
    out["funnel_image"] = _with(PG, RECORDS, CAPTURES) + """
SELECT counter, count(*) AS n FROM (
  SELECT CASE WHEN kind IN ('metadata', 'warcinfo') THEN 'n_http_headers_none'
    WHEN kind IN ('request', 'short') THEN 'n_wrong_warc_type'
    WHEN kind NOT IN ('image', 'image2', 'broken') THEN 'n_wrong_content_type'
    WHEN kind = 'broken' THEN 'n_decoding_exception'
    WHEN height BETWEEN 150 AND 1000 AND width BETWEEN 150 AND 1000 THEN 'n_node_results'
    ELSE 'n_distributed_filter_not_passed' END AS counter
  FROM records r LEFT JOIN captures c ON c.p = r.p AND c.n = CASE kind WHEN 'image2' THEN 1 ELSE 0 END
) GROUP BY ALL"""
    out["funnel_pairs"] = _with(PG, RECORDS, REFERENCES) + """
SELECT counter, count(*) AS n FROM (
  SELECT CASE WHEN kind IN ('metadata', 'warcinfo') THEN 'n_http_headers_none'
    WHEN kind IN ('request', 'short') THEN 'n_wrong_warc_type'
    WHEN kind NOT IN ('page', 'frames', 'large') THEN 'n_wrong_content_type'
    WHEN kind = 'frames' THEN 'n_no_body'
    ELSE 'n_no_img_elements' END AS counter
  FROM records WHERE NOT (kind = 'page' AND p % 10 <> 3) OR p IS NULL
  UNION ALL SELECT outcome FROM images
) GROUP BY ALL"""
    out["finished_archives"] = "SELECT count(DISTINCT page_id // 50) AS n_finished_warc_files FROM pages"
    out["regex_match_total"] = f"""
SELECT sum(len(regexp_extract_all(text, '{PATTERN}')))::BIGINT AS n_regex_matches
FROM documents WHERE {text_len} AND lang = 'en' AND regexp_matches(text, '{PATTERN}')"""
    out["write_stats"] = _with(PG, RECORDS, long_pages) + f""",
f AS ({text_funnel})
SELECT concat('{{', string_agg(printf('"%s":%d', counter, n), ',' ORDER BY counter), '}}') AS value FROM f"""

    # scoring
    out["score_text"] = _with(VOCABULARY, text_score_sql("documents", "doc_id", "text")) + """
SELECT doc_id, round(prediction, 6) AS prediction FROM text_scores"""
    out["score_image"] = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS url, round(1 / (1 + exp(-10 * ((r + g + b) / 765.0::DOUBLE - 0.5))), 6) AS prediction
FROM good_captures"""
    similarity = """
WITH s AS (
  SELECT a.vec_id, 100 * list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS prediction
  FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1
)"""
    out["score_similarity"] = similarity + """
SELECT vec_id, round(coalesce(prediction, 0), 6) AS prediction FROM s"""
    out["similarity_filter"] = similarity + """
SELECT vec_id, round(prediction, 6) AS prediction FROM s WHERE prediction >= 20"""
    out["score_passthrough"] = "SELECT doc_id, 1.0::DOUBLE AS prediction FROM documents"
    out["score_batch"] = """
SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 4) AS prediction FROM embeddings"""

    # sinks
    out["write_record_files"] = f"""
SELECT page_id, md5({page_text_sql('html')}) AS body_md5 FROM pages"""
    out["write_pairs"] = pairs + f"""
SELECT concat(translate(base64(encode(i.text_url)[1:64]), '+/', '-_'), '_', translate(base64(encode(i.url)[1:64]), '+/', '-_'), '_1.0000') AS folder,
  v.file, v.text_md5, v.height, v.width, v.pixels_md5
FROM images i JOIN latest_images l ON i.target = l.p JOIN pg ON pg.p = i.p, LATERAL (
  SELECT concat(translate(base64(encode(i.text_url)[1:128]), '+/', '-_'), '_1.0000.txt') AS file,
    md5({export_text_sql('pg.html', 'alts')}) AS text_md5, NULL AS height, NULL AS width, NULL AS pixels_md5
  UNION ALL SELECT concat(translate(base64(encode(i.url)[1:128]), '+/', '-_'), '_1.0000.png'), NULL, l.height, l.width, {PIXELS_MD5}
) v"""
    out["write_alt_pairs"] = pairs + """
SELECT concat(translate(base64(encode(i.text_url)[1:64]), '+/', '-_'), '_', translate(base64(encode(i.url)[1:64]), '+/', '-_')) AS folder,
  v.*
FROM images i JOIN latest_images l ON i.target = l.p, LATERAL (
  SELECT round(l.r * 100 / 255.0::DOUBLE, 2) AS score, concat_ws(chr(10), i.text_url, i.url, i.alt) AS meta,
    NULL AS file, NULL AS height, NULL AS width, NULL AS pixels_md5
  UNION ALL SELECT NULL, NULL, 'img.png', l.height, l.width, %s
) v
WHERE i.alt <> '' AND round(l.r * 100 / 255.0::DOUBLE, 2) >= 20""" % PIXELS_MD5
    out["overwrite_record_files"] = """
SELECT 'failed' AS state, concat(page_id, '.txt') AS name, url AS body FROM pages
UNION ALL SELECT 'overwritten', concat(page_id, '.txt'), 'new' FROM pages WHERE page_id % 2 = 0"""
    out["dataset_shards"] = """
SELECT lang, lang NOT IN ('fr', 'es') AS sound, CASE lang WHEN 'fr' THEN 'footer' WHEN 'es' THEN 'pages:' END AS problem,
  CASE WHEN lang NOT IN ('fr', 'es') THEN count(*) END AS rows, CASE lang WHEN 'fr' THEN 0 WHEN 'es' THEN NULL ELSE count(*) END AS n_read
FROM documents GROUP BY lang"""
    out["write_dataset"] = "SELECT doc_id, text, lang, 1.0::DOUBLE AS prediction FROM documents"
    out["report"] = """
SELECT source AS url, round(n_chars / 1000.0::DOUBLE, 3) AS prediction FROM documents"""

    # jobs
    out["regex_job"] = _with(PROFILE, doc_detect) + f"""
SELECT coalesce(sum(len(regexp_extract_all(text, '{PATTERN}'))), 0)::BIGINT AS n_regex_matches
FROM documents JOIN detected USING (doc_id)
WHERE {text_len} AND regexp_matches(text, '{PATTERN}') AND language = 'en'"""
    out["regex_job_archives"] = _with(PG, PROFILE, long_pages, page_detect) + f"""
SELECT coalesce(sum(len(regexp_extract_all(text, '{PATTERN}'))), 0)::BIGINT AS n_regex_matches
FROM page_texts JOIN detected USING (p)
WHERE {text_len} AND regexp_matches(text, '{PATTERN}') AND language = 'en'"""
    out["regex_job_texts"] = _with(PG, PROFILE, long_pages, page_detect) + f"""
SELECT url, len(regexp_extract_all(text, '{PATTERN}')) AS n_matches, export_text
FROM page_texts JOIN detected USING (p)
WHERE {text_len} AND regexp_matches(text, '{PATTERN}') AND language = 'en'"""
    out["warc_damaged"] = """
WITH damaged AS (
  SELECT printf('damaged-%06d.warc.gz', page_id // 10) AS archive,
         page_id % 7 = 3 AND (page_id // 10) % 3 <> 2 AS broken,
         CASE WHEN page_id % 11 = 0 THEN concat(url, chr(8232), 'x') ELSE url END AS url
  FROM pages
)
SELECT archive, CASE WHEN NOT broken THEN url END AS url, broken, count(*) AS n FROM damaged GROUP BY ALL"""
    out["stream_regex_stats"] = f"""
SELECT 'n_regex_matches' AS counter, n_regex_matches AS n FROM ({out["regex_job_archives"]})
UNION ALL SELECT 'n_node_results', count(*) FROM ({out["regex_job_texts"]})"""
    out["text_job"] = (
        _with(PG, PROFILE, long_pages, page_detect, VOCABULARY, text_score_sql("page_texts", "p", "text"))
        + f"""
SELECT url, export_text, round(prediction, 6) AS prediction
FROM page_texts JOIN detected USING (p) JOIN text_scores USING (p)
WHERE {text_len} AND language = 'en' AND prediction > 0.9"""
    )
    out["image_job"] = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS url, height, width, round(s, 6) AS prediction
FROM (SELECT *, 1 / (1 + exp(-10 * ((r + g + b) / 765.0::DOUBLE - 0.5))) AS s FROM good_captures)
WHERE height BETWEEN 150 AND 1000 AND width BETWEEN 150 AND 1000 AND s > 0.95"""
    out["dataset_job"] = _with(PG, CAPTURES) + f"""
SELECT concat('{HOST}/', p, '.png') AS url, height, width, 1.0::DOUBLE AS prediction FROM good_captures"""
    return out
