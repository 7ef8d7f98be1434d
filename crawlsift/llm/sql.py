"""DuckDB SQL of those training-data queries that SQL can express."""

from __future__ import annotations

LINE_WINDOWS = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents WHERE text <> ''
), filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS place
  FROM (SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM lines)
  WHERE line <> ''
), windows AS (
  SELECT doc_id, place,
         line || chr(10) || lead(line) OVER w || chr(10) || lead(line, 2) OVER w AS three
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), later AS (
  SELECT doc_id, place FROM (
    SELECT *, row_number() OVER (PARTITION BY three ORDER BY doc_id, place) AS turn
    FROM windows WHERE three IS NOT NULL)
  WHERE turn > 1
), gone AS (
  SELECT DISTINCT doc_id, place + k AS place FROM later, (VALUES (0), (1), (2)) AS steps(k)
), marked AS (
  SELECT l.doc_id, l.n, l.raw, gone.place IS NOT NULL AS dropped
  FROM lines l LEFT JOIN filled f ON l.doc_id = f.doc_id AND l.n = f.n
  LEFT JOIN gone ON f.doc_id = gone.doc_id AND f.place = gone.place
), cleaned AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), '') AS text
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       coalesce(c.text, d.text) AS text
FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id
"""

EXACT_DEDUP = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS code_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM rows WINDOW w AS (PARTITION BY text_sha256 ORDER BY code_points DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, lang, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
         TRY_CAST(regexp_extract(source, '^src([0-9]{1,9})$', 1) AS BIGINT) AS number
  FROM documents
), sized AS (
  SELECT *, CASE WHEN number < 8 THEN 'web' WHEN number < 14 THEN 'reference' ELSE 'dialogue' END AS domain
  FROM docs
), leaves AS (
  SELECT domain, lang, source, sum(tokens)::BIGINT AS total, sum(tokens)::DOUBLE * 2 AS capacity,
         CASE domain WHEN 'web' THEN 3.0 WHEN 'reference' THEN 2.0 ELSE 1.0 END::DOUBLE AS w1,
         CASE lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS w2
  FROM sized GROUP BY ALL
), domains AS (
  SELECT domain, w1, sum(capacity) AS capacity, (SELECT sum(total) FROM leaves)::DOUBLE * 0.8::DOUBLE AS b0
  FROM leaves GROUP BY ALL
), domain_levels AS (
  SELECT *, (b0 - coalesce(sum(capacity) OVER (ORDER BY capacity / w1, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w1) OVER (ORDER BY capacity / w1, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM domains
), domain_budgets AS (
  SELECT domain, least(capacity, w1 * max(level) OVER ()) AS b1 FROM domain_levels
), langs AS (
  SELECT domain, lang, w2, b1, sum(capacity) AS capacity
  FROM leaves JOIN domain_budgets USING (domain) GROUP BY ALL
), lang_levels AS (
  SELECT *, (b1 - coalesce(sum(capacity) OVER (PARTITION BY domain ORDER BY capacity / w2, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w2) OVER (PARTITION BY domain ORDER BY capacity / w2, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM langs
), lang_budgets AS (
  SELECT domain, lang, least(capacity, w2 * max(level) OVER (PARTITION BY domain)) AS b2 FROM lang_levels
), leaf_levels AS (
  SELECT leaves.*, b2,
         (b2 - coalesce(sum(capacity) OVER (PARTITION BY domain, lang ORDER BY capacity, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / count(*) OVER (PARTITION BY domain, lang ORDER BY capacity, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM leaves JOIN lang_budgets USING (domain, lang)
), budgets AS (
  SELECT domain, lang, source, total,
         floor(least(capacity, max(level) OVER (PARTITION BY domain, lang)))::BIGINT AS budget
  FROM leaf_levels
), keyed AS (
  SELECT s.*, coalesce(budget // nullif(total, 0), 0) AS whole,
         budget - coalesce(budget // nullif(total, 0), 0) * total AS rest,
         left(md5('17:' || coalesce(budget // nullif(total, 0), 0) || ':' || doc_id), 16) AS key
  FROM sized s JOIN budgets USING (domain, lang, source)
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS reach,
         sum(tokens) OVER (PARTITION BY domain, lang, source, key) AS alike FROM keyed
), drawn AS (
  SELECT *, rest > 0 AND (reach <= rest OR (reach - alike <= rest
         AND ('0x' || left(md5('draw:' || key), 8))::BIGINT::DOUBLE * alike::DOUBLE
             < (rest - reach + alike)::DOUBLE * 4294967296.0::DOUBLE)) AS taken
  FROM placed
)
SELECT doc_id, domain, lang, source, tokens, (whole + taken::INT)::INT AS epochs
FROM drawn WHERE whole + taken::INT > 0
"""


ARC_TO_WARC = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), ranked AS (
  SELECT *, first_value(page_id) OVER w AS first_id, row_number() OVER w AS place
  FROM rows WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id)
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_id END AS refers_to
FROM ranked
"""


#: Unsigned CRC-32 of a decimal number, bit by bit: a byte comes in, then eight shifts (-1).
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(string_split({0}::VARCHAR, ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
        WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END))"""

CONVERSATION_TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), sizes AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {_CRC32.format("conv_id")} % 6 AS h
    FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT s.conv_id, t.place AS depth, t.role, t.text
    FROM sizes s JOIN turns t ON t.conv_id = s.base AND t.place <= s.h
    UNION ALL
    SELECT s.conv_id, t.place - s.h + least(s.h, coalesce(b.n, 0)), t.role, t.text
    FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base JOIN turns t ON t.conv_id = s.conv_id AND t.place > s.h
), sequences AS (
    SELECT conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY depth) FILTER (WHERE depth IS NOT NULL), []) AS seq
    FROM sizes LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), members AS (
    SELECT conv_id, len(seq) AS size, depth, to_json(list_slice(seq, 1, depth)) AS node,
        CASE WHEN depth > 0 THEN to_json(list_slice(seq, 1, depth - 1)) END AS parent,
        CASE WHEN depth > 0 THEN length(seq[depth].text) ELSE 0 END AS chars
    FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS depth FROM sequences)
), nodes AS (
    SELECT node, min(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        (count(*) - 1) * min(chars) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256
    FROM members GROUP BY node
), children AS (
    SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), totals AS (
    SELECT up.node, sum((c.n IS NULL)::BIGINT) AS n_leaves, sum(n.saved) AS saved_tokens
    FROM nodes n LEFT JOIN children c USING (node)
    JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth JOIN nodes up ON up.node = m.node
    GROUP BY up.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
    t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN children c ON c.node = n.node
JOIN totals t ON t.node = n.node
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_line_windows": LINE_WINDOWS,
        "op8_exact_dedup": EXACT_DEDUP,
        "op9_mixing": MIXING,
        "op10_arc_to_warc": ARC_TO_WARC,
        "op12_conversation_trie": CONVERSATION_TRIE,
    }
