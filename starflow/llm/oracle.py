"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from starflow.llm import licenses, warc
from starflow.llm.quality import BASE_MIN_WORDS, BASE_MOST_REPEATED, STOP_FORMS

QUALITY = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), windows AS (
  SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w)
), again AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM again WHERE n > 1) GROUP BY doc_id
), lines AS (
  SELECT doc_id, text, ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM w
), counted AS (
  SELECT l.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(ws, lambda x: list_contains({list(STOP_FORMS)}, x))) AS n_stop_words
  FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id
), judged AS (
  SELECT *,
    100 * word_chars >= 200 * n_words AND 100 * word_chars <= 1200 * n_words AS passes_mean_word_length,
    100 * n_symbols <= 25 * n_words AS passes_symbols_per_word,
    100 * n_dup_lines <= 40 * n_lines AS passes_duplicate_lines,
    100 * n_stop_words >= 5 * n_words AS passes_stop_words,
    n_words < {BASE_MIN_WORDS} OR 100 * n_repeat_words > {BASE_MOST_REPEATED} * n_words AS base_failed
  FROM counted
)
SELECT *, NOT base_failed AND passes_mean_word_length AND passes_symbols_per_word
  AND passes_duplicate_lines AND passes_stop_words AS kept
FROM judged
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    cases = " ".join(f"WHEN p = {_quoted(s)} THEN {_quoted(n)}" for s, n in licenses.known_sentences().items())
    cases += " " + " ".join(
        f"WHEN regexp_matches(p, {_quoted(pattern)}) THEN {_quoted(n)}" for n, pattern in licenses.PATTERNS.items()
    )
    cuts = [
        f"SELECT doc_id, {k} AS way, string_split_regex(text, {_quoted(cut)}) AS raw FROM candidates"
        for k, cut in enumerate((licenses.LINE_CUT, licenses.PARAGRAPH_CUT))
    ]
    rules = ", ".join(f"({_quoted(a)}, {_quoted(b)}, {_quoted(chr(92) + 'b' + c)})" for a, b, c in licenses.RULES)
    return f"""
WITH candidates AS (
  SELECT row_number() OVER () AS doc, doc_id, text FROM documents
  WHERE regexp_matches(text, {_quoted(licenses.FOUND)})
), cut AS (
  {' UNION ALL '.join(c.replace('doc_id', 'doc, doc_id') for c in cuts)}
), pieces AS (
  SELECT doc, doc_id, way, unnest(raw) AS piece, generate_subscripts(raw, 1) AS spot FROM cut
), plain AS (
  SELECT doc, doc_id, way, spot, regexp_replace(
    lower(regexp_replace(piece, {_quoted(licenses.UNWANTED)}, ' ', 'g')), {_quoted(licenses.EDGES)}, '', 'g') AS p
  FROM pieces WHERE regexp_matches(piece, {_quoted(licenses.FOUND)})
), named AS (
  SELECT doc, doc_id, way, spot, CASE {cases} END AS name FROM plain
), sequences AS (
  SELECT doc, doc_id, way, string_agg(name, ' ' ORDER BY spot) || ' ' AS s
  FROM named WHERE name IS NOT NULL GROUP BY doc, doc_id, way
), matched AS (
  SELECT doc, doc_id, license, rule, max(len(regexp_extract_all(s, pattern))) AS n_matches
  FROM sequences, (VALUES {rules}) AS r(license, rule, pattern) GROUP BY doc, doc_id, license, rule
)
SELECT doc_id, license, rule, n_matches FROM matched WHERE n_matches > 0
"""


def _uuid(value: str) -> str:
    h = f"md5({value})"
    cut = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {cut} || '>')"


def _unescaped(value: str) -> str:
    number = f"regexp_extract(lower(x), {_quoted(warc.NUMBER)}, 1)"
    code = (
        f"CASE WHEN {number} LIKE 'x%' THEN CAST('0x' || substr({number}, 2) AS INT) ELSE CAST({number} AS INT) END"
    )
    made = (
        f"CASE WHEN {number} = '' THEN '&#' || x ELSE "
        f"CASE WHEN {code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) "
        f"ELSE chr({code}) END || substr(x, len({number}) + 2) END"
    )
    pieces = f"string_split({value}, '&#')"
    out = (
        f"CASE WHEN contains({value}, '&#') THEN {pieces}[1] || "
        f"array_to_string(list_transform({pieces}[2:], lambda x: {made}), '') ELSE {value} END"
    )
    for name, character in warc.ENTITIES:
        out = f"replace({out}, {_quoted(name)}, {_quoted(character)})"
    return out


def _replaced(value: str, *steps: tuple[str, str]) -> str:
    for pattern, made in steps:
        value = f"regexp_replace({value}, {_quoted(pattern)}, {made}, 'g')"
    return value


def _lined(value: str) -> str:
    steps = ((r"[ \t\r\f\x0b]+", "' '"), (r" *\n[ \n]*", "chr(10)"), (r"^\n|\n$", "''"))
    return f"trim({_replaced(value, *steps)})"


def _warc_sql() -> str:
    crlf = "chr(13) || chr(10)"
    strip = ((warc.COMMENT, "' '"), (warc.HIDDEN, "' '"), (warc.UNCLOSED, "' '"), (warc.BLOCK, "chr(10)"), (warc.TAG, "''"))

    def header(kind: str, content_type: str, concurrent: str) -> str:
        lines = [
            ("WARC-Type", f"'{kind}'"),
            ("WARC-Record-ID", "record_id"),
            ("WARC-Refers-To", "refers_to"),
            *([("WARC-Concurrent-To", concurrent)] if concurrent else []),
            ("WARC-Target-URI", "target_uri"),
            ("WARC-Date", "date"),
            ("WARC-Payload-Digest", "payload_digest"),
            ("WARC-Block-Digest", "'sha256:' || sha256(block)"),
            ("Content-Type", f"'{content_type}'"),
            ("Content-Length", "CAST(strlen(block) AS VARCHAR)"),
        ]
        body = " || ".join(f"'{n}: ' || {v} || {crlf}" for n, v in lines)
        return f"'WARC/1.1' || {crlf} || {body} || {crlf}"

    def records(kind: str, content_type: str, concurrent: str) -> str:
        return f"""SELECT page_id, '{kind}' AS record_type, record_id, refers_to, target_uri, date, payload_digest,
    'sha256:' || sha256(block) AS block_digest, strlen(block) AS content_length,
    {header(kind, content_type, concurrent)} AS header, block FROM {kind}"""

    return f"""
WITH pages_ AS (
  SELECT page_id, coalesce(CAST(page_id AS VARCHAR), '') AS page,
    coalesce(nullif(url, ''), 'urn:page:' || coalesce(CAST(page_id AS VARCHAR), '')) AS target_uri,
    coalesce(html, '') AS body FROM pages
), source AS (
  SELECT page_id, target_uri, '{warc.DATE}' AS date, body, 'sha256:' || sha256(body) AS payload_digest,
    {_uuid("'response ' || page || ' ' || target_uri || ' sha256:' || sha256(body)")} AS refers_to
  FROM pages_
), bodies AS (
  SELECT *, {_replaced("body", *strip)} AS bare, regexp_extract(body, {_quoted(warc.TITLE)}, 1) AS title FROM source
), decoded AS (
  SELECT *, {_unescaped("bare")} AS open_text, {_unescaped("title")} AS open_title FROM bodies
), conversion AS (
  SELECT *, {_uuid("'conversion ' || refers_to")} AS record_id, {_lined("open_text")} AS block FROM decoded
), metadata AS (
  SELECT *, {_uuid("'metadata ' || refers_to")} AS record_id,
    'HTTP/1.1 200 OK' || {crlf} || 'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: '
    || CAST(strlen(body) AS VARCHAR) || {crlf} || 'title: '
    || {_replaced(_lined("open_title"), (chr(92) + "n", "' '"))} || {crlf}
    || array_to_string(list_transform(regexp_extract_all(body, {_quoted(warc.LINK)}, 1),
       lambda x: 'outlink: ' || x || {crlf}), '') AS block FROM decoded
)
{records("metadata", "application/warc-fields", _uuid("'conversion ' || refers_to"))}
UNION ALL
{records("conversion", "text/plain; charset=utf-8", "")}
"""


# Phrase collocations, counted from scratch with the fixed cut characters written out.
PHRASES = """
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), s AS (
  SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
  FROM w CROSS JOIN (VALUES (1), (2), (3)) AS k(m)
), f AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM s GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang
), c AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m >= 2 AND f >= 10
), cut AS (
  SELECT c.*,
    (SELECT x.f FROM f x WHERE x.lang = c.lang AND x.phrase = c.ws[1]) AS l1,
    (SELECT x.f FROM f x WHERE x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:2], ' ')) AS l2,
    (SELECT x.f FROM f x WHERE x.lang = c.lang AND x.phrase = c.ws[c.m]) AS r1,
    (SELECT x.f FROM f x WHERE x.lang = c.lang AND x.phrase = array_to_string(c.ws[2:3], ' ')) AS r2
  FROM c
), scored AS (
  SELECT *,
    (1000000::HUGEINT * a * a) // (l1::HUGEINT * (CASE WHEN m = 2 THEN r1 ELSE r2 END)) AS s1,
    CASE WHEN m = 3 THEN (1000000::HUGEINT * a * a) // (l2::HUGEINT * r1) END AS s2
  FROM cut
), chosen AS (
  SELECT lang, phrase, a,
    CASE WHEN s2 IS NULL OR s1 <= s2 THEN l1 ELSE l2 END AS l,
    CASE WHEN s2 IS NULL THEN r1 WHEN s1 <= s2 THEN r2 ELSE r1 END AS r,
    CASE WHEN s2 IS NULL OR s1 <= s2 THEN s1 ELSE s2 END AS score
  FROM scored x
  WHERE NOT (m = 2 AND EXISTS (
    SELECT 1 FROM c y WHERE y.lang = x.lang AND y.m = 3 AND 2 * y.a >= x.a
      AND (array_to_string(y.ws[1:2], ' ') = x.phrase OR array_to_string(y.ws[2:3], ' ') = x.phrase)))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM chosen
)
SELECT r.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked r JOIN n ON r.lang = n.lang
WHERE rank <= 2000
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_license_scan": _license_sql(),
        "op6_warc_derivatives": _warc_sql(),
        "op10_quality_rules": QUALITY,
        "op11_phrase_mining": PHRASES,
    }
