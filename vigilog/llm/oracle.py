"""The same results in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from vigilog.llm.url_filter import NAMED, REFERENCES

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WHITE = r"E' \t\n\x0b\x0c\r'"

LINE_DEDUP = f"""
WITH numbered AS (
    SELECT doc_id, row_number() OVER () AS i, string_split(coalesce(text, ''), chr(10)) AS lines
    FROM documents
), lines AS (
    SELECT doc_id, i, unnest(lines) AS line, generate_subscripts(lines, 1) AS j FROM numbered
), keyed AS (
    SELECT *, {LOWER.format(f"trim(line, {WHITE})")} AS key FROM lines
), frequent AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT i) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
    count(*) FILTER (key IN (FROM frequent)) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY j) FILTER (key NOT IN (FROM frequent)), ''))
        AS kept_sha256
FROM keyed GROUP BY i
"""

# Comments, and elements whose content is text: this SQL's patterns know no back references.
_TEXT_ONLY = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
NO_MARKUP = r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))" + "".join(
    rf"|<{name}[\s/>].*?(?:</{name}[\s/>]|\z)" for name in _TEXT_ONLY
)
_QUOTED = {name: sign.replace("'", "''") for name, sign in NAMED.items()}
_NAMED = "MAP {" + ", ".join(f"'{name}': '{sign}'" for name, sign in _QUOTED.items()) + "}"
_CODE = r"""coalesce(try_cast(regexp_extract(part, '^&#([0-9]+);$', 1) AS INTEGER),
    try_cast('0x' || regexp_extract(part, '^&#[xX]0*([0-9a-fA-F]+);$', 1) AS INTEGER))"""
DECODED = f"""array_to_string(list_transform(regexp_extract_all(target, '{REFERENCES}'), lambda part: CASE
    WHEN {_CODE} BETWEEN 1 AND 1114111 AND {_CODE} NOT BETWEEN 55296 AND 57343 THEN chr({_CODE})
    ELSE coalesce({_NAMED}[regexp_extract(part, '^&([a-zA-Z]+);$', 1)], part) END), '')"""

# Links between urls, the urls that a chain of links joins, and the decisions of their rules.
URL_FILTER = rf"""
WITH RECURSIVE rules(host, path, verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), tags AS (
    SELECT url, unnest(regexp_extract_all(regexp_replace(html, '{NO_MARKUP}', ' ', 'g'),
        '(?i)<(?:link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*|meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*)>')) AS tag
    FROM pages
), targets AS (
    SELECT url, split_part(url, '://', 1) || '://' AS base,
        regexp_extract(tag, '(?i)\b(?:href\s*=\s*["'']?\s*|url\s*=\s*[''"]?\s*)([^"''\s>]+)', 1) AS target,
        regexp_extract(url, '://([^/?#]*)', 1) AS host,
        regexp_replace(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '[^/]*$', '') AS folder
    FROM tags WHERE contains(url, '://')
), decoded AS (
    SELECT * REPLACE ({DECODED} AS target) FROM targets
), raw_edges AS (
    SELECT url AS src, CASE WHEN regexp_matches(target, '(?i)^[a-z][a-z0-9+.\-]*://') THEN target
        WHEN starts_with(target, '//') THEN split_part(base, '//', 1) || target
        WHEN starts_with(target, '/') THEN base || host || target
        ELSE base || host || CASE folder WHEN '' THEN '/' ELSE folder END || target END AS dst
    FROM decoded WHERE target <> ''
), nodes AS (
    SELECT url, {LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")} AS host,
        regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path,
        {LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")} || regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS node
    FROM (SELECT url FROM pages UNION SELECT src FROM raw_edges UNION SELECT dst FROM raw_edges)
), fits AS (
    SELECT n.url, r.host || r.path AS rule, r.verdict,
        row_number() OVER (PARTITION BY n.url ORDER BY length(r.host || r.path) DESC, length(r.host) DESC, r.verdict) AS place
    FROM nodes n JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
), edges AS (
    SELECT a.node AS src, b.node AS dst FROM raw_edges e JOIN nodes a ON a.url = e.src JOIN nodes b ON b.url = e.dst
), reach(src, dst) AS (
    SELECT src, src FROM edges UNION SELECT dst, dst FROM edges
    UNION
    SELECT r.src, CASE WHEN e.src = r.dst THEN e.dst ELSE e.src END
    FROM reach r JOIN edges e ON r.dst = e.src OR r.dst = e.dst
), taken AS (
    SELECT r.src AS node, min(f.verdict) AS verdict
    FROM reach r JOIN nodes n ON n.node = r.dst JOIN fits f ON f.url = n.url AND f.place = 1
    GROUP BY r.src
)
SELECT p.page_id, coalesce(n.host, '') AS host, coalesce(n.path, '') AS path, f.rule,
    coalesce(f.verdict, t.verdict, 'allow') AS verdict
FROM pages p LEFT JOIN nodes n ON n.url = p.url
LEFT JOIN fits f ON f.url = p.url AND f.place = 1
LEFT JOIN taken t ON t.node = n.node
"""

# A turn has 12 + 1 + 10 + 1 characters of template; escapes add one character each.
CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
        (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
        count(*) OVER (PARTITION BY conv_id) AS n,
        sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')))
            OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars) FILTER (role = 'assistant' OR place = n)::BIGINT AS formatted_chars
FROM placed GROUP BY conv_id
"""

# The cut of a candidate with the lowest score; products are computed in 128 bits.
COLLOCATIONS = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), placed AS (
    SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS j
    FROM words, (VALUES (1), (2), (3), (4)) AS sizes(k)
), grams AS (
    SELECT lang, k, array_to_string(w[j:j + k - 1], ' ') AS phrase, count(*) AS f FROM placed GROUP BY ALL
), candidates AS (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM grams WHERE k >= 2 AND f >= 30
), cuts AS (
    SELECT *, unnest(generate_series(1, k - 1)) AS q FROM candidates
), scores AS (
    SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score, c.q
    FROM cuts c
    JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:q], ' ')
    JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[q + 1:], ' ')
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, q) = 1
), sizes AS (
    SELECT lang, w, a, k, unnest(generate_series(2, k - 1)) AS size FROM candidates
), places AS (
    SELECT *, unnest(generate_series(1, k - size + 1)) AS j FROM sizes
), inside AS (
    SELECT lang, array_to_string(w[j:j + size - 1], ' ') AS phrase, max(a) AS longer FROM places GROUP BY ALL
), ranked AS (
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank,
        s.phrase, a, l, r, score
    FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE coalesce(100::HUGEINT * longer < 80::HUGEINT * a, true)
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# CRC-32 bit by bit over the digits; a path is the list of its turns' digests.
PREFIX_TRIE = r"""
WITH turns AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(coalesce(role, '')), encode(coalesce(text, ''))) AS p
    FROM conversations WHERE conv_id IS NOT NULL
), steps AS (
    SELECT c, list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(c::VARCHAR, ''),
        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))) AS steps
    FROM (SELECT DISTINCT c FROM turns)
), convs AS (
    SELECT c, c - c % 100 AS base, xor(list_reduce(steps, lambda s, x: CASE WHEN x >= 0 THEN xor(s, x)
        WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384::BIGINT) ELSE s >> 1 END), 4294967295::BIGINT) % 6 AS h
    FROM steps
), parts AS (
    SELECT v.c, 0 AS own, t.p, t.role, t.text FROM convs v JOIN turns t ON t.c = v.base AND t.p <= v.h
    UNION ALL
    SELECT v.c, 1, t.p, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.p > v.h
), rebuilt AS (
    SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d,
        sha256(length(role) || ' ' || role || text) AS turn, length(text) AS chars
    FROM parts
), paths AS (
    SELECT c, d, chars, sha256(array_to_string(list(turn) OVER (PARTITION BY c ORDER BY d), ' ')) AS node FROM rebuilt
    UNION ALL SELECT c, 0, 0, '' FROM convs
), members AS (
    SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent, max(d) OVER (PARTITION BY c) AS total FROM paths
), nodes AS (
    SELECT node, any_value(d) AS d, any_value(parent) AS parent, any_value(chars) AS chars, min(c) AS conv_id,
        count(*) AS n_convs, max(total) = any_value(d) AS leaf,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = total), '') AS ends
    FROM members GROUP BY node
), below AS (
    SELECT m.node, count(*) FILTER (v.leaf) AS n_leaves, sum((v.n_convs - 1) * v.chars) AS saved
    FROM nodes v JOIN members m ON m.c = v.conv_id AND m.d <= v.d GROUP BY m.node
), children AS (
    SELECT parent, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs,
    coalesce(k.n_children, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves,
    b.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v JOIN below b USING (node)
LEFT JOIN nodes p ON p.node = v.parent LEFT JOIN children k ON k.parent = v.node
"""

ORACLE: dict[str, str] = {
    "op3_line_dedup": LINE_DEDUP,
    "op9_chat_format": CHAT_FORMAT,
    "op6_url_filter": URL_FILTER,
    "op11_collocations": COLLOCATIONS,
    "op13_prefix_trie": PREFIX_TRIE,
}
