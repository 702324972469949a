"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

from bedfeed.llm.secrets import BASE, RULES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_SPACED}') AS words FROM d),
threes AS (SELECT r, i, words[i + 1] AS a, words[i + 2] AS b, words[i + 3] AS c FROM (
  SELECT r, words, unnest(range(len(words) - 2)) AS i FROM w)),
often AS (SELECT r, i FROM threes QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM often, range(3) AS x(k) GROUP BY r),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup FROM (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_SPACED}') GROUP BY r),
f AS (SELECT r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
    coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)),
broken AS (SELECT r, source, 'many_symbols' AS rule, 1 AS place, 10 * n_symbols > n_words AS bad FROM f
  UNION ALL SELECT r, source, 'dup_lines', 2, 10 * n_dup_lines > 3 * n_lines FROM f
  UNION ALL SELECT r, source, 'odd_words', 3, word_chars < 3 * n_words OR word_chars > 12 * n_words FROM f),
hosts AS (SELECT source, rule, place, count(*) AS n, count(*) FILTER (bad) AS k FROM broken WHERE source IS NOT NULL GROUP BY ALL),
sums AS (SELECT rule, count(*) AS h, sum(n) AS n, sum(n * n) AS squares, sum(k) / sum(n) AS mean FROM hosts GROUP BY rule),
spread AS (SELECT rule, sum(n * (k / n - mean) ** 2) AS s FROM hosts JOIN (SELECT rule, mean FROM sums) USING (rule) GROUP BY rule),
prior AS (SELECT rule, mean, 1 / least(greatest(CASE WHEN mean > 0 AND mean < 1 AND n - squares / n - (h - 1) > 0
    THEN (s / (mean * (1 - mean)) - (h - 1)) / (n - squares / n - (h - 1)) ELSE 0 END, 1e-6), 1 - 1e-6) - 1 AS weight
  FROM sums JOIN spread USING (rule)),
known AS (SELECT source, rule, place FROM hosts JOIN prior USING (rule) WHERE (k + weight * mean) / (n + weight) > 0.3),
rules AS (SELECT source, string_agg(rule, ',' ORDER BY place) AS host_rules FROM known GROUP BY source),
lost AS (SELECT DISTINCT r FROM broken JOIN known USING (source, rule) WHERE bad)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost.r IS NULL AS kept, coalesce(host_rules, '') AS host_rules
FROM f LEFT JOIN lost ON f.r = lost.r LEFT JOIN rules ON f.source = rules.source"""

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_PLAIN}') AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_PLAIN}') AS words
  FROM benchmark),
known AS (SELECT DISTINCT item, n, array_to_string(words[i + 1:i + n], ' ') AS key FROM (
  SELECT item, words, least(13, len(words)) AS n, unnest(range(len(words) - least(13, len(words)) + 1)) AS i FROM b WHERE len(words) > 0)),
seen AS (SELECT r, i, n, array_to_string(words[i + 1:i + n], ' ') AS key FROM (
  SELECT r, words, n, unnest(range(len(words) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM known) WHERE len(words) >= n)),
hits AS (SELECT r, i, n, item FROM seen JOIN known USING (n, key)),
words AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.words) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SPACED}') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i + 1:i + 4], ' ') AS x FROM (
  SELECT doc_id, words, unnest(range(greatest(1, len(words) - 3))) AS i FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN n USING (doc_id)"""

FILTER_AUDIT = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{_SPACED}') AS words FROM d),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, [CAST(len(words) < 100 AS INT), CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INT),
    CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS INT), CAST(regexp_matches(t, '[#$%&*|]') AS INT),
    CAST(coalesce(d_id > first, false) AS INT)] AS fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM (SELECT doc_id AS d_id, part, t, words FROM w) JOIN firsts USING (t) LEFT JOIN marks ON d_id = marks.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
orders(o) AS (SELECT '' UNION ALL SELECT o || x FROM orders, unnest(['A', 'B', 'C', 'D', 'E']) AS l(x) WHERE NOT contains(o, x)),
steps AS (SELECT o, k, instr('ABCDE', substr(o, k, 1)) AS place, list_transform(range(1, k), lambda j: instr('ABCDE', substr(o, j, 1))) AS before
  FROM orders, range(1, 6) AS s(k) WHERE length(o) = 5),
seen AS (SELECT part, o, k, place, n, good, toxic, fails[place] = 1 AS bad, coalesce(list_sum(list_transform(before, lambda j: fails[j])), 0) > 0 AS gone,
    list_sum(fails) AS times FROM cells, steps),
sums AS (SELECT part, o, k, place, coalesce(sum(n) FILTER (NOT bad AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (bad AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (bad AND gone), 0) AS redundant, coalesce(sum(n) FILTER (bad AND times = 1), 0) AS alone,
    coalesce(sum(good) FILTER (bad AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (bad AND NOT gone), 0) AS toxic_lost
  FROM seen GROUP BY part, o, k, place)
SELECT part, o AS filter_order, CAST(k AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(alone AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, place) AS BIGINT) AS shapley
FROM sums"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEXICAL_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS words FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS words FROM benchmark),
sums AS (SELECT count(*) FILTER (len(words) > 0) AS docs, CAST(sum(len(words)) AS BIGINT) AS terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY r, term),
q AS (SELECT i, item_id, term, count(*) AS k FROM (SELECT i, item_id, unnest(words) AS term FROM b) GROUP BY i, item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), sums),
m AS (SELECT r, doc_id, 75 + (25 * CAST(len(words) AS BIGINT) * docs) // terms AS m FROM d, sums WHERE len(words) > 0),
s AS (SELECT i, item_id, doc_id, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY i, item_id, doc_id, r)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 20"""


def _secrets() -> str:
    """Matches and the pieces between them, added up to positions, for every rule."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    rules = ", ".join(f"({n}, {quoted(r.kind)}, {quoted(f'(?:{r.head})({r.tail}+)')}, {r.least})" for n, r in enumerate(RULES))
    texts = ("string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, place) FILTER (place < %d)" % BASE, "string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, place)")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
rules(place, kind, pattern, least) AS (VALUES {rules}),
m AS (SELECT r, place, kind, least, regexp_extract_all(t, pattern) AS found, regexp_extract_all(t, pattern, 1) AS tails, string_split_regex(t, pattern) AS gaps
  FROM d, rules),
e AS (SELECT r, place, kind, least, found, tails, gaps, unnest(range(1, len(found) + 1)) AS j FROM m),
s AS (SELECT r, place, kind, length(found[j]) AS n,
    CAST(list_sum(list_transform(gaps[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:j - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM e WHERE length(tails[j]) >= least),
g AS (SELECT r, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access, count(*) FILTER (place = 2) AS n_hex,
    {texts[0]} AS base, {texts[1]} AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)"""


SECRETS = _secrets()
