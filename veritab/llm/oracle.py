"""DuckDB SQL for the queries that SQL can express.

The others are tested in tests/llm: 1 and 3 (learned scores) by their accuracy on
held-out rows, 2 and 10 (token ids) piece by piece against the library, 5 (a
seeded 64-bit hash that SQL lacks), 12 and 13 (vectors) against plain versions,
9 (HTML) against the documents that the pages show and on single pages.
"""

from __future__ import annotations

from typing import NamedTuple

from veritab.llm.line_dedup import RUN_WORDS
from veritab.llm.quality_rules import RULES, STOP_WORDS
from veritab.llm.url_reputation import FLOOR, SECOND_LABELS, STRONGEST, WEAKEST, Z

# values of the contracts, written out: words of a window, words of a repeat window, path rules
WINDOW, REPEAT_WINDOW = 10, 5


class _Rule(NamedTuple):
    verdict: str
    host: str
    path: str
    name: str


PATH_RULES = (_Rule("allow", "com", "/", "com/"), _Rule("block", "example.com", "/en/", "example.com/en/"),
              _Rule("allow", "www.example.com", "/en/", "www.example.com/en/"),
              _Rule("block", "net", "/es/", "net/es/"), _Rule("block", "net", "/fr/", "net/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


_OP4 = f"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS words FROM benchmark),
item_runs AS (
  SELECT item, least({WINDOW}, len(words)) AS n, words,
         unnest(generate_series(1, len(words) - least({WINDOW}, len(words)) + 1)) AS i
  FROM item_words WHERE len(words) > 0),
known AS (SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS run FROM item_runs),
lengths AS (SELECT DISTINCT n FROM known),
doc_words AS (SELECT doc_id, {_words('text')} AS words FROM documents),
doc_starts AS (
  SELECT doc_id, n, words, unnest(generate_series(1, len(words) - n + 1)) AS i
  FROM doc_words JOIN lengths ON len(words) >= n),
hits AS (
  SELECT DISTINCT doc_id, i, d.n, item
  FROM (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS run FROM doc_starts) d
  JOIN known k ON k.n = d.n AND k.run = d.run),
spans AS (
  SELECT doc_id, i, i + n AS stop,
         max(i + n) OVER (PARTITION BY doc_id ORDER BY i, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached
  FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
covered AS (
  SELECT doc_id, sum(greatest(0, stop - greatest(i, coalesce(reached, 0)))) AS n_hit FROM spans GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words w LEFT JOIN covered c ON c.doc_id = w.doc_id LEFT JOIN named m ON m.doc_id = w.doc_id
"""


def _rules() -> str:
    tests = []
    for r in RULES:
        value = f"CAST({r.numerator} AS DOUBLE)" + (f" / nullif({r.denominator}, 0)" if r.denominator else "")
        bounds = [f"{value} >= {r.low}"] * (r.low is not None) + [f"{value} <= {r.high}"] * (r.high is not None)
        tests.append(f"(n_words < {r.least_words} OR coalesce({' AND '.join(bounds)}, true))")
    return " AND ".join(tests)


_CASES = ", ".join(f"'{w}'" for w in sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())}))
_NEXT = " ".join(f"|| ' ' || lead(w, {k}) OVER text_order" for k in range(1, REPEAT_WINDOW))
_OP6 = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
tokens AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM split),
windows AS (
  SELECT doc_id, i, w {_NEXT} AS run FROM tokens WINDOW text_order AS (PARTITION BY doc_id ORDER BY i)),
runs AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM windows WHERE run IS NOT NULL),
covered AS (
  SELECT doc_id, sum(least({REPEAT_WINDOW}, step)) AS n FROM (
    SELECT doc_id, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {REPEAT_WINDOW}) AS step
    FROM runs WHERE n > 1) GROUP BY doc_id),
counts AS (
  SELECT s.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(words, lambda w: w IN ({_CASES}))) AS BIGINT) AS n_stop_words,
         CAST(len(regexp_extract_all(text, '\p{{Lu}}')) AS BIGINT) AS n_capitals,
         CAST(len(regexp_extract_all(text, '!')) AS BIGINT) AS n_exclamations,
         CAST(len(regexp_extract_all(text, '(?m)^[\x20\t]*(?:[-*•]|\d+[.)])[\x20\t]')) AS BIGINT) AS n_list_lines,
         CAST(len(regexp_extract_all(text, '(?m)(?:\.\.\.|…)[\x20\t]*$')) AS BIGINT) AS n_open_lines
  FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id),
failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND {_rules()} AS kept FROM failed
"""

_OP8 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM lines),
placed AS (
  SELECT *, row_number() OVER text_order AS i, sum(n) OVER text_order AS upto
  FROM units WHERE n > 0 WINDOW text_order AS (PARTITION BY doc_id ORDER BY line_no)),
runs AS (
  SELECT a.doc_id, a.i AS first, b.i AS last
  FROM placed a JOIN placed b ON a.doc_id = b.doc_id AND a.i <= b.i AND b.upto - a.upto + a.n >= {RUN_WORDS}
                             AND b.i - a.i < {RUN_WORDS}),
spans AS (
  SELECT doc_id, max(first) AS first, last FROM runs GROUP BY doc_id, last
  UNION SELECT doc_id, first, min(last) FROM runs GROUP BY doc_id, first),
texts AS (
  SELECT doc_id, list(line ORDER BY i) AS all_lines, list(line_no ORDER BY i) AS numbers FROM placed GROUP BY doc_id),
windows AS (
  SELECT s.doc_id, first, numbers[first:last] AS numbers,
         row_number() OVER (PARTITION BY array_to_string(all_lines[first:last], chr(10)) ORDER BY s.doc_id, first) AS k
  FROM spans s JOIN texts t ON t.doc_id = s.doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(numbers) AS line_no FROM windows WHERE k > 1),
rebuilt AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL) AS text,
         count(*) AS n_lines, count(g.line_no) AS n_deleted
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line_no = l.line_no GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(r.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted
FROM documents d LEFT JOIN rebuilt r ON r.doc_id = d.doc_id
"""

def _level(name: str, key: str, children: str) -> str:
    """One level of shrinkage: ``children`` has key, good, bad, prior."""
    return f"""
{name}_in AS ({children}),
{name}_fit AS (
  SELECT greatest(0, (sum(n * pow(good / n - prior, 2)) - (count(*) - 1) * avg(prior * (1 - prior)))
                     / nullif(sum(n) - sum(n * n) / sum(n), 0)) AS between_var,
         avg(prior * (1 - prior)) AS noise
  FROM (SELECT *, CAST(good + bad AS DOUBLE) AS n FROM {name}_in)),
{name} AS (
  SELECT {key}, good + prior * m AS a, bad + (1 - prior) * m AS b,
         (good + prior * m) / (good + bad + m) AS mean
  FROM {name}_in, (SELECT CASE WHEN between_var > 0 THEN least({STRONGEST}, greatest({WEAKEST}, noise / between_var - 1))
                          ELSE {STRONGEST} END AS m FROM {name}_fit))"""


def _chain(column: str) -> str:
    rules = sorted(PATH_RULES, key=lambda r: -len(r.name))
    return "CASE " + " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{getattr(r, column)}'" for r in rules) + " END"


_TWO_LABELS = rf"^({'|'.join(SECOND_LABELS)})\.[a-z][a-z]$"
_ADDRESS = r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$"
_BOUND = f"""round(least(1.0, a / (a + b) + {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1))), 6)"""
_OP7 = rf"""
WITH urls AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
named AS (
  SELECT *, CASE WHEN regexp_matches(site, '{_ADDRESS}') THEN site
                 WHEN regexp_matches(two, '{_TWO_LABELS}') THEN three ELSE two END AS domain,
         CASE WHEN regexp_matches(site, '{_ADDRESS}') THEN site
              WHEN regexp_matches(two, '{_TWO_LABELS}') THEN two ELSE labels[-1] END AS suffix
  FROM (SELECT *, array_to_string(labels[-2:], '.') AS two, array_to_string(labels[-3:], '.') AS three
        FROM (SELECT *, string_split(site, '.') AS labels
              FROM (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':\d*$', '') AS site FROM urls)))),
good_docs AS (SELECT doc_id, min(quality) * (1 - max(toxic)) AS good FROM labels GROUP BY doc_id),
counts AS (
  SELECT host, domain, suffix, sum(good) AS good, sum(1 - good) AS bad
  FROM named JOIN good_docs ON doc_id = TRY_CAST(nullif(regexp_extract(path, '/(\d{{1,18}})(?:\.html|/)?$', 1), '') AS BIGINT)
  WHERE good IS NOT NULL GROUP BY host, domain, suffix),
whole AS (
  SELECT CAST(coalesce(sum(good), 0) + 1 AS DOUBLE) AS a, CAST(coalesce(sum(bad), 0) + 1 AS DOUBLE) AS b FROM counts),
{_level('suffixes', 'suffix', """
  SELECT suffix, sum(good) AS good, sum(bad) AS bad, max(a / (a + b)) AS prior FROM counts, whole GROUP BY suffix""")},
{_level('domains', 'domain', """
  SELECT domain, g.good, g.bad, s.mean AS prior
  FROM (SELECT domain, suffix, sum(good) AS good, sum(bad) AS bad FROM counts GROUP BY domain, suffix) g
  JOIN suffixes s ON s.suffix = g.suffix""")},
{_level('hosts', 'host', """
  SELECT host, c.good, c.bad, d.mean AS prior FROM counts c JOIN domains d ON d.domain = c.domain""")},
bounds AS (
  SELECT page_id, n.host, path, coalesce(h.a, d.a, s.a, w.a) AS a, coalesce(h.b, d.b, s.b, w.b) AS b
  FROM named n LEFT JOIN hosts h ON h.host = n.host LEFT JOIN domains d ON d.domain = n.domain
  LEFT JOIN suffixes s ON s.suffix = n.suffix CROSS JOIN whole w)
SELECT page_id, host, path, {_chain('name')} AS rule,
       coalesce({_chain('verdict')}, CASE WHEN {_BOUND} < {FLOOR} THEN 'block' ELSE 'allow' END) AS verdict,
       {_BOUND} AS bound
FROM bounds
"""

_OP11 = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM digests JOIN groups USING (text_sha256)
"""

SQL: dict[str, str] = {
    "op4_decontamination": _OP4,
    "op6_quality_rules": _OP6,
    "op7_url_reputation": _OP7,
    "op8_line_dedup": _OP8,
    "op11_exact_dedup": _OP11,
}
