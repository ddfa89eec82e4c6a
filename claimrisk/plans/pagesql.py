"""The checking SQL of page elements.

The tokens are those of the column expressions, without possessive repetition, which DuckDB's regular
expressions neither know nor need; ranges of one element come from a recursion over the few tags that
open or close one.  Only the character references of the given pages are decoded.
"""

from __future__ import annotations

import re

from claimrisk.functions import html

TOKEN = re.sub(r"([+*])\+", r"\1", html.TOKEN).replace("'", "''")
SKIPPED = r"regexp_matches(token, '^(?:<[!?]|(?i:<script\b|<style\b))')"


def _names(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in sorted(names)) + ")"


# fixed values: the references of the given pages, the ampersand last
DECODED = {"&copy;": "©", "&middot;": "·", "&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "''",
           "&amp;": "&"}


def _decoded(text: str) -> str:
    for name, value in DECODED.items():
        text = f"replace({text}, '{name}', '{value}')"
    return text


_KINDS = " ".join(f"WHEN tag = '{t}' THEN '{k}'" for t, k in html.KINDS.items())

ELEMENTS = rf"""WITH RECURSIVE tokens AS (
  SELECT page_id, unnest(range(0, len(l))) AS pos, unnest(l) AS token
  FROM (SELECT page_id, regexp_extract_all(html, '{TOKEN}') AS l FROM pages)),
named AS (
  SELECT *, starts_with(token, '</') AS closes, {SKIPPED} AS skipped,
    CASE WHEN {SKIPPED} THEN '' ELSE lower(regexp_extract(token, '^</?([a-zA-Z][^\s/>]*)', 1)) END AS tag
  FROM tokens),
events AS (
  SELECT page_id, pos, tag, closes, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS n
  FROM named WHERE tag IN {_names(html.WHOLE)}),
walk AS (
  SELECT page_id, 0::BIGINT AS n, NULL::VARCHAR AS tag, 0 AS depth, 0::BIGINT AS first_at, NULL::BIGINT AS last_at
  FROM (SELECT DISTINCT page_id FROM events)
  UNION ALL
  SELECT w.page_id, e.n,
    CASE WHEN w.depth = 0 THEN CASE WHEN e.closes THEN NULL ELSE e.tag END ELSE w.tag END,
    CASE WHEN w.depth = 0 THEN CASE WHEN e.closes THEN 0 ELSE 1 END WHEN e.tag <> w.tag THEN w.depth
      WHEN e.closes THEN w.depth - 1 ELSE w.depth + 1 END,
    CASE WHEN w.depth = 0 THEN e.pos ELSE w.first_at END,
    CASE WHEN w.depth = 1 AND e.closes AND e.tag = w.tag THEN e.pos END
  FROM walk w JOIN events e ON e.page_id = w.page_id AND e.n = w.n + 1),
ranges AS (
  SELECT page_id, first_at, any_value(tag) AS tag, coalesce(max(last_at), 2147483647) AS last_at
  FROM walk WHERE tag IS NOT NULL GROUP BY page_id, first_at),
placed AS (
  SELECT t.*, r.tag AS whole, r.first_at IS NOT NULL AND (t.pos = r.first_at OR t.pos = r.last_at) AS edge
  FROM named t LEFT JOIN ranges r ON r.page_id = t.page_id AND t.pos BETWEEN r.first_at AND r.last_at),
summed AS (
  SELECT *, edge OR (whole IS NULL AND tag IN {_names(html.KINDS)}) AS starts,
    sum(CASE WHEN tag IN {_names(html.SILENT)} THEN CASE WHEN closes THEN -1 ELSE 1 END ELSE 0 END)
      OVER (PARTITION BY page_id ORDER BY pos) AS depth FROM placed),
cut AS (
  SELECT *, depth - least(0, min(depth) OVER (PARTITION BY page_id ORDER BY pos)) AS silent,
    sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY pos) AS element FROM summed),
pieces AS (
  SELECT page_id, element, pos,
    CASE WHEN starts AND NOT closes THEN CASE {_KINDS} ELSE 'text' END ELSE 'text' END AS kind,
    CASE WHEN tag = '' AND NOT skipped THEN CASE WHEN silent = 0 THEN {_decoded("token")} END
      WHEN skipped OR tag IN {_names(html.SILENT)} OR edge THEN NULL
      WHEN whole = 'table' AND tag IN {_names(html.CELLS)} THEN CASE WHEN closes THEN '</' ELSE '<' END || tag || '>'
      WHEN (whole IS NOT NULL OR tag = 'br') AND NOT closes THEN ' ' END AS piece FROM cut),
joined AS (
  SELECT page_id, element, arg_min(kind, pos) AS type,
    trim(regexp_replace(coalesce(string_agg(piece, '' ORDER BY pos), ''), '\s+', ' ', 'g')) AS content
  FROM pieces GROUP BY page_id, element),
elements AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY element) - 1 AS INTEGER) AS position,
    type, content
  FROM joined WHERE content <> '')"""
