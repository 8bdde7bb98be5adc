"""The license scan as DuckDB SQL: base phrases and templates by joins of words on their places."""

from __future__ import annotations

from ravelin.llm.license_scan import BASE, LEAST, LOWER, TEMPLATES, UPPER, WORD


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


def oracle() -> str:
    base = _values([(i, label, len(p.split()), step, w) for i, (p, label) in enumerate(BASE.items()) for step, w in enumerate(p.split())])
    pattern = _values([(n, i, w, t.drift, t.step) for n, t in enumerate(TEMPLATES) for i, w in t.words])
    names = _values([(n, t.label, len(t.words), len(t.phrases)) for n, t in enumerate(TEMPLATES)])
    phrases = _values([(n, k, i, len(p)) for n, t in enumerate(TEMPLATES) for k, p in enumerate(t.phrases) for i in p])
    return f"""
WITH base(phrase, label, size, step, w) AS (VALUES {base}),
pattern(template, place, w, drift, step) AS (VALUES {pattern}),
names(template, label, size, n_phrases) AS (VALUES {names}),
phrases(template, phrase, place, size) AS (VALUES {phrases}),
held AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}+') AS words FROM documents),
words AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS p FROM held),
starts AS (
  SELECT r, phrase, label, p - step AS begun FROM words JOIN base USING (w) GROUP BY r, phrase, label, size, p - step HAVING count(*) = any_value(size)),
based AS (SELECT r, count(*) AS n_base, min(begun) AS first_word, max(begun) AS last_word, list(DISTINCT label) AS base FROM starts GROUP BY r),
posted AS (
  SELECT r, template, place, p - place AS shift, unnest(CASE WHEN drift = 1 THEN [p - place] ELSE [CAST(floor((p - place) / step) AS BIGINT), CAST(floor((p - place) / step) AS BIGINT) - 1] END) AS win
  FROM words JOIN pattern USING (w)),
whole AS (
  SELECT r, template, win, phrase FROM posted JOIN phrases USING (template, place) GROUP BY r, template, win, phrase, shift HAVING count(*) = any_value(phrases.size)),
told AS (SELECT r, template, win, count(DISTINCT phrase) AS n FROM whole GROUP BY ALL),
shares AS (SELECT r, template, win, count(DISTINCT place) AS n FROM posted GROUP BY ALL),
own AS (
  SELECT s.r, list(DISTINCT label) AS own, max(s.n / CAST(size AS DOUBLE)) AS score FROM shares s JOIN told t ON t.r = s.r AND t.template = s.template AND t.win = s.win JOIN names ON names.template = s.template
  WHERE t.n = n_phrases AND s.n / CAST(size AS DOUBLE) >= {LEAST} GROUP BY s.r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ',') AS labels, coalesce(score, 0.0) AS score
FROM held LEFT JOIN based USING (r) LEFT JOIN own USING (r)
"""
