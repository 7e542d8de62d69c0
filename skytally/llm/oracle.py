"""The same queries in SQL, where SQL can say them."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

LINES = """
pages AS (SELECT row_number() OVER () AS page, doc_id, coalesce(source, '') AS host, text FROM documents),
hosts AS (SELECT host, count(*) AS pages FROM pages GROUP BY host),
page_lines AS (
  SELECT page, host, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM pages WHERE text IS NOT NULL),
shared AS (
  SELECT host, line FROM page_lines JOIN hosts USING (host)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
  GROUP BY host, line, pages HAVING count(DISTINCT page) > 0.05 * pages AND count(DISTINCT page) >= 3),
left_lines AS (
  SELECT page, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
  FROM page_lines ANTI JOIN shared USING (host, line) GROUP BY page)
"""

OP4 = f"""
WITH {LINES}
SELECT doc_id, CASE WHEN pages.text IS NOT NULL THEN coalesce(left_lines.text, '') END AS text,
  coalesce(len(string_split(pages.text, chr(10))), 0) - CASE WHEN pages.text IS NULL THEN 0 ELSE coalesce(n, 0) END AS n_dropped
FROM pages LEFT JOIN left_lines USING (page)
"""

OP9 = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
places AS (
  SELECT row, i, array_to_string(words[i:i + 4], ' ') AS part
  FROM (SELECT row, words, unnest(generate_series(1, len(words) - 4)) AS i FROM texts)),
repeated AS (SELECT row, i FROM places QUALIFY count(*) OVER (PARTITION BY row, part) > 1),
covered AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words
  FROM repeated CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY row),
text_lines AS (
  SELECT row, line FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
line_counts AS (SELECT row, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM text_lines GROUP BY row),
measures AS (
  SELECT row, doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM texts LEFT JOIN covered USING (row) LEFT JOIN line_counts USING (row)),
verdicts AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT 100 * n_symbols > 25 * n_words AND NOT 100 * n_dup_lines > 50 * n_lines
  AND word_chars BETWEEN 2 * n_words AND 15 * n_words AS kept
FROM verdicts
"""


def _level(k: int, own: str, above: str, weights: str, source: str, given: str) -> str:
    """Budgets of one level of the tree: sorted by capacity per weight, filled nodes come first."""
    return f"""
nodes{k} AS (
  SELECT {own}, sum(cap)::HUGEINT AS cap, max({given})::HUGEINT AS given, max({weights})::HUGEINT AS w
  FROM {source} GROUP BY {own}),
sums{k} AS (
  SELECT *, coalesce(sum(cap) OVER before, 0)::HUGEINT AS used, (sum(w) OVER onward)::HUGEINT AS w_left FROM nodes{k}
  WINDOW before AS (PARTITION BY {above} ORDER BY cap::DOUBLE / w::DOUBLE, {own} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (PARTITION BY {above} ORDER BY cap::DOUBLE / w::DOUBLE, {own} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
marks{k} AS (SELECT *, cap * w_left <= (given - used) * w AS filled FROM sums{k}),
rests{k} AS (
  SELECT *, given - coalesce(sum(cap) FILTER (filled) OVER (PARTITION BY {above}), 0)::HUGEINT AS rest,
    (sum(w) FILTER (NOT filled) OVER (PARTITION BY {above}))::HUGEINT AS w_rest FROM marks{k}),
quotas{k} AS (SELECT {own}, CASE WHEN filled THEN cap ELSE rest * w // w_rest END AS quota FROM rests{k})"""


OP10 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS origin, coalesce(lang, '') AS language,
    CASE WHEN regexp_extract(source, '([0-9])$', 1) IN ('0', '1', '2', '3', '4') THEN 'web'
      WHEN regexp_extract(source, '([0-9])$', 1) IN ('5', '6', '7') THEN 'reference' ELSE 'forum' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens
  FROM documents),
leaves AS (
  SELECT domain, language, origin, sum(n_tokens)::HUGEINT AS tokens, 2 * sum(n_tokens)::HUGEINT AS cap,
    CASE domain WHEN 'web' THEN 5 WHEN 'reference' THEN 3 ELSE 2 END AS w1,
    CASE language WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w2
  FROM texts GROUP BY ALL),
whole AS (SELECT sum(tokens)::HUGEINT * 4 // 5 AS budget FROM leaves),
source1 AS (SELECT * FROM leaves, whole),{_level(1, "domain", "1", "w1", "source1", "budget")},
source2 AS (SELECT * FROM leaves JOIN quotas1 USING (domain)),{_level(2, "domain, language", "domain", "w2", "source2", "quota")},
source3 AS (SELECT * FROM leaves JOIN quotas2 USING (domain, language)),{_level(3, "domain, language, origin", "domain, language", "1", "source3", "quota")},
plan AS (
  SELECT domain, language, origin, CASE WHEN tokens > 0 THEN quota // tokens ELSE 0 END AS whole_epochs,
    CASE WHEN tokens > 0 THEN quota % tokens ELSE 0 END AS rest
  FROM leaves JOIN quotas3 USING (domain, language, origin)),
placed AS (
  SELECT *, md5('mix-1|' || whole_epochs || '|' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM texts JOIN plan USING (domain, language, origin)),
reached AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY key) AS upto FROM placed)
SELECT doc_id, domain, language, origin, n_tokens,
  (whole_epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::INTEGER AS repeats
FROM reached
"""

ORACLE = {"op4_line_dedup": OP4, "op9_quality_rules": OP9, "op10_mixing": OP10}
