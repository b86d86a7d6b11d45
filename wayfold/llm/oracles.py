"""SQL that DuckDB runs on the same tables, for the queries it can express."""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"
RUNS = r"'[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]'"

OP6 = r"""
WITH captures AS (
  SELECT page_id, nullif(regexp_replace(regexp_extract(lower(url), '^https?://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '') AS host,
         DATE '2024-01-01' + CAST(page_id % 360 AS INT) AS fetched_on
  FROM pages),
hosts AS (SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 7))::BIGINT AS n FROM captures WHERE host IS NOT NULL),
patterns AS (
  SELECT host AS pattern, n FROM hosts WHERE n % 2 = 0
  UNION
  SELECT p, ('0x' || substr(md5(p), 1, 7))::BIGINT
  FROM (SELECT DISTINCT array_to_string(string_split(host, '.')[-2:], '.') AS p FROM hosts)),
entries AS (
  SELECT pattern, 'block' AS kind, DATE '2024-01-01' + CAST(n % 200 AS INT) AS listed_on FROM patterns
  UNION ALL
  SELECT pattern, 'remove', DATE '2024-01-01' + CAST(n % 200 + 30 + n % 41 AS INT) FROM patterns
  UNION ALL
  SELECT pattern, CASE n % 3 WHEN 0 THEN 'allow' ELSE 'block' END, DATE '2024-01-01' + CAST(n % 200 + 100 + n % 37 AS INT) FROM patterns),
daily AS (
  SELECT pattern, listed_on AS valid_from, arg_min(kind, CASE kind WHEN 'block' THEN 0 WHEN 'allow' THEN 1 ELSE 2 END) AS kind
  FROM entries GROUP BY ALL),
intervals AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY pattern ORDER BY valid_from) AS valid_to FROM daily),
decided AS (
  SELECT c.page_id, arg_max(pattern, length(pattern)) AS pattern, arg_max(kind, length(pattern)) AS kind
  FROM captures c JOIN intervals i ON (c.host = i.pattern OR ends_with(c.host, '.' || i.pattern))
   AND kind <> 'remove' AND valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to)
  GROUP BY c.page_id)
SELECT page_id, host, fetched_on, pattern, kind, coalesce(kind = 'block', false) AS blocked
FROM captures LEFT JOIN decided USING (page_id)
"""

OP7 = rf"""
WITH counted AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), {WORDS})) AS words,
         len(regexp_extract_all(coalesce(text, ''), {RUNS})) AS runs
  FROM documents),
kept AS (
  SELECT source, lang, CASE WHEN doc_id % 3 = 0 THEN 'runs-2' ELSE 'words-1' END AS tokenizer,
         CASE WHEN doc_id % 3 = 0 THEN runs ELSE words END AS n
  FROM counted WHERE doc_id % 7 <> 0)
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens
FROM kept GROUP BY ALL
"""

OP8 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
grams AS (
  SELECT doc_id, place, words[place] || ' ' || words[place + 1] || ' ' || words[place + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS place FROM docs)),
twice AS (SELECT doc_id, place FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT place + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
words AS (SELECT doc_id, lang, unnest(words) AS word FROM docs),
counts AS (SELECT lang, word, count(*) AS n FROM words GROUP BY ALL),
classes AS (
  SELECT *, length(regexp_replace(word, '\P{Lu}', '', 'g')) AS upper, length(regexp_replace(word, '\P{L}', '', 'g')) AS letters, length(word) AS chars
  FROM counts),
totals AS (
  SELECT lang, sum(n) AS total, sum(n * upper) / sum(n * chars) AS q1, sum(n * (letters - upper)) / sum(n * chars) AS q2,
         sum(n * (chars - letters)) / sum(n * chars) AS q3
  FROM classes GROUP BY lang),
common AS (SELECT lang, word, n / total AS q FROM counts JOIN totals USING (lang) WHERE n >= 0.004 * total),
own AS (SELECT doc_id, lang, word, count(*) AS n FROM words GROUP BY ALL),
sizes AS (
  SELECT doc_id, lang, sum(n) AS n, sum(n * length(word)) AS chars,
         sum(n * length(regexp_replace(word, '\P{Lu}', '', 'g'))) AS upper, sum(n * length(regexp_replace(word, '\P{L}', '', 'g'))) AS letters
  FROM own GROUP BY ALL),
shares AS (
  SELECT s.doc_id, c.q, coalesce(o.n, 0) / s.n AS p
  FROM sizes s JOIN common c USING (lang) LEFT JOIN own o ON o.doc_id = s.doc_id AND o.word = c.word),
bins AS (
  SELECT doc_id, q, p FROM shares
  UNION ALL
  SELECT doc_id, 1 - sum(q), 1 - sum(p) FROM shares GROUP BY doc_id),
word_distance AS (
  SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM bins GROUP BY doc_id),
class_bins AS (
  SELECT doc_id, unnest([upper / chars, (letters - upper) / chars, (chars - letters) / chars]) AS p, unnest([q1, q2, q3]) AS q
  FROM sizes JOIN totals USING (lang)),
class_distance AS (
  SELECT doc_id, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM class_bins GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, d.lang, len(d.words) AS n_words, coalesce(s.chars, 0)::BIGINT AS word_chars,
         length(d.text) - length(translate(d.text, '#*$%&|<>', '')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_words >= 100 AND total >= 2000 AND (coalesce(c.d > 0.25, false) OR coalesce(w.d > 0.3, false))) AS kept
FROM failed f LEFT JOIN totals USING (lang) LEFT JOIN class_distance c USING (doc_id) LEFT JOIN word_distance w USING (doc_id)
"""
