"""SQL of the operators that SQL can express."""

from __future__ import annotations

from partatlas.llm import quality as q

_RATES = {
    "symbols_per_mille": "1000 * n_symbols // greatest(n_words, 1)",
    "dup_lines_per_mille": "1000 * n_dup_lines // greatest(n_lines, 1)",
    "stutter_per_mille": "1000 * n_stutter // greatest(n_words, 1)",
    "repeats_per_mille": "1000 * n_repeat_words // greatest(n_words, 1)",
    "word_length_percent": "100 * word_chars // greatest(n_words, 1)",
}
_LONG = "\n    UNION ALL ".join(
    f"SELECT rid, lang, source, base_failed, '{r}' AS rate, {e} AS value FROM measured" for r, e in _RATES.items())
_FLOOR = " ".join(f"WHEN '{r}' THEN {floor}" for r, (_, _, floor, _) in q.RULES.items())
_UPPER = " ".join(f"WHEN '{r}' THEN {k}" for r, (k, *_) in q.RULES.items())
_SPARSE = ", ".join(f"'{r}'" for r, (_, nonzero, _, _) in q.RULES.items() if nonzero)
_BOTH = ", ".join(f"'{r}'" for r, (*_, both) in q.RULES.items() if both)

QUALITY_SQL = rf"""
WITH worded AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
placed AS (
  SELECT rid, words, unnest(range(1, len(words) - 6)) AS pos FROM worded WHERE len(words) > 8),
windows AS (SELECT rid, pos, list_slice(words, pos, pos + 7) AS win FROM placed),
again AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n FROM windows),
covered AS (
  SELECT rid, sum(least(8, gap)) AS n_repeat_words
  FROM (SELECT rid, coalesce(lead(pos) OVER (PARTITION BY rid ORDER BY pos) - pos, 8) AS gap FROM again WHERE n > 1)
  GROUP BY rid),
counted AS (
  SELECT w.rid, doc_id, lang, source, len(words) AS n_words,
    coalesce(length(array_to_string(words, '')), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutter,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM worded w LEFT JOIN covered c ON w.rid = c.rid),
measured AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted),
long AS (
    {_LONG}),
binned AS (
  SELECT lang, source, rate,
    (value >> greatest(length(bin(value)) - 8, 0)::INT) << greatest(length(bin(value)) - 8, 0)::INT AS bin
  FROM long WHERE NOT base_failed),
levels AS (
  SELECT 0 AS level, lang, source, rate, bin FROM binned
  UNION ALL SELECT 1, lang, NULL, rate, bin FROM binned
  UNION ALL SELECT 2, NULL, NULL, rate, bin FROM binned),
sketches AS (SELECT level, lang, source, rate, bin, count(*) AS n FROM levels GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bin) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, rate) AS total,
    CASE WHEN rate IN ({_SPARSE})
      THEN coalesce(sum(n) FILTER (bin = 0) OVER (PARTITION BY level, lang, source, rate), 0) ELSE 0 END AS skipped
  FROM sketches),
quartiles AS (
  SELECT level, lang, source, rate, max(total) AS total,
    min(CASE WHEN 4 * upto >= total THEN bin END) AS q1, min(CASE WHEN 4 * upto >= 3 * total THEN bin END) AS q3,
    coalesce(min(CASE WHEN (bin > 0 OR rate NOT IN ({_SPARSE}))
      AND 1000 * (upto - skipped) >= CASE rate {_UPPER} END * (total - skipped) THEN bin END), 0) AS upper
  FROM running GROUP BY ALL),
chosen AS (
  SELECT a.lang, a.source, a.rate,
    CASE WHEN a.total >= {q.MIN_GROUP} THEN a.q1 WHEN b.total >= {q.MIN_GROUP} THEN b.q1 ELSE c.q1 END AS q1,
    CASE WHEN a.total >= {q.MIN_GROUP} THEN a.q3 WHEN b.total >= {q.MIN_GROUP} THEN b.q3 ELSE c.q3 END AS q3,
    CASE WHEN a.total >= {q.MIN_GROUP} THEN a.upper WHEN b.total >= {q.MIN_GROUP} THEN b.upper ELSE c.upper END AS upper,
    CASE a.rate {_FLOOR} END AS slack
  FROM quartiles a
  JOIN quartiles b ON b.level = 1 AND a.lang IS NOT DISTINCT FROM b.lang AND a.rate = b.rate
  JOIN quartiles c ON c.level = 2 AND a.rate = c.rate
  WHERE a.level = 0),
outside AS (
  SELECT rid, bool_or(value > upper + {q.REACH} * (q3 - q1) + slack
    OR long.rate IN ({_BOTH}) AND value < q1 - {q.REACH} * (q3 - q1) - slack) AS odd
  FROM long JOIN chosen ON long.lang IS NOT DISTINCT FROM chosen.lang
    AND long.source IS NOT DISTINCT FROM chosen.source AND long.rate = chosen.rate
  GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(odd, false) AS kept
FROM measured LEFT JOIN outside USING (rid)
"""
