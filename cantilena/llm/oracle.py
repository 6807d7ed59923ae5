"""SQL that gives the rows of this subpackage's queries, where SQL can express them."""

from __future__ import annotations

_TEXT = "coalesce(text, '')"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_LINE_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split({_TEXT}, chr(10)) AS lines FROM documents),
placed AS (SELECT r, doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM docs),
keyed AS (SELECT r, doc_id, i, lines[i] AS line, translate(trim(lines[i], {_SPACES}), {_AZ}) AS key FROM placed),
found AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT k.*, f.first IS NOT NULL AND f.first <> k.doc_id AS dropped FROM keyed k LEFT JOIN found f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


_CHAT = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER w - 1 AS i, lag(role) OVER w AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last,
  length('<turn role=') + length(role) + 2 + length('
</turn>
') + length(replace(replace(replace(text, '\', '\\'), '<turn role=', '<\turn role='), '</turn>', '<\/turn>')) AS c FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
m AS (SELECT *, CASE WHEN i = 0 THEN role IN ('system', 'user') WHEN role = 'user' THEN before IN ('system', 'assistant') WHEN role = 'assistant' THEN before = 'user' ELSE FALSE END AS fine FROM n),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS loss, sum(c)::BIGINT AS formatted_chars,
  coalesce(min(i) FILTER (NOT fine), max(CASE WHEN last AND role <> 'assistant' THEN i + 1 END))::INT AS error_at FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, error_at IS NULL AS valid, error_at FROM g
"""

_WORD_LIST = r"list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_STATS = {"word_length": ("word_chars / n_words", 3), "symbols": ("(n_symbols + 1) / (word_chars + 100)", 3), "dup_lines": ("(n_dup_lines + 1) / (n_text_lines + 10)", 2), "repeats": ("(n_repeat_words + 3) / (n_words + 100)", 3)}


def _bucket(value: str) -> str:
    return f"ceil(round(ln({value}) / ln(1.01::DOUBLE / 0.99::DOUBLE), 6))::INT"


def _fence(name: str, by: str) -> str:
    """Quartiles of each group and statistic."""
    return f"""{name} AS (SELECT {by}, stat, any_value(total) AS n, min(b) FILTER (cum >= ceil(total * 0.25)) AS lo, min(b) FILTER (cum >= ceil(total * 0.75)) AS hi
  FROM (SELECT {by}, stat, b, sum(n) OVER (PARTITION BY {by}, stat ORDER BY b) AS cum, sum(n) OVER (PARTITION BY {by}, stat) AS total
    FROM (SELECT {by}, stat, b, sum(n) AS n FROM hist GROUP BY ALL)) GROUP BY {by}, stat)"""


def _judge(stat: str) -> str:
    lo, hi = (f"CASE WHEN f1.n >= 100 AND f1.lo < f1.hi THEN f1.{x} WHEN f2.n >= 100 AND f2.lo < f2.hi THEN f2.{x} ELSE f3.{x} END" for x in ("lo", "hi"))
    return f"""l_{stat} AS (SELECT f1.lang, f1.source, {lo} AS lo, {hi} AS hi, {_STATS[stat][1]} * (({hi}) - ({lo})) AS reach
  FROM f1 JOIN f2 ON f2.stat = f1.stat AND f2.lang IS NOT DISTINCT FROM f1.lang JOIN f3 ON f3.stat = f1.stat WHERE f1.stat = '{stat}')"""


def _quality() -> str:
    each = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS stat, {_bucket(f'({v[0]})')} AS b FROM base WHERE NOT base_failed" for k, v in _STATS.items())
    tests = []
    for k, v in _STATS.items():
        x = _bucket(f"({v[0]})")
        low = f" OR {x} < l_{k}.lo - l_{k}.reach" if k == "word_length" else ""
        tests.append(f"WHEN {x} > l_{k}.hi + l_{k}.reach{low} THEN '{k}'")
    joins = " ".join(f"LEFT JOIN l_{k} ON l_{k}.lang IS NOT DISTINCT FROM base.lang AND l_{k}.source IS NOT DISTINCT FROM base.source" for k in _STATS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, {_TEXT} AS text FROM documents),
w AS (SELECT *, {_WORD_LIST} AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT r, i, words[i] || chr(31) || words[i + 1] || chr(31) || words[i + 2] AS gram FROM (SELECT r, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w WHERE len(words) > 2)),
x AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
y AS (SELECT r, count(DISTINCT i + j) AS n FROM x, (VALUES (0), (1), (2)) v(j) GROUP BY r),
c AS (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda q: length(q))), 0)::BIGINT AS word_chars,
  CASE WHEN len(words) = 0 THEN 0 ELSE length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) END::BIGINT AS n_symbols,
  len(lines)::BIGINT AS n_text_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(y.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN y USING (r)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
hist AS (SELECT lang, source, 1 AS every, stat, b, count(*) AS n FROM ({each}) GROUP BY ALL),
{_fence('f1', 'lang, source')}, {_fence('f2', 'lang')}, {_fence('f3', 'every')},
{', '.join(_judge(k) for k in _STATS)},
j AS (SELECT base.*, CASE WHEN base_failed THEN 'base' {' '.join(tests)} END AS rule FROM base {joins})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_text_lines, base_failed, rule IS NULL AS kept, rule FROM j
"""


_JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORD_LIST.replace('text', _TEXT)} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, chr(31)) ELSE array_to_string(words[i:i + 4], chr(31)) END AS gram
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c * 1.8 >= 0.8 * (x.n + y.n) - 1e-6),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b)
SELECT q.a AS doc_id, min(q.b) AS class_id, count(*) AS class_size, coalesce(any_value(k.n), 0)::BIGINT AS n_links
FROM reach q LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON k.a = q.a GROUP BY q.a
"""

#: A list of words in DuckDB is long, so these are for the small tables that the driver compares on; the rest is tested by brute force.
SQL = {"op1_chat_format": _CHAT, "op4_quality_rules": _quality(), "op5_jaccard_join": _JACCARD, "op9_line_dedup": _LINE_DEDUP}
