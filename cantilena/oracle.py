"""SQL that gives the rows of the registered queries."""

from __future__ import annotations

SQL: dict[str, str] = {}

_WORDS = """words AS (SELECT user_id AS entry, event_id, event_type, epoch_us(ts) / 1e6 AS start, epoch_us(ts) / 1e6 + value / 100 AS "end",
  value / 100 AS duration, least(value / 100, 1.0) AS prob FROM events)"""
_SEGMENTED = _WORDS + ", seg AS (SELECT *, floor(start / 86400)::BIGINT AS seg FROM words)"
_CAPTIONS = "cap AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations)"
_OFFSETS = _CAPTIONS + """, off AS (SELECT conv_id, turn, text,
  (coalesce(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start_loc,
  (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS end_loc FROM cap)"""
_WHOLE = "whole AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS text FROM cap GROUP BY conv_id)"
_BAD = "CASE WHEN prob < 0.4 THEN greatest(duration, 0.1) ELSE 0 END"
_GOOD = "CASE WHEN prob >= 0.4 THEN duration ELSE 0 END"

SQL["quality_bucket_hours"] = f"""WITH {_WORDS}, b AS (SELECT round_even(prob * 10, 0) / 10 AS bucket, sum(duration) AS s FROM words GROUP BY 1)
SELECT bucket, round(s, 4) AS seconds, round(sum(s) OVER (ORDER BY bucket DESC), 4) AS cum_seconds,
  round(sum(s) OVER (ORDER BY bucket DESC) / sum(s) OVER (), 6) AS cum_share FROM b"""
SQL["entry_quality_score"] = f"WITH {_WORDS} SELECT entry, round(median(prob), 6) AS quality_score FROM words GROUP BY entry"
SQL["segment_quality_score"] = f"WITH {_SEGMENTED} SELECT entry, seg, round(median(prob), 6) AS probability FROM seg GROUP BY entry, seg"
_STATS = f"""{_SEGMENTED}, s AS (SELECT entry, seg, count(*) AS w, max("end") - min(start) AS d, median(prob) AS m FROM seg GROUP BY entry, seg),
d AS (SELECT entry, max("end") - min(start) AS duration, median(prob) AS m FROM words GROUP BY entry)"""
SQL["entry_statistics"] = f"""WITH {_STATS}
SELECT entry, count(*) AS segments_count, sum(w)::BIGINT AS words_count, round(round(avg(w), 4), 2) AS avg_words_per_segment,
  round(round(avg(s.d), 4), 2) AS avg_segment_duration,
  CASE WHEN any_value(duration) > 0 THEN round(round(sum(w) * 60 / any_value(duration), 4), 2) ELSE 0.0 END AS avg_words_per_minute
FROM s JOIN d USING (entry) GROUP BY entry"""
SQL["normalized_entries"] = f"""WITH {_STATS}
SELECT entry, count(*) AS segments_count, round(round(any_value(d.m), 4), 3) AS quality_score, round(min(round(s.m, 4)), 3) AS worst
FROM s JOIN d USING (entry) GROUP BY entry"""
SQL["source_stats"] = """SELECT source, sum(n_chars)::DOUBLE AS total, count(*) AS episodes, 2 * count(*) AS segments, sum(n_chars)::DOUBLE AS duration,
  max(n_chars) / 2 AS longest FROM documents GROUP BY source"""
SQL["subtitle_coverage"] = """WITH d AS (SELECT n_chars / 3600.0 AS h, doc_id IN (SELECT doc_id FROM labels) AS c FROM documents)
SELECT count(*) AS files, count(*) FILTER (c) AS covered_files, round(sum(h), 6) AS hours, round(sum(h) FILTER (c), 6) AS covered_hours,
  round(100 * sum(h) FILTER (c) / sum(h), 6) AS percent FROM d"""
SQL["manifest"] = f"""WITH {_WORDS}
SELECT 'events' AS source_type, NULL::VARCHAR AS source_id, entry::VARCHAR AS source_entry_id, round(median(prob), 6) AS quality_score, NULL::VARCHAR AS duration
FROM words GROUP BY entry
UNION ALL SELECT 'documents', source, doc_id::VARCHAR, NULL, NULL FROM documents"""
SQL["session_join_lang"] = """SELECT o_orderkey AS id, c_mktsegment AS lang, n_name AS "user" FROM orders LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F' AND c_mktsegment IN ('BUILDING', 'MACHINERY')"""
SQL["pending_entries"] = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
SQL["largest_per_group"] = """WITH f AS (SELECT o_custkey, o_orderkey || CASE WHEN o_orderstatus = 'F' THEN '.mp4' ELSE '.avi' END AS path, o_totalprice AS size, o_orderstatus = 'F' AS v FROM orders)
SELECT o_custkey, path, size FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY v DESC, size DESC, path) = 1"""
SQL["first_seen_session"] = "SELECT user_id, min(epoch_us(ts)) AS first_us FROM events GROUP BY user_id"
SQL["train_test_split"] = """SELECT source || '/' || doc_id AS uuid, CASE WHEN source IN ('src1', 'src2') THEN 'test' ELSE 'train' END AS split
FROM documents JOIN labels USING (doc_id) WHERE quality <> 0 AND toxic <> 1 AND source <> 'src0'"""
SQL["dedup_keep_first"] = "SELECT min(doc_id) AS doc_id, md5(coalesce(text, '')) AS digest FROM documents GROUP BY digest"
SQL["first_match_lookup"] = """SELECT o_orderkey, o_custkey, l_partkey FROM orders JOIN
(SELECT l_orderkey, min(l_linenumber::BIGINT * 100000000 + l_partkey) % 100000000 AS l_partkey FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""
SQL["complete_entries"] = "SELECT c_custkey, count(*) AS n_parts FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'O' GROUP BY 1"
SQL["sidecar_spans"] = f"""WITH {_OFFSETS}, n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS at FROM off)
SELECT c.conv_id, c.turn::INT AS segment, n.start_loc::DOUBLE AS start, n.end_loc::DOUBLE AS "end" FROM cap c LEFT JOIN n ON n.conv_id = c.conv_id AND n.at = c.turn"""
SQL["ordered_text"] = f"WITH {_CAPTIONS} SELECT conv_id, md5(string_agg(text, ' ' ORDER BY turn)) AS digest FROM cap GROUP BY conv_id"
SQL["work_batches"] = "SELECT doc_id, source, ((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 200)::BIGINT AS batch FROM documents"
SQL["playlist_leaves"] = """SELECT 'r' || n_regionkey AS root, 'c' || c_custkey AS id, c_name AS title FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'r' || n_regionkey, 'n' || n_nationkey, n_name FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer)
UNION ALL SELECT 'r' || r_regionkey, 'r' || r_regionkey, r_name FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation)"""
SQL["caption_offsets"] = f"WITH {_OFFSETS} SELECT conv_id, turn, start_loc, end_loc FROM off"
_HOURLY = _WORDS + """, h AS (SELECT entry, start, event_id, floor(start / 3600) * 3600.0 AS ts,
  5 * (row_number() OVER (PARTITION BY entry ORDER BY start, event_id) - 1) AS start_loc FROM words),
g AS (SELECT entry, ts, dense_rank() OVER (PARTITION BY entry ORDER BY ts) AS grp, min(start_loc) AS start_loc, max(start_loc) + 5 AS end_loc, count(*) AS n FROM h GROUP BY entry, ts)"""
SQL["merge_equal_ts"] = f"WITH {_HOURLY} SELECT entry, grp, ts::DOUBLE AS ts, start_loc, end_loc, n FROM g"
SQL["timed_captions"] = f"""WITH {_HOURLY}, s AS (SELECT entry, grp - 1 AS pos, ts, lead(ts) OVER (PARTITION BY entry ORDER BY ts) AS nxt, start_loc, end_loc FROM g WHERE grp > 1)
SELECT entry, pos::INT AS pos, ts::DOUBLE AS start, nxt::DOUBLE AS "end", (end_loc - start_loc - 1)::INT AS n_chars FROM s WHERE nxt IS NOT NULL
UNION ALL SELECT entry, 0, 0.0, ts::DOUBLE, (start_loc - 1)::INT FROM s WHERE pos = 1"""
_ISLANDS = _WORDS + """, r AS (SELECT entry, prob < 0.4 AS f, row_number() OVER (PARTITION BY entry ORDER BY start, event_id) - 1 AS i FROM words),
q AS (SELECT entry, i - row_number() OVER (PARTITION BY entry ORDER BY i) AS g, i FROM r WHERE f),
isl AS (SELECT entry, min(i) AS first_at, max(i) AS last_at, count(*) AS n FROM q GROUP BY entry, g)"""
SQL["silence_islands"] = f"WITH {_ISLANDS} SELECT entry, first_at::INT AS first_at, last_at::INT AS last_at, n FROM isl"
SQL["speech_complement"] = f"""WITH {_ISLANDS}, e AS (SELECT entry, first_at + 0.3 AS s, last_at + 0.7 AS e FROM isl UNION ALL SELECT entry, count(*), count(*) FROM words GROUP BY entry),
c AS (SELECT entry, coalesce(lag(e) OVER (PARTITION BY entry ORDER BY s, e), 0) AS a, s AS b FROM e)
SELECT entry, round(a::DOUBLE, 3) AS start, round(b::DOUBLE, 3) AS "end" FROM c WHERE a < b"""
SQL["interval_union"] = f"""WITH {_WORDS}, r AS (SELECT entry, start, start + duration * 3600 AS e FROM words),
m AS (SELECT *, max(e) OVER (PARTITION BY entry ORDER BY start, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r),
g AS (SELECT *, sum(CASE WHEN start <= before THEN 0 ELSE 1 END) OVER (PARTITION BY entry ORDER BY start, e ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT entry, round(min(start), 6) AS start, round(max(e), 6) AS "end", count(*) AS n FROM g GROUP BY entry, g"""
SQL["nearest_asof"] = f"""WITH {_WORDS}, c AS (SELECT * FROM words WHERE event_type = 'click'), p AS (SELECT * FROM words WHERE event_type = 'purchase'),
j AS (SELECT c.entry, c.event_id, p.event_id AS other_id, abs(p.start - c.start) AS gap, row_number() OVER (PARTITION BY c.event_id ORDER BY abs(p.start - c.start), p.start) AS k
  FROM c LEFT JOIN p ON p.entry = c.entry)
SELECT entry, event_id, other_id, round(gap, 6) AS gap FROM j WHERE k = 1"""
SQL["interval_containment"] = f"""WITH {_OFFSETS}, n AS (SELECT *, turn * 10.0 AS ts, coalesce(lead(turn * 10.0) OVER (PARTITION BY conv_id ORDER BY turn), turn * 10.0) AS nxt FROM off),
p AS (SELECT DISTINCT conv_id, floor(m * q)::BIGINT AS spot FROM (SELECT conv_id, max(end_loc) AS m FROM off GROUP BY conv_id), (VALUES (0.25), (0.5), (0.75)) v(q)),
j AS (SELECT p.conv_id, spot, turn, start_loc, end_loc, ts, nxt, row_number() OVER (PARTITION BY p.conv_id, spot ORDER BY start_loc, end_loc, turn) AS k
  FROM p JOIN n ON n.conv_id = p.conv_id AND spot BETWEEN start_loc AND end_loc)
SELECT conv_id, spot AS "at", turn, round((ts + CASE WHEN end_loc > start_loc THEN (spot - start_loc) / (end_loc - start_loc) ELSE 0 END * (nxt - ts))::DOUBLE, 4) AS time FROM j WHERE k = 1"""
SQL["interval_overlap"] = f"""WITH {_WORDS}, r AS (SELECT entry, event_id, event_type, start, start + duration * 600 AS e FROM words)
SELECT a.entry, a.event_id, b.event_id AS other_event_id FROM r a JOIN r b ON a.entry = b.entry AND a.start < b.e AND a.e > b.start
WHERE a.event_type = 'click' AND b.event_type = 'purchase'"""
SQL["confusion_zone"] = f"""WITH {_WORDS}, e AS (SELECT entry, min(start) AS s, max("end") AS f FROM words GROUP BY entry),
k AS (SELECT entry, s, f, unnest(generate_series(0, ceil((f - 172800 - s) / 43200)::INT - 1)) AS k FROM e WHERE s + 172800 < f),
j AS (SELECT k.entry, k.k, k.s + k.k * 43200 AS a, sum({_BAD}) AS b, sum({_GOOD}) AS g FROM k LEFT JOIN words w ON w.entry = k.entry AND w.start < k.s + k.k * 43200 + 172800 AND w."end" > k.s + k.k * 43200 GROUP BY 1, 2, 3),
r AS (SELECT entry, k, a, CASE WHEN coalesce(g, 0) = 0 THEN 'inf'::DOUBLE ELSE b / g END AS ratio FROM j)
SELECT entry, round(a, 3) AS zone_start, round(a + 172800, 3) AS zone_end, round(ratio, 6) AS ratio FROM r WHERE ratio > 0.05 QUALIFY row_number() OVER (PARTITION BY entry ORDER BY k) = 1"""
SQL["trailing_word_window"] = f"""WITH {_WORDS}, w AS (SELECT entry, event_id, sum({_BAD}) OVER x AS b, sum({_GOOD}) OVER x AS g, sum(greatest(duration, 0.1)) OVER x AS t, avg(prob) OVER x AS p
  FROM words WINDOW x AS (PARTITION BY entry ORDER BY "end" RANGE BETWEEN 172800 PRECEDING AND CURRENT ROW)),
r AS (SELECT entry, event_id, CASE WHEN t >= 5 THEN CASE WHEN g = 0 THEN 'inf'::DOUBLE ELSE b / g END END AS ratio, CASE WHEN t >= 5 THEN p END AS p FROM w)
SELECT entry, event_id, round(ratio, 6) AS ratio, round(p, 6) AS mean_prob, coalesce(ratio > 0.05, FALSE) AS broken FROM r"""
SQL["probable_segment_before"] = f"""WITH {_WORDS}, t AS (SELECT entry, max(start) AS t FROM words GROUP BY entry),
h AS (SELECT w.entry, floor((t - start) / 21600)::BIGINT AS hop, start, prob FROM words w JOIN t ON t.entry = w.entry WHERE prob >= 0.8 AND start < t)
SELECT entry, hop, round(start, 3) AS start, round(prob, 6) AS prob FROM h WHERE hop < 6 QUALIFY row_number() OVER (PARTITION BY entry ORDER BY hop, start) = 1"""
SQL["zero_length_words"] = f"""WITH {_WORDS}, z AS (SELECT entry, avg((CASE WHEN prob < 0.2 THEN 0 ELSE "end" - start END = 0)::INT) AS s FROM words GROUP BY entry)
SELECT entry, round(s, 6) AS zero_share, s > 0.2 AS failed FROM z"""
SQL["quantised_mode"] = f"""WITH {_WORDS}, v AS (SELECT entry, round_even(prob, 1) AS v, count(*) AS n FROM words GROUP BY 1, 2)
SELECT entry, v AS mode FROM v QUALIFY row_number() OVER (PARTITION BY entry ORDER BY n DESC, v) = 1"""
_T = ", ".join(f"({k}, {v})" for k, v in {4: 2.776445, 5: 2.570582, 6: 2.446912, 7: 2.364624, 8: 2.306004, 9: 2.262157, 10: 2.228139, 11: 2.200985, 12: 2.178813, 13: 2.160369, 14: 2.144787, 15: 2.131450, 16: 2.119905, 17: 2.109816, 18: 2.100922, 19: 2.093024, 20: 2.085963, 21: 2.079614, 22: 2.073873, 23: 2.068658, 24: 2.063899, 25: 2.059539, 26: 2.055529, 27: 2.051831, 28: 2.048407, 29: 2.045230, 30: 2.042272, 31: 2.039513, 32: 2.036933, 33: 2.034515, 34: 2.032245}.items())
SQL["lag_ci"] = f"""WITH {_WORDS}, f AS (SELECT entry, duration FROM words QUALIFY row_number() OVER (PARTITION BY entry ORDER BY event_id) <= 35),
s AS (SELECT entry, count(*) AS n, avg(duration) AS m, stddev_samp(duration) / sqrt(count(*)) AS se FROM f GROUP BY entry),
j AS (SELECT s.*, m - t * se AS low, m + t * se AS high FROM s LEFT JOIN (VALUES {_T}) q(df, t) ON df = n - 1)
SELECT entry, n, round(m, 5) AS mean, round(low, 5) AS low, round(high, 5) AS high, n >= 5 AND (high - low <= 8 OR n >= 35) AS confident FROM j"""
SQL["ema_word_duration"] = f"""WITH {_WORDS}, l AS (SELECT entry, list_prepend(0.42::DOUBLE, list(duration ORDER BY start, event_id)) AS d FROM words GROUP BY entry)
SELECT entry, round(list_reduce(d, lambda a, x: 0.98::DOUBLE * a + 0.02::DOUBLE * x), 8) AS ema FROM l"""
SQL["greedy_packing"] = f"""WITH RECURSIVE {_OFFSETS}, c AS (SELECT conv_id, turn, start_loc / 20.0 AS s, end_loc / 20.0 AS e, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM off),
r AS (SELECT conv_id, i, n, 0 AS grp, s AS gs, turn, s, e FROM c WHERE i = 1 AND n >= 3
  UNION ALL SELECT c.conv_id, c.i, c.n, CASE WHEN c.e - r.gs < 29.9 THEN r.grp ELSE r.grp + 1 END, CASE WHEN c.e - r.gs < 29.9 THEN r.gs ELSE c.s END, c.turn, c.s, c.e
  FROM r JOIN c ON c.conv_id = r.conv_id AND c.i = r.i + 1 AND c.i < c.n)
SELECT conv_id, grp::BIGINT AS grp, arg_min(turn, i) AS first_pos, arg_max(turn, i) AS last_pos, arg_min(s, i)::DOUBLE AS start, arg_max(e, i)::DOUBLE AS "end" FROM r GROUP BY conv_id, grp"""
SQL["char_rarity_weights"] = """WITH c AS (SELECT lang, unnest(string_split(regexp_replace(coalesce(text, ''), '[\\s,.?]+', ' ', 'g'), '')) AS char FROM documents),
n AS (SELECT lang, char, count(*) AS n FROM c WHERE char <> '' GROUP BY 1, 2),
w AS (SELECT *, exp(1 - CASE WHEN max(ln(n)) OVER p > min(ln(n)) OVER p THEN (ln(n) - min(ln(n)) OVER p) / (max(ln(n)) OVER p - min(ln(n)) OVER p) ELSE 0 END) AS r FROM n WINDOW p AS (PARTITION BY lang))
SELECT lang, char, n, round(r / sum(r) OVER (PARTITION BY lang), 8) AS weight FROM w"""
_LIKE = """d AS (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS text, arg_max(text, turn) AS q FROM cap GROUP BY conv_id),
ch AS (SELECT conv_id, unnest(string_split(regexp_replace(text, '[\\s,.?]+', ' ', 'g'), '')) AS ch FROM d),
cn AS (SELECT conv_id, ch, ln(count(*)) AS n FROM ch WHERE ch <> '' GROUP BY 1, 2),
cr AS (SELECT conv_id, ch, exp(1 - CASE WHEN max(n) OVER p > min(n) OVER p THEN (n - min(n) OVER p) / (max(n) OVER p - min(n) OVER p) ELSE 0 END) AS r FROM cn WINDOW p AS (PARTITION BY conv_id)),
cw AS (SELECT conv_id, ch, r / sum(r) OVER (PARTITION BY conv_id) AS w FROM cr)"""


def _scored(name: str, windows: str) -> str:
    """Cosines of the weighted characters of windows (conv_id, spot, p, q)."""
    return f"""{name}_h AS (SELECT conv_id, spot, w * (length(p) - length(replace(p, ch, ''))) AS a, w * (length(q) - length(replace(q, ch, ''))) AS b FROM {windows} JOIN cw USING (conv_id)),
{name} AS (SELECT conv_id, spot, round(sum(a * b) / sqrt(sum(a * a)) / sqrt(sum(b * b)), 12) AS s FROM {name}_h GROUP BY 1, 2 HAVING sum(a) > 0 AND sum(b) > 0)"""


SQL["window_hist_search"] = f"""WITH {_CAPTIONS}, {_LIKE}, k AS (SELECT conv_id, text, q, unnest(generate_series(0, length(text) - length(q), 50)) AS spot FROM d WHERE length(q) > 0),
v AS (SELECT conv_id, spot, substr(text, spot + 1, length(q)) AS p, q FROM k), {_scored("c", "v")}
SELECT conv_id AS doc_id, conv_id AS query, spot::INT AS "at", round(s, 6) AS similarity FROM c QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY s DESC, spot) <= 3"""
SQL["window_fine_search"] = f"""WITH {_CAPTIONS}, {_LIKE}, d1 AS (SELECT conv_id, text, substr(q, 1, 150) AS q FROM d WHERE length(q) > 0),
k AS (SELECT conv_id, text, q, unnest(generate_series(0, length(text) - length(q), 50)) AS spot FROM d1), v AS (SELECT conv_id, spot, substr(text, spot + 1, length(q)) AS p, q FROM k), {_scored("c", "v")},
h AS (SELECT conv_id, spot FROM c QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY s DESC, spot) <= 5),
g AS (SELECT conv_id, greatest(0, spot - 300) AS a, least(length(text), spot + 450) AS b FROM h JOIN d USING (conv_id)),
i AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY conv_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM g),
u AS (SELECT *, sum(f) OVER (PARTITION BY conv_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS u FROM i), m AS (SELECT conv_id, min(a) AS a, max(b) AS b FROM u GROUP BY conv_id, u),
k2 AS (SELECT DISTINCT conv_id, substr(q, 1, 250) AS q, text, unnest(generate_series(a, b - length(substr(q, 1, 250)), 5)) AS spot FROM m JOIN d USING (conv_id)),
v2 AS (SELECT conv_id, spot, substr(text, spot + 1, length(q)) AS p, q FROM k2), {_scored("e", "v2")}
SELECT conv_id AS doc_id, conv_id AS query, spot::INT AS "at", round(s, 6) AS similarity FROM e QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY s DESC, spot) = 1"""
_NEAR = "list_filter(v, lambda x: abs(x - c0) <= abs(x - c1))"
_FAR = "list_filter(v, lambda x: abs(x - c0) > abs(x - c1))"
SQL["kmeans_2"] = f"""WITH RECURSIVE {_WORDS}, l AS (SELECT entry, list(prob) AS v FROM words GROUP BY entry),
r AS (SELECT entry, v, 0::DOUBLE AS c0, 1::DOUBLE AS c1, 1 AS i FROM l
  UNION ALL SELECT entry, v, a, b, i + 1 FROM (SELECT *, coalesce(list_avg({_NEAR}), c0) AS a, coalesce(list_avg({_FAR}), c1) AS b FROM r)
  WHERE i < 20 AND NOT (abs(a - c0) <= 1e-8 + 1e-5 * abs(c0) AND abs(b - c1) <= 1e-8 + 1e-5 * abs(c1))),
f AS (SELECT entry, arg_max(c0, i) AS c0, arg_max(c1, i) AS c1 FROM r GROUP BY entry)
SELECT entry, event_id, CASE WHEN abs(prob - c0) <= abs(prob - c1) THEN 0 ELSE 1 END::BIGINT AS cls FROM words JOIN f USING (entry)"""
SQL["segment_confidence"] = f"WITH {_SEGMENTED} SELECT entry, seg, round(avg(prob), 8) AS confidence FROM seg GROUP BY entry, seg"
SQL["first_break"] = f"""WITH {_WORDS}, w AS (SELECT entry, "end" AS e, sum({_BAD}) OVER x AS b, sum({_GOOD}) OVER x AS g, sum(greatest(duration, 0.1)) OVER x AS t, lead("end") OVER (PARTITION BY entry ORDER BY "end") - "end" AS gap
  FROM words WINDOW x AS (PARTITION BY entry ORDER BY "end" RANGE BETWEEN 172800 PRECEDING AND CURRENT ROW)),
r AS (SELECT entry, e, gap, t >= 5 AND (g = 0 OR b / g > 0.05) AS broken FROM w),
f AS (SELECT entry, CASE WHEN broken THEN e WHEN gap > 43200 THEN e + 43200 END AS spot, CASE WHEN broken THEN 'ratio' ELSE 'silence' END AS reason FROM r)
SELECT entry, round(spot, 3) AS "at", reason FROM f WHERE spot IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entry ORDER BY spot, reason) = 1"""
SQL["lag_stopping"] = f"""WITH {_WORDS}, e AS (SELECT entry, row_number() OVER (PARTITION BY entry ORDER BY event_id) - 1 AS draw, CASE WHEN event_id % 10 <> 0 THEN duration * 4 END AS lag FROM words),
p AS (SELECT entry, draw, lag, CASE WHEN lag BETWEEN 2 AND 18 THEN lag END AS i FROM e),
a AS (SELECT entry, draw, count(i) OVER u AS n, count(lag) OVER u AS n_all, avg(i) OVER u AS m, stddev_samp(i) OVER u AS sd FROM p WINDOW u AS (PARTITION BY entry ORDER BY draw ROWS UNBOUNDED PRECEDING)),
j AS (SELECT a.*, m - t * sd / sqrt(n) AS low, m + t * sd / sqrt(n) AS high FROM a LEFT JOIN (VALUES {_T}) q(df, t) ON df = n - 1),
s AS (SELECT *, coalesce(n >= 5 AND high - low <= 8, FALSE) OR n_all >= 35 AS stopped FROM j),
k AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY CASE WHEN stopped THEN draw ELSE 1e9 - draw END) AS k FROM s)
SELECT entry, draw + 1 AS draws, n, round(coalesce(m, 10), 5) AS lag, round(low, 5) AS low, round(high, 5) AS high, stopped FROM k WHERE k = 1"""


def _slice_silences(source: str) -> str:
    """Rows of source (entry, total, r, spot: where a slice begins) with fin, its end, and found: its silences, shrunk; r: the quiet runs of the whole entry, in frames."""
    return f"""SELECT entry, total, r, spot, fin, CASE WHEN fb - fa - zeros > zeros THEN list_transform(list_filter(list_transform(c,
    lambda q: {{'s': spot + (q.a - fa) * 0.02::DOUBLE, 't': spot + (CASE WHEN q.b = fb THEN q.b - fa ELSE q.b - fa - 1 END) * 0.02::DOUBLE}}), lambda q: q.t - q.s > 1::DOUBLE AND q.s + 0.3::DOUBLE < q.t - 0.3::DOUBLE),
    lambda q: {{'s': q.s + 0.3::DOUBLE, 't': q.t - 0.3::DOUBLE}}) END AS found
  FROM (SELECT *, coalesce(list_sum(list_transform(c, lambda q: q.b - q.a)), 0) AS zeros FROM (SELECT *, list_filter(list_transform(r, lambda q: {{'a': greatest(q.a, fa), 'b': least(q.b, fb)}}), lambda q: q.a < q.b) AS c
    FROM (SELECT *, round(spot / 0.02::DOUBLE)::BIGINT AS fa, round(fin / 0.02::DOUBLE)::BIGINT AS fb FROM (SELECT *, least(spot + 20::DOUBLE, total) AS fin FROM {source}))))"""


SQL["speech_ranges"] = f"""WITH RECURSIVE {_WORDS}, e AS (SELECT entry, prob < 0.4 AS z, row_number() OVER (PARTITION BY entry ORDER BY event_id) - 1 AS i FROM words),
u AS (SELECT entry, i, i - row_number() OVER (PARTITION BY entry ORDER BY i) AS g FROM e WHERE z), v AS (SELECT entry, min(i) * 100 AS a, (max(i) + 1) * 100 AS b FROM u GROUP BY entry, g),
l AS (SELECT n.entry, n.total, coalesce(q.r, []) AS r FROM (SELECT entry, (count(*) * 100)::DOUBLE * 0.02::DOUBLE AS total FROM e GROUP BY entry) n LEFT JOIN (SELECT entry, list({{'a': a, 'b': b}} ORDER BY a) AS r FROM v GROUP BY entry) q USING (entry)),
s AS (SELECT entry, total, r, 0::DOUBLE AS spot FROM l
  UNION ALL SELECT entry, total, r, CASE WHEN following > spot THEN following ELSE fin END FROM (SELECT *, CASE WHEN fin < total AND found[-1].s > fin - 5 THEN greatest(found[-1].s - 0.3::DOUBLE, spot + 5) ELSE fin END AS following FROM ({_slice_silences("s")}))
  WHERE CASE WHEN following > spot THEN following ELSE fin END < total - 1e-9),
k AS (SELECT entry, total, unnest(CASE WHEN fin < total AND found[-1].s > fin - 5 THEN found[:-2] ELSE found END) AS f FROM ({_slice_silences("s")})),
p AS (SELECT entry, f.s AS a, f.t AS b FROM k UNION ALL SELECT entry, total, total FROM l),
o AS (SELECT entry, coalesce(max(b) OVER (PARTITION BY entry ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, a FROM p)
SELECT entry, round(lo, 4) AS start, round(a, 4) AS "end" FROM o WHERE lo < a"""


def _spoken(text: str) -> str:
    """A text without bracketed parts, dashes and semicolons as commas or spaces, and single spaces."""
    out = f"regexp_replace(regexp_replace(regexp_replace({text}, '\\[.*?\\]', '', 'g'), '([\\p{{L}}\\p{{N}}_])\\s[–—]', '\\1,', 'g'), '([\\p{{L}}\\p{{N}}_]);', '\\1,', 'g')"
    return f"regexp_replace(translate({out}, '–—', '  '), '\\s+', ' ', 'g')"


SQL["timed_segments"] = f"""WITH RECURSIVE {_OFFSETS}, {_WHOLE}, o AS (SELECT conv_id, start_loc AS a, end_loc AS b, turn * 7.0::DOUBLE AS t, row_number() OVER w AS i, coalesce(lead(turn * 7.0::DOUBLE) OVER w, turn * 7.0::DOUBLE) AS nt,
  lead(start_loc) OVER w AS na, lead(end_loc) OVER w AS nb FROM off WINDOW w AS (PARTITION BY conv_id ORDER BY turn * 7.0, start_loc)),
r AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, NULL::BIGINT AS lo, NULL::DOUBLE AS pace, FALSE AS made, 0::DOUBLE AS start, 0::DOUBLE AS stop, '' AS said FROM o
  UNION ALL SELECT conv_id, i, CASE WHEN merge THEN st END, CASE WHEN NOT merge AND lasts <= 10 AND n > 0 THEN 0.98::DOUBLE * coalesce(pace, 0.42::DOUBLE) + 0.02::DOUBLE * lasts / n ELSE pace END, NOT merge, t,
    t + CASE WHEN lasts > 10 AND lasts > 3 * expected THEN expected ELSE lasts END, said
  FROM (SELECT *, nt - t AS lasts, nt = t OR (regexp_matches(said, '[\\p{{L}}\\p{{N}}_]$') AND regexp_matches(ahead, '^[\\p{{L}}\\p{{N}}_]')) OR (expected < 15 AND NOT regexp_matches(trim(right(said, 10)), '[,.!?:]$') AND nt - (t + expected) <= 2) AS merge
    FROM (SELECT *, n * coalesce(pace, 0.42::DOUBLE) AS expected FROM (SELECT *, CASE WHEN trim(said) = '' THEN 0 ELSE length(trim(said)) - length(replace(trim(said), ' ', '')) + 1 END AS n
      FROM (SELECT o.*, r.pace, coalesce(r.lo, o.a) AS st, {_spoken("substr(w.text, (coalesce(r.lo, o.a) + 1)::BIGINT, (o.b - coalesce(r.lo, o.a))::BIGINT)")} AS said, coalesce({_spoken("substr(w.text, (o.na + 1)::BIGINT, (o.nb - o.na)::BIGINT)")}, '') AS ahead
        FROM r JOIN o ON o.conv_id = r.conv_id AND o.i = r.i + 1 JOIN whole w ON w.conv_id = o.conv_id)))))
SELECT conv_id, round(start, 4) AS start, round(stop, 4) AS "end", said AS text FROM r WHERE made"""
_BEFORE = "coalesce(list_sum(list_transform(list_filter(range(lo, hi), lambda q: q <> k AND s[q + 1] > 0 AND (s[q + 1] > s[j + 1] OR (s[q + 1] = s[j + 1] AND q < j))), lambda q: s[q + 1])), 0)"
SQL["time_index_repair_a"] = f"""WITH RECURSIVE {_WORDS}, p AS (SELECT entry, row_number() OVER (PARTITION BY entry ORDER BY event_id) - 1 AS idx,
  greatest(floor((start - 1704067200) / 60) + event_id % 97 - 48, 0)::BIGINT AS sec FROM words),
l AS (SELECT entry, list(sec ORDER BY idx) AS x, min(sec) FILTER (sec > 0) AS m FROM p GROUP BY entry),
r AS (SELECT entry, list_transform(range(1, len(x)), lambda i: x[i + 1] - CASE WHEN i = 1 THEN m ELSE x[i] END) AS s, FALSE AS done, 0 AS it FROM l WHERE m IS NOT NULL
  UNION ALL SELECT entry, list_transform(range(0, len(s)), lambda j: CASE WHEN j = k THEN 0 WHEN reach IS NULL OR j < lo OR j >= hi OR s[j + 1] <= 0 THEN s[j + 1] ELSE s[j + 1] - greatest(0, least(s[j + 1], -v - {_BEFORE})) END), reach IS NULL, it + 1
  FROM (SELECT *, greatest(k - reach, 0) AS lo, least(last, k + reach + 1) AS hi FROM (SELECT *, list_filter(range(1, greatest(k, last - 1 - k, 1) + 1), lambda q: coalesce(list_sum(s[greatest(k - q, 0) + 1 : least(last, k + q + 1)]), 0) >= 0)[1] AS reach
    FROM (SELECT *, list_position(s, v) - 1 AS k, len(s) - 1 AS last FROM (SELECT *, list_min(s) AS v FROM r WHERE NOT done) WHERE v < 0)))),
f AS (SELECT entry, arg_max(s, it) AS s FROM r GROUP BY entry)
SELECT p.entry, p.idx::BIGINT AS idx, CASE WHEN l.m IS NULL THEN p.sec ELSE l.m + coalesce(list_sum(f.s[1 : p.idx]), 0) END::DOUBLE AS sec FROM p JOIN l USING (entry) LEFT JOIN f USING (entry)"""
SQL["time_index_repair_b"] = f"""WITH RECURSIVE {_WORDS}, p AS (SELECT entry, row_number() OVER (PARTITION BY entry ORDER BY event_id) - 1 AS idx,
  greatest(floor((start - 1704067200) / 60) + event_id % 97 - 48, 0)::DOUBLE AS sec FROM words),
l AS (SELECT entry, list(sec ORDER BY idx) AS x, count(*) AS n, arg_min(idx, sec + idx / 1e9) FILTER (sec > 0) AS f FROM p GROUP BY entry),
m AS (SELECT entry, idx, sec, f, n, greatest(1, f) AS s, list_filter([x[idx + 3], x[idx + 5], x[idx + 7], x[idx + 9]], lambda v: v IS NOT NULL) AS ahead FROM p JOIN l USING (entry)),
r AS (SELECT entry, idx, sec AS cur, ahead FROM m WHERE idx = s AND f IS NOT NULL
  UNION ALL SELECT m.entry, m.idx, CASE WHEN r.cur > m.sec THEN r.cur WHEN m.sec - r.cur > 30 AND NOT abs(m.sec - coalesce(list_median(r.ahead), r.cur + 30)) < abs(r.cur - coalesce(list_median(r.ahead), r.cur + 30)) THEN r.cur + 30 ELSE m.sec END, m.ahead
  FROM r JOIN m ON m.entry = r.entry AND m.idx = r.idx + 1)
SELECT m.entry, m.idx::BIGINT AS idx, CASE WHEN m.f IS NULL THEN m.sec WHEN m.idx < m.s THEN 0 ELSE r.cur END AS sec FROM m LEFT JOIN r ON r.entry = m.entry AND r.idx = m.idx"""
SQL["locate_prefix"] = f"""WITH {_OFFSETS}, {_WHOLE}, w AS (SELECT o.conv_id, o.turn, o.start_loc, o.text, w.text AS whole FROM off o JOIN whole w USING (conv_id) WHERE length(o.text) > 0),
p AS (SELECT conv_id, turn, substr(text, 1, 90) AS q, whole, unnest([270, 405, 608]) AS r, start_loc FROM w),
f AS (SELECT conv_id, turn, r, greatest(start_loc - r, 0) AS lo, instr(substr(whole, greatest(start_loc - r, 0) + 1, 2 * r + length(q)), q) AS spot FROM p)
SELECT conv_id, turn, (arg_min(lo + spot - 1, r) FILTER (spot > 0))::INT AS "at" FROM f GROUP BY conv_id, turn"""
SQL["cosine_topk"] = """WITH s AS (SELECT q.vec_id AS query, e.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS s FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0)
SELECT query, vec_id, (row_number() OVER (PARTITION BY query ORDER BY round(s, 9) DESC, vec_id))::INT AS rank, round(s, 5) AS similarity FROM s QUALIFY rank <= 5"""
SQL["text_normalize"] = r"""WITH d AS (SELECT doc_id, replace(replace(coalesce(text, ''), ', ', '; '), '. ', ' – ') AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(t, '\[.*?\]', '', 'g') AS t FROM d),
b AS (SELECT doc_id, regexp_replace(t, '([\p{L}\p{N}_])\s[–—]', '\1,', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, '([\p{L}\p{N}_]);', '\1,', 'g') AS t FROM b)
SELECT doc_id, md5(regexp_replace(translate(t, '–—', '  '), '[\s]+', ' ', 'g')) AS digest FROM c"""
SQL["bracket_unwrap"] = r"""WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '([a-z]+), ', '( \1 ) ', 'g') AS t FROM documents),
a AS (SELECT doc_id, regexp_replace(t, '([^\p{L}\p{N}_]*)[\(\[\{<](.*?)[\)\]\}>]([^\p{L}\p{N}_]*)', '\1' || chr(1) || '\2' || chr(2) || '\3', 'g') AS t FROM d),
b AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(^|[\p{L}\p{N}_])' || chr(1) || '\s*', '\1 ', 'g'), chr(1) || '\s*', '', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_replace(t, '\s*' || chr(2) || '($|[\p{L}\p{N}_])', ' \1', 'g'), '\s*' || chr(2), '', 'g') AS t FROM b)
SELECT doc_id, md5(t) AS digest FROM c"""
SQL["word_counts"] = r"SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda x: x <> ''))::INT AS n_words FROM documents"
SQL["sentence_marks"] = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, len(regexp_extract_all(t, '[\s.,;!?()\[\]{}]')) + 1 - regexp_matches(t, '^[\s.,;!?()\[\]{}]')::INT AS n FROM d)
SELECT doc_id, n::INT AS n_points, regexp_matches(rtrim(right(t, 10), ' '), '[,.!?:]$') AS ends_sentence, regexp_matches(t, '^[\p{L}\p{N}_]') AS word_first, regexp_matches(t, '[\p{L}\p{N}_]$') AS word_last FROM m"""
SQL["filename_sanitize"] = r"""SELECT page_id, translate(regexp_replace(coalesce(url, ''), '[\\/*?:"<>|]', '', 'g'), '–—', '--') AS name FROM pages"""
SQL["url_parts"] = r"""SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, coalesce(regexp_matches(url, '^[a-z]+://([^/]*[.])?example[.]com([/?#]|$)'), FALSE) AS at_example FROM pages"""
SQL["html_tagged"] = r"""WITH p AS (SELECT page_id, regexp_extract_all(coalesce(html, ''), '(?s)<li>(.*?)</li>', 1) AS l FROM pages)
SELECT page_id, len(l)::INT AS n_items, md5(array_to_string(l, '|')) AS digest FROM p"""
SQL["clock_texts"] = f"""WITH {_WORDS}, d AS (SELECT event_id, duration, start - floor(start / 86400) * 86400 AS s, round((start - floor(start / 86400) * 86400) * 1000)::BIGINT AS ms FROM words)
SELECT event_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS clock,
  printf('%02d:%02d:%02d.000', floor(s)::BIGINT // 3600, floor(s)::BIGINT // 60 % 60, floor(s)::BIGINT % 60) AS whole, round(ms / 1000, 3) AS seconds, trunc(duration / 0.02)::BIGINT AS frame FROM d"""
SQL["feed_dates"] = "SELECT event_id, strftime(ts, '%Y.%m.%d') AS day FROM events"
SQL["vtt_round_trip"] = f"""WITH {_CAPTIONS} SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS id, turn * 10.0::DOUBLE AS start, turn * 10.0::DOUBLE + 9.5::DOUBLE AS "end" FROM cap WHERE trim(text) <> ''"""
SQL["hourly_counts"] = "SELECT (epoch_us(ts) // 3600000000) * 3600 AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"
SQL["sliding_counts"] = """SELECT user_id, w * 1800 AS window_start, count(*) AS n FROM (SELECT user_id, unnest(generate_series(epoch_us(ts) // 1800000000 - 3, epoch_us(ts) // 1800000000)) AS w FROM events) GROUP BY ALL"""
SQL["session_counts"] = """WITH g AS (SELECT user_id, epoch_us(ts) AS t, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 1800000000 THEN 0 ELSE 1 END AS n FROM events),
s AS (SELECT user_id, t, sum(n) OVER (PARTITION BY user_id ORDER BY t) AS s FROM g)
SELECT user_id, min(t) AS session_start, count(*) AS n FROM s GROUP BY user_id, s"""

SQL["monotone_times"] = f"""WITH {_WORDS}, r AS (SELECT entry, event_id, floor((start / 60) % 1440) AS t FROM words),
m AS (SELECT *, max(t) OVER (PARTITION BY entry ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM r),
f AS (SELECT entry, arg_min(t, event_id) FILTER (t > 0) AS first FROM r GROUP BY entry),
l AS (SELECT m.*, first, t = 0 AND coalesce(mx = 0, TRUE) AS lead_in FROM m JOIN f USING (entry))
SELECT entry, event_id, CASE WHEN lead_in THEN greatest(first - 3, 0) ELSE t END::DOUBLE AS ts FROM l WHERE (lead_in AND mx IS NULL) OR coalesce(t > mx, t > 0)"""
SQL["slice_text"] = rf"""WITH {_OFFSETS}, {_WHOLE}, x AS (SELECT conv_id, turn * 10.0 AS ts, start_loc, end_loc FROM off),
g AS (SELECT conv_id, max(ts) / 4 AS s, max(ts) / 2 AS e FROM x GROUP BY conv_id),
n AS (SELECT x.conv_id, arg_min(struct_pack(a := start_loc, b := end_loc), [abs(ts - (s - 1)), ts, start_loc, end_loc]) AS p, arg_min(struct_pack(a := start_loc, b := end_loc), [abs(ts - (e + 1)), ts, start_loc, end_loc]) AS q
  FROM x JOIN g USING (conv_id) GROUP BY x.conv_id),
b AS (SELECT n.conv_id, text, least(p.a, q.a) AS lo, greatest(p.b, q.b) AS hi, list_filter(generate_series(0, length(text) - 1), lambda i: regexp_matches(substr(text, i + 1, 1), '[\s.,;!?()\[\]{{}}]')) AS cuts FROM n JOIN whole USING (conv_id) WHERE length(text) > 0),
c AS (SELECT conv_id, text, coalesce(list_max(list_filter(list_prepend(0, cuts), lambda i: i < lo)), 0) AS lo, coalesce(list_min(list_filter(cuts, lambda i: i > hi)), length(text)) AS hi FROM b)
SELECT conv_id, md5(substr(text, lo + 1, hi - lo)) AS digest FROM c"""
