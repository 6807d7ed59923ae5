"""Operators on hand-built rows with literal results, and sequential ones against their definitions."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cantilena.functions import text as T
from cantilena.operators import matching as M
from cantilena.operators import quality as Q
from cantilena.operators import relational as R
from cantilena.operators import sequential as S
from cantilena.operators import timeline as L
from cantilena.plans import corpus


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "f, text, want",
    [
        (T.remove_bracketed, "a (b) c [d] e", "a c e"),
        (T.unwrap_brackets, "say (this) now", "say this now"),
        (T.unwrap_brackets, "say(this)now", "say this now"),
        (T.remove_niqqud, "שָׁלוֹם", "שלום"),
        (T.remove_controls, "a‏b‪c", "abc"),
        (T.clean_for_alignment, "א: (ב) ג", "א ב ג"),
        (T.normalize_for_audio, "מילה – מילה; [x] סוף—ו", "מילה, מילה, סוף ו"),
        (T.unwrap_brackets, "(x) y", " x y"),
        (T.unwrap_brackets, "a ( b )", "a b "),
        (T.unwrap_brackets, "a, <b>. c", "a, b. c"),
        (T.is_youtube, "https://www.youtube.com/watch", True),
        (T.is_soundcloud, "https://x.soundcloud.com/a", False),
        (T.squeeze, "a  \n b", "a b"),
        (T.squeeze_marks, "a, b. c?", "a b c "),
        (T.squeeze_inline, "a  b\n\tc", "a b\n c"),
        (T.word_count, "  one two three ", 3),
        (T.split_points, "a b,c", [0, 1, 3]),
        (T.ends_sentence, "well, this ends.  ", True),
        (T.starts_with_word, "שלום", True),
        (T.ends_with_word, "end.", False),
        (T.clock_seconds, "01:02:03.500", 3723.5),
        (T.frame_clock_seconds, "01:00:00:05", 3600.2),
        (T.feed_date, "Tue, 02 Jan 2024 10:00:00 GMT", "2024.01.02"),
        (T.feed_date, "Tue, 2 Jan 2024 23:30:00 -0200", "2024.01.03"),
        (T.feed_date, "rubbish", None),
        (T.file_date, "2023_05_06_session", "2023-05-06"),
        (T.file_date, "session", None),
        (lambda c: T.number_after(c, "_ETM_Q1_"), "_ETM_Q1_1500", 1500),
        (lambda c: T.query_param(c, "TopicID"), "https://x.org/a?b=1&TopicID=7", "7"),
        (T.safe_file_name, 'a/b: "c" – d?', "ab c - d"),
        (lambda c: F.octet_length(T.safe_file_name(c)), "א" * 300, 240),
        (lambda c: T.is_host(c, "youtube.com"), "https://www.youtube.com/watch", True),
        (lambda c: T.is_host(c, "youtube.com"), "https://notyoutube.com/watch", False),
        (lambda c: T.audio_extension(c, F.lit("opus")), "mov", "m4a"),
        (lambda c: T.audio_extension(c, F.lit("opus")), "ogg", "opus"),
        (lambda c: T.audio_extension(c, F.lit("x")), None, "mp3"),
    ],
)
def test_text(spark, f, text, want):
    assert one(spark, f, text) == want


def test_clocks(spark):
    assert one(spark, T.seconds_clock, 3723.4999, "double") == "01:02:03.500"
    assert one(spark, T.seconds_clock_whole, 90000.9, "double") == "01:00:00.000"
    assert one(spark, T.clip_list, [(0.5, 1.257), (2.0, 3.0)], "array<struct<start:double,end:double>>") == "0.50,1.26,2.00,3.00"
    assert one(spark, T.clip_list, [], "array<struct<start:double,end:double>>") == "0"
    assert one(spark, T.seconds_to_frame, 1.039, "double") == 51
    with pytest.raises(Exception, match="unknown media type"):
        one(spark, T.extension_of, "text/plain")


def test_relational(spark):
    files = spark.createDataFrame([(1, "a.avi", 9), (1, "b.mp4", 5), (1, "c.mp4", 7), (2, "d.avi", 3), (2, "e.avi", 4)], "id long, path string, size long")
    assert sorted(map(tuple, R.best_media(files, "id").collect())) == [(1, "c.mp4", 7), (2, "e.avi", 4)]
    rows = spark.createDataFrame([("u1", "a", False, None), ("u2", "a", True, None), ("u3", "b", None, ["retranscribe"]), ("u4", "t", None, ["x"]), ("u5", "z", None, None)], "id string, source string, skipped boolean, attributes array<string>")
    assert [r["id"] for r in R.curated(rows, drop_source="z", test_sources=["t"], split="train").collect()] == ["u1"]
    assert [r["id"] for r in R.curated(rows, drop_source="z", test_sources=["t"], split="test").collect()] == ["u4"]
    with pytest.raises(Exception, match="language not supported"):
        R.language_or_error(spark.createDataFrame([("xx",)], "lang string"), "lang", ["he"]).collect()
    assert R.only_ids(files, "id", []).count() == 5 and R.only_ids(files, "id", [2]).count() == 2
    links = "array<struct<rel:string,href:string>>"
    assert one(spark, R.enclosure, [("x", "a"), ("enclosure", "b")], links) == "b"
    assert one(spark, R.enclosure, [], links) is None
    with pytest.raises(Exception, match="several enclosures"):
        one(spark, R.enclosure, [("enclosure", "b"), ("enclosure", "c")], links)


def test_descendants_however_deep(spark):
    chain = [(str(i), None if i == 0 else str(i - 1), f"t{i}", None) for i in range(1000)]
    extra = [("x", "3", "tx", "u"), ("o", "nowhere", "to", None), ("c1", "c2", "t", None), ("c2", "c1", "t", None), ("r", None, "tr", None), ("x", "3", "tx", "u")]
    got = R.descendants(spark.createDataFrame(chain + extra, "id string, parent string, title string, url string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("0", "999", "t999", None), ("0", "x", "tx", "u"), ("0", "x", "tx", "u"), ("r", "r", "tr", None)], key=str)


def test_places_in_the_whole_order(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 as v").repartition(7)
    assert sorted(map(tuple, R.numbered(rows, [F.col("v")]).select("v", "_at").collect())) == [(i, i) for i in range(1000)]
    assert R.batches(rows, [F.col("v").desc()], 300).groupBy("batch").count().orderBy("batch").collect()[-1]["count"] == 100
    plan = R.keep_first(rows.withColumn("k", F.col("v") % 3), ["k"], [F.col("v")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_parts_breaks_and_durations(spark):
    words, cuts = ["ab", "cde", "f", "", "gh"], [2, 4, 6]
    assert S.split_words(words, cuts) == [0, 1, 2, 3, 3] and S.split_words([], cuts) == []
    rows = spark.createDataFrame([("e", i, w) for i, w in enumerate(words)], "k string, i long, word string")
    got = S.words_by_part(rows, spark.createDataFrame([("e", cuts)], "k string, cuts array<int>"), ["k"], ["i"]).orderBy("i")
    assert [r["part"] for r in got.collect()] == S.split_words(words, cuts)
    heard = [("a", float(i), 1.0, 0.9) for i in range(1, 30)] + [("a", 120.0, 1.0, 0.9), ("b", 20.0, 19.0, 0.9), ("b", 40.25, 20.0, 0.1), ("c", 5.0, 5.0, 0.1)]
    df = spark.createDataFrame(heard, "entry string, end double, duration double, prob double")
    assert sorted(map(tuple, Q.first_break(df).collect())) == [("a", 89.0, "silence"), ("b", 40.25, "ratio")]
    out = Q.trailing_window(df, span=20.125, warm_up=1.0).where("entry = 'b'").orderBy("end").collect()
    assert out[1]["mean_prob"] == pytest.approx(0.1)  # the other word lies 20.25 seconds before
    spans = spark.createDataFrame([("s", [(0.0, 2.0), (2.0, 5.0)]), ("s", [])], "source string, splits array<struct<start:double,end:double>>")
    assert tuple(R.source_statistics(spans).first()) == ("s", 5.0, 2, 2, 5.0, 3.0)
    assert sorted(r["duration"] for r in R.split_durations(spans).collect()) == [2.0, 3.0]


def test_timeline(spark):
    r = spark.createDataFrame([("e", 0.0, 2.0), ("e", 1.0, 3.0), ("e", 3.0, 4.0), ("e", 6.0, 7.0)], "k string, start double, end double")
    assert [tuple(x) for x in L.union_ranges(r, ["k"]).select("start", "end", "n").orderBy("start").collect()] == [(0.0, 4.0, 3), (6.0, 7.0, 1)]
    total = spark.createDataFrame([("e", 9.0), ("f", 2.0)], "k string, total double")
    union = L.union_ranges(r, ["k"]).drop("n")
    assert sorted(map(tuple, L.complement(union, total, ["k"]).collect())) == [("e", 4.0, 6.0), ("e", 7.0, 9.0), ("f", 0.0, 2.0)]
    left = spark.createDataFrame([("e", t, i) for i, t in enumerate([0.0, 5.0, 7.5, 99.0])], "k string, ts double, id long")
    right = spark.createDataFrame([("e", 5.0, "a"), ("e", 10.0, "b")], "k string, ts double, v string")
    assert {x["id"]: (x["v"], x["gap"]) for x in L.nearest(left, right, ["k"], "ts", ["v"]).collect()} == {0: ("a", 5.0), 1: ("a", 0.0), 2: ("a", 2.5), 3: ("b", 89.0)}
    same = spark.createDataFrame([("e", 5.0, "z"), ("e", 5.0, "a"), ("f", 1.0, "q")], "k string, ts double, v string")
    assert {x["id"]: x["v"] for x in L.nearest(left, same, ["k"], "ts", ["v"]).collect()} == dict.fromkeys(range(4), "a")
    assert L.nearest(left, same.where("k = 'f'"), ["k"], "ts", ["v"]).first()["v"] is None
    assert L.tightened(r, 0.5).count() == 2
    times = spark.createDataFrame([("e", i, t) for i, t in enumerate([0.0, 0.0, 5.0, 4.0, 6.0])], "k string, i long, ts double")
    assert [x["ts"] for x in L.monotone(times, ["k"], ["i"]).orderBy("i").collect()] == [2.0, 5.0, 6.0]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 40), st.integers(1, 12)), min_size=1, max_size=12))
def test_overlaps(spark, a, b):
    make = lambda rows: spark.createDataFrame([("e", i, float(s), float(s + n)) for i, (s, n) in enumerate(rows)], "k string, id long, start double, end double")
    got = L.overlapping(make(a), make(b), ["k"], 7.0).select("id", "other_id").collect()
    want = [(i, j) for (i, x), (j, y) in itertools.product(enumerate(a), enumerate(b)) if x[0] < y[0] + y[1] and x[0] + x[1] > y[0]]
    assert sorted(map(tuple, got)) == sorted(want)


def zone(words, window, hop, limit):
    s, end = words[0][0], max(w[1] for w in words)
    while s + window < end:
        inside = [w for w in words if w[0] < s + window and w[1] > s]
        bad, good = sum(max(0.1, b - a) for a, b, p in inside if p < 0.4), sum(b - a for a, b, p in inside if p >= 0.4)
        if (bad / good if good else math.inf) > limit:
            return s
        s += hop
    return None


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 4), st.sampled_from([0.1, 0.4, 0.9])), min_size=2, max_size=25))
def test_confusion_zone(spark, words):
    words = sorted((float(s), float(s + n), p) for s, n, p in words)
    df = spark.createDataFrame([("e", s, e, e - s, p) for s, e, p in words], "entry string, start double, end double, duration double, prob double")
    got = Q.confusion_zone(df, window=12.0, hop=3.0).first()
    assert (got and got["zone_start"]) == zone(words, 12.0, 3.0, 0.8)


def test_packing_of_captions():
    cues = [(float(i * 7), float(i * 7 + 6)) for i in range(12)]
    groups = S.greedy_groups(cues)
    assert groups[0] == (0, 3) and groups[-1][1] == 10
    assert all(cues[b][1] - cues[a][0] < S.PACK_LIMIT or a == b for a, b in groups)
    assert S.greedy_groups(cues[:2]) == []
    assert S.merge_near_ranges([(0, "a"), (2.9, "b"), (6, "c"), (20, " ")]) == [(0, "ab"), (6, "c ")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 100), min_size=1, max_size=30))
def test_repairs(times):
    b = S.repair_by_jumps(times)
    first = next((i for i, v in enumerate(b) if v > 0), len(b))
    assert len(b) == len(times) and all(x <= y for x, y in zip(b[first:], b[first + 1 :], strict=False))
    assert S.repair_by_differences(times) == paid_steps(times)


def paid_steps(times):
    """Repair A step by step, as it is defined."""
    if max(times) <= 0:
        return times
    x = [min(t for t in times if t > 0), *times[1:]]
    d = [b - a for a, b in itertools.pairwise(x)]
    while d and min(d) < 0:
        k, top, r = d.index(min(d)), len(d) - 1, 1
        place = lambda r: range(max(0, k - r), max(max(0, k - r), min(top, k + r + 1)))  # noqa: B023, E731
        gave_up = False
        while sum(d[i] for i in place(r)) < 0 and not gave_up:
            r += 1
            gave_up = k - r < 0 and k + r + 1 > top
        need, d[k] = -d[k], 0
        if gave_up:
            break
        for i in sorted(place(r), key=lambda i: (-d[i], i)):
            if d[i] > 0 and need:
                take = min(need, d[i])
                d[i], need = d[i] - take, need - take
    return list(itertools.accumulate([x[0], *d]))


def test_repair_by_differences_on_many_series():
    r = random.Random(11)
    for _ in range(4000):
        times = [r.randint(0, 60) for _ in range(r.randint(2, 9))]
        assert S.repair_by_differences(times) == paid_steps(times)
    assert S.repair_by_differences([37, 60, 6, 57, 20]) == [6, 6, 6, 20, 20]


def test_repair_examples():
    assert S.repair_by_differences([0, 5, 10, 8, 12, 20]) == [5, 5, 8, 8, 12, 20]
    assert S.repair_by_jumps([0, 0, 3, 10, 9, 100, 12, 14, 16, 18]) == [0, 0, 3, 10, 10, 40, 40, 40, 40, 40]
    assert S.repair_by_jumps([0, 3, 40, 41, 42, 43, 44]) == [0, 3, 40, 41, 42, 43, 44]


def test_speech():
    p = np.full(1500, 0.98)
    p[200:500] = 0.02
    (a, b), (c, d) = S.speech_ranges(p)
    assert (a, d) == (0.0, 30.0) and b == pytest.approx(4.3) and c == pytest.approx(9.68)
    assert S.speech_ranges(np.full(100, 0.5)) == [(0.0, 2.0)]
    assert S.two_means([0.1, 0.2, 0.9]).tolist() == [0, 0, 1]
    assert S.outside([(0.0, 1.0), (2.0, 3.0)], 3.0) == [(1.0, 2.0)]


def test_segments():
    text = "Hello there. This is a test. And more words here. The end."
    slices = [(0, 12, 0.0), (12, 28, 20.0), (28, 49, 40.0), (49, 58, 60.0)]
    out = S.build_segments(text, slices)
    assert [round(o[0]) for o in out] == [0, 20, 40] and out[0][2] == "Hello there."
    assert out[0][1] == pytest.approx(2 * 0.42)  # an outlier ends where its words would


def test_matching(spark):
    w = {r["char"]: r["weight"] for r in M.character_weights(spark.createDataFrame([(1, "aaab")], "k long, text string"), ["k"]).collect()}
    assert w["b"] > w["a"] and sum(w.values()) == pytest.approx(1)
    reference = "nothing like it. the quick brown fox jumps over the lazy dog, and then some"
    weights = dict.fromkeys("abcdefghijklmnopqrstuvwxyz ", 1.0)
    aligned, distance, fallback = M.align_text("quick brown fox jumps over", reference, weights, width=8)
    assert not fallback and "brown fox jumps" in aligned and distance < 0.35
    assert M.align_text("???", reference, weights)[2]
    cost = np.ones((3, 6))
    cost[[0, 1, 2], [2, 3, 4]] = 0
    assert M.dtw(cost) == (0.0, [(0, 2), (1, 3), (2, 4)])
    assert M.matching_edge(reference, [0, 16, 21, 27], 20, "quick", weights) == 21
    df = spark.createDataFrame([("abcdef" * 100, "def")], "w string, q string")
    assert df.select(M.locate_text(F.col("w"), F.col("q"), [10, 50], F.lit(300))).first()[0] == 291


def test_fine_search_finds_what_begins_between_strides(spark):
    r = random.Random(4)
    text = " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(700))
    places = [35, 1015, 1230, 2485]
    assert [M.find_start(text, text[at : at + 400], M.rarity(text))[0] for at in places] == places
    assert M.union_ranges([(5, 9), (0, 5), (20, 30), (22, 25)]) == [(0, 9), (20, 30)] and M.find_start("short", "a longer query", M.rarity("short")) is None
    weights = {c["char"]: c["weight"] for c in M.character_weights(spark.createDataFrame([(1, text)], "k long, text string"), ["k"]).collect()}
    assert M.rarity(text) == pytest.approx(weights)
    rows = M.fine_search(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, i, text[at : at + 400]) for i, at in enumerate(places)], "doc_id long, query long, query_text string"))
    assert sorted((x["query"], x["at"]) for x in rows.collect()) == list(enumerate(places))


def test_ends_of_the_warp():
    r = np.random.default_rng(5)
    for n, m in [(1, 1), (7, 2), (20, 1), (40, 90), (33, 200)]:
        a, b = r.random((n, 6)), r.random((m, 6))
        distance, path = M.dtw(M.cosine_distances(a, b))
        assert M.warp_ends(M.unit_rows(a), M.unit_rows(b).T) == (pytest.approx(distance), path[0][1], path[-1][1])


def test_edges_are_the_pieces_like_the_query():
    reference = "nothing like it. the quick brown fox jumps over the lazy dog, and then some more words"
    weights = {c: 1.0 for c in reference}
    assert M.align_text("quick brown fox jumps over", reference, weights, width=8)[0] == "quick brown fox jumps over"
    a, b = M.reference_edges("brown fox jumps", reference, 24, 41, weights)  # the warp is some characters off
    assert reference[a:b].strip() == "brown fox jumps"
    assert M.align_text("then some more words", reference, weights, width=8)[0] == "then some more words"


def test_every_character_is_compared(spark, monkeypatch):
    from cantilena.queries import QUERIES

    steps, real = [], M.align_splits
    monkeypatch.setattr(M, "align_splits", lambda *a, **k: steps.append(k.get("step", 1)) or real(*a, **k))
    QUERIES["dtw_align"](spark, "/root/testdata/sf0.001")
    assert steps == [1]


def test_scores(spark):
    words = spark.createDataFrame([("e", 0, 0.0, 1.0, 0.5, 1.0), ("e", 0, 1.0, 1.0, 0.7, 0.0), ("e", 1, 2.0, 4.0, 0.1, 2.0)], "entry string, seg long, start double, end double, prob double, duration double")
    durations = spark.createDataFrame([("e", 4.0)], "entry string, duration double")
    got = corpus.normalized_entries(words, durations).first()
    assert (got["quality_score"], got["segments_count"], got["words_count"], got["avg_words_per_minute"]) == (0.5, 2, 3, 45.0)
    assert [x["probability"] for x in got["per_segment_quality_scores"]] == [0.6, 0.1]
    assert Q.zero_length(words).first()["zero_share"] == pytest.approx(1 / 3)


def test_maximum_range_and_head(spark):
    df = spark.createDataFrame([(1, -0.5, 80.0), (1, -0.2, 79.9), (2, None, 320.0), (3, -1.0, 320.1)], "k long, avg_logprob double, lag double")
    assert {r["k"]: r["max_logprob"] for r in Q.max_logprob(df, ["k"]).collect()} == {1: -0.2, 2: float("-inf"), 3: -1.0}
    assert sorted(r["lag"] for r in Q.lags_within(df, "lag", F.lit(200.0)).collect()) == [80.0, 320.0]
    assert [r["lag"] for r in R.head(df.where("k < 3"), 2, "lag").collect()] == [79.9, 80.0] and R.head(df, None).count() == 4


def test_controller():
    words = [(f"w{i}", float(i), float(i + 1)) for i in range(400)]

    def align(start, stop, text):
        out = []
        for k, w in enumerate(text.split()):
            i = int(w[1:])
            lost = 150 <= i < 260
            out.append({"start": float(i), "end": float(i + 1), "text": w, "words": [(w, float(i), float(i + 1), 0.1 if lost and stop is None else 0.9)]})
        return out

    original = [{"start": float(i), "end": float(i + 10), "text": " ".join(w[0] for w in words[i : i + 10])} for i in range(0, 400, 10)]
    got = corpus.align_with_recovery(original, align)
    assert [s["text"] for s in got][:3] == ["w0", "w1", "w2"] and got[-1]["text"] == "w399"
    registry = corpus.Registry()
    registry.add("x")(lambda: 1)
    assert registry.build("x") == 1
    with pytest.raises(ValueError):
        registry.build("y")


def test_entries_through_a_model(spark):
    def model(scale):
        def run(batches):
            for pdf in batches:
                yield pd.DataFrame({"id": pdf["id"], "y": pdf["id"] * scale})

        return run

    assert corpus.modelled(spark.range(4), "id long, y long", model, scale=3).agg(F.sum("y")).first()[0] == 18


def test_names_slices_and_samples(spark):
    files = spark.createDataFrame([("s", "e1"), ("s", "e2")], "source string, episode string")
    done = spark.createDataFrame([("s__e1.wav", 1), ("x__y.wav", 2)], "name string, v long")
    assert [(r["source"], r["episode"], r["v"]) for r in R.restored_names(done, files).collect()] == [("s", "e1", 1)]
    words = "array<struct<start:double,end:double>>"
    assert one(spark, lambda c: F.size(R.words_inside(c, F.lit(1.0), F.lit(3.0))), [(1.0, 2.0), (1.5, 2.5), (2.0, 3.0)], words) == 1
    splits = spark.createDataFrame([("e", i) for i in range(50)], "entry string, split long")
    a, b = (sorted(map(tuple, R.lag_sample(d, "entry", 7).collect())) for d in (splits, splits.repartition(5)))
    assert a == b and len(a) == 7
    groups = spark.createDataFrame([("a/b.mp4", 0, 1.0, 2.5)], "path string, grp long, start double, end double")
    assert tuple(R.media_slices(groups, F.lit("mp3")).first()) == ("a/b.mp4", 1000, 2500, "a/b.0.mp3")
    assert R.first_entity(splits, [F.col("split").desc()], entry="e").first()["split"] == 49


def test_schemas(spark):
    from cantilena.schemas import TABLES

    for ddl in TABLES.values():
        assert spark.createDataFrame([], ddl).count() == 0
