"""Operators that advance all entries at once, held against one entry at a time."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cantilena.operators import clusters as K
from cantilena.operators import lags as G
from cantilena.operators import matching as M
from cantilena.operators import packing as P
from cantilena.operators import quality as Q
from cantilena.operators import scans as X
from cantilena.operators import sequential as S
from cantilena.operators import timeline as L
from cantilena.plans import corpus
from cantilena.plans import recovery as R
from cantilena.streaming.breaks import BreakSettings, Watch, break_stream


def test_packing_by_doubling(spark):
    r, rows, want = random.Random(4), [], []
    for e in range(40):
        t, cues = 0.0, []
        for _ in range(r.randint(0, 60)):
            t += r.choice([0.0, 1.5, 4.0, 9.0])
            cues.append((t, t + r.choice([0.5, 3.0, 9.0, 29.9, 45.0])))  # cues overlap, and some are longer than a group
        rows += [(e, 10 * i, a, b, None if i % 7 == 3 else f"c{i}\nx") for i, (a, b) in enumerate(cues)]
        want += [(e, g, 10 * a, 10 * b, cues[a][0], cues[b][1], " ".join("" if i % 7 == 3 else f"c{i} x" for i in range(a, b + 1))) for g, (a, b) in enumerate(S.greedy_groups(cues))]
    df = spark.createDataFrame(rows, "k long, pos long, start double, end double, text string")
    got = P.pack_captions(df, ["k"]).select("k", "grp", "first_pos", "last_pos", "start", "end", "text").collect()
    assert sorted(map(tuple, got)) == want and len(want) > 100
    assert P.pack_captions(df.where("k < 0"), ["k"]).count() == 0


def aligner(seed):
    """Words of about a second, told by a hash; some stretches of time are unclear."""

    def align(start, stop, text):
        t, out, words = start, [], text.split()
        for i in range(0, len(words), 4):
            said = []
            for w in words[i : i + 4]:
                h = zlib.crc32(f"{seed}|{w}|{int(t)}".encode())
                d = 0.0 if h % 11 == 0 else 0.5 + (h >> 8) % 4 / 4
                unclear = zlib.crc32(f"{seed}|{int(t // 15)}".encode()) % 3 == 0
                said.append((w, t, t + d, 0.125 + (h >> 16) % 2 / 8 if unclear and stop is None else 0.75 + (h >> 16) % 2 / 8))
                t += d
            out.append({"start": said[0][1], "end": said[-1][2], "text": " ".join(words[i : i + 4]), "words": said})
        return out

    return align


SETTINGS = R.ControlSettings(window=20.0, hop=5.0, least_skip=5.0, most_skip=30.0, back=10.0, sure=0.75, probe=20, radius=25.0)


def transcript(seed):
    r, out, t = random.Random(seed), [], 0.0
    for _ in range(r.randint(0, 40)):
        n = r.randint(1, 8)
        out.append({"start": t, "end": t + n, "text": " ".join(f"w{r.randint(0, 12)}" for _ in range(n))})
        t += n * r.choice([0.75, 1.0, 1.0, 1.25])
    return out


def flat(segments):
    return [(x["start"], x["end"], x["text"], [tuple(w) for w in x["words"]]) for x in segments]


def test_controller_for_all_entries_at_once(spark):
    align = aligner("a")
    entries = {e: transcript(e) for e in range(60)}
    want = {e: flat(R.align_with_recovery(x, align, SETTINGS)) for e, x in entries.items()}
    rows = [(e, i, x["start"], x["end"], x["text"]) for e, segs in entries.items() for i, x in enumerate(segs)]
    df = spark.createDataFrame(rows, "entry long, id int, start double, end double, text string")
    got = {}
    for r in R.recovered(df, R.as_model(align), "entry", SETTINGS).orderBy("entry", "piece").collect():
        got.setdefault(r["entry"], []).append((r["start"], r["end"], r["text"], [tuple(w) for w in r["words"]]))
    for e, x in want.items():
        assert got.get(e, []) == x, e
    once = {e: len(flat(align(0.0, None, " ".join(s["text"] for s in x)))) for e, x in entries.items()}
    assert sum(len(want[e]) != once[e] for e in want) > 20  # many entries needed more than one step
    assert R.recovered(df.where("entry < 0"), R.as_model(align)).count() == 0


def test_words_are_clamped():
    seg = {"start": 0.0, "end": 9.0, "text": "x", "words": [("a", 0.0, 1.0, 0.5), ("b", 4.0, 9.0, 0.5)]}
    got = R.clamped(seg, 2.0, 6.0)
    assert got["words"] == [("a", 2.0, 2.0, 0.5), ("b", 4.0, 6.0, 0.5)] and (got["start"], got["end"]) == (2.0, 6.0)


def test_text_left_is_looked_for_more_widely():
    s = R.ControlSettings(radius=10.0, probe=6)
    original = [{"start": 10.0 * i, "end": 10.0 * i + 10, "text": f"text{i:02d} more"} for i in range(10)]
    skip, behind = R.skip_of(original, "text04 more", 20.0, 60.0, 0.0, s)  # only the second look, 15 seconds, reaches segment 3; the third segment 4
    assert (skip.first, skip.cut, skip.behind, behind) == (4, 0, 6, 6)
    skip, _ = R.skip_of(original, "more text01", 20.0, 60.0, 0.0, s)
    assert (skip.first, skip.cut) == (1, 7)
    skip, _ = R.skip_of(original, "nowhere", 20.0, 60.0, 15.0, s)
    assert (skip.first, skip.cut) == (1, 0)


@pytest.fixture
def spoken():
    r, rows = random.Random(8), []
    for k in range(12):
        t = 1000.0
        for _ in range(r.randint(1, 80)):
            t += r.choice([0.5, 1.0, 2.5, 70.0 if r.random() < 0.2 else 3.0])
            rows.append((f"k{k}", t, 1.0, r.choice([0.1, 0.9, 0.9]) if k % 2 else 0.9))
    return rows


def test_breaks_of_a_stream_are_those_of_the_batch(spark, spoken, tmp_path):
    until = max(r[1] for r in spoken) + 500.0
    words = [(k, end, d, p) for k, end, d, p in spoken]
    df = spark.createDataFrame([(k, end - d, end, d, p) for k, end, d, p in words], "entry string, start double, end double, duration double, prob double")
    want = {r["entry"]: (r["at"], r["reason"]) for r in Q.first_break(df, limit=0.6, until=until).collect()}
    assert {x[1] for x in want.values()} == {"ratio", "silence"}
    # Words come in files by time, shuffled inside; the last files only move the clock: a key of its own, without words.
    order = sorted(words, key=lambda w: w[1])
    files = [order[i : i + 60] for i in range(0, len(order), 60)] + [[("clock", until + 40 + i, 0.0, None)] for i in range(3)]
    for i, part in enumerate(files):
        rows = spark.createDataFrame(random.Random(i).sample(part, len(part)), "entry string, end double, duration double, prob double")
        rows.select("entry", F.timestamp_micros((F.col("end") * 1_000_000).cast("long")).alias("ts"), "duration", "prob").coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"n={i:03d}"))
    source = spark.readStream.schema("entry string, ts timestamp, duration double, prob double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    out = break_stream(source, settings=BreakSettings(limit=0.6))
    q = out.writeStream.format("memory").queryName("breaks_out").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [tuple(r) for r in spark.table("breaks_out").where("entry != 'clock'").collect()]
    assert len(got) == len(want) and {k: (pytest.approx(at), reason) for k, at, reason in got} == want


def test_silence_alone_breaks():
    settings, watch = BreakSettings(), Watch([], None, [(5.0, 1.0, 0.9)])
    assert watch.advance(10.0, settings) is None and watch.wakes_at(settings) == 65.0
    assert watch.advance(65.0, settings) is None and watch.advance(65.5, settings) == (65.0, "silence")
    assert watch.broken and watch.wakes_at(settings) is None
    heard = Watch([], None, [(5.0, 1.0, 0.9), (30.0, 0.0, float("nan")), (66.0, 0.0, float("nan"))])  # heard, but no words
    assert heard.advance(66.5, settings) == (65.0, "silence")


def test_repair_of_long_series_takes_seconds():
    r = random.Random(1)
    times = [max(0, 2 * i + r.randint(-30_000, 3000)) for i in range(100_000)]
    got = S.repair_by_differences(times)
    assert len(got) == len(times) and all(a <= b for a, b in zip(got, got[1:], strict=False))


def test_warping_in_tiles(spark):
    r = random.Random(6)
    text = lambda n: "".join(r.choice("abcdefgh  ") for _ in range(n))
    rows = []
    for i, (n, m) in enumerate([(70, 400), (33, 90), (8, 1000), (100, 41), (1, 5), (64, 64)]):
        reference = text(m)
        at = r.randint(0, max(0, m - n))
        base = "".join(c for c in reference[at : at + n] if r.random() < 0.9) or "a"
        rows.append((i, base, reference, M.rarity(reference)))
    df = spark.createDataFrame(rows, "k long, base string, reference string, weights map<string,double>")
    got = {x["k"]: x for x in M.tiled_warp(df, ["k"], rows=8, columns=32).collect()}
    for k, base, reference, weights in rows:
        want = M.warp_ends(M.unit_rows(M.sliding_histograms(base, weights, 20)), M.reference_shares(reference, weights))
        assert (got[k]["distance"], got[k]["first"], got[k]["last"]) == (pytest.approx(want[0]), want[1], want[2])
    splits = spark.createDataFrame([(1, i, b, ref) for i, b, ref, _ in rows] + [(1, 9, None, "x"), (1, 10, "", "abc")], "k long, split_idx long, base string, reference string")
    tidy = lambda d: sorted((x["split_idx"], x["aligned"], round(x["alignment_distance"], 9), x["is_fallback"]) for x in d.collect())
    assert tidy(M.align_splits(splits, ["k"], tiled_from=500)) == tidy(M.align_splits(splits, ["k"]))


def test_two_means_of_all_entries(spark):
    r = random.Random(2)
    rows = [(k, i, None if i == 3 else r.choice([r.random(), r.random() / 5, 0.5, 7.0 * (k == 4)])) for k in range(9) for i in range(r.randint(1, 50))]
    got = {(x["k"], x["i"]): x["cls"] for x in K.two_means(spark.createDataFrame(rows, "k long, i long, v double"), ["k"], "v").collect()}
    for k in range(9):
        mine = [(i, v) for e, i, v in rows if e == k and v is not None]
        assert [got[k, i] for i, _ in mine] == S.two_means([v for _, v in mine]).tolist()
    assert all(got[k, i] is None for k, i, v in rows if v is None)


def test_ranges_of_very_different_lengths(spark):
    r = random.Random(3)
    make = lambda n: [(r.randint(0, 1), i, s := r.uniform(0, 1e6), s + r.choice([0.0, 5.0, 900.0, 3.2e5, 1e6])) for i in range(n)]
    a, b = make(80), make(80)
    frame = lambda rows: spark.createDataFrame(rows, "k long, id long, start double, end double")
    got = sorted((x["id"], x["other_id"]) for x in L.overlapping(frame(a), frame(b), ["k"], 60.0).select("id", "other_id").collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and x[3] > y[2])
    points = [(k, float(at)) for k in (0, 1) for at in range(0, 1_000_000, 40_000)] * 2
    held = L.containing(spark.createDataFrame(points, "k long, at double"), frame(a), ["k"], "at", "start", "end", 60.0).collect()
    want = []
    for k, at in points:
        inside = [(s, i, e) for e_, i, s, e in a if e_ == k and s <= at <= e]
        want += [(k, at, *min(inside)[:2])] if inside else []
    assert sorted((x["k"], x["at"], x["start"], x["id"]) for x in held) == sorted(want)  # equal points come back as often as they are


def lag_rule(lags, expected, s):
    """Sample by sample: how many were drawn, and the lag."""
    seen, inside = 0, []
    for i, lag in enumerate(lags):
        seen += lag is not None
        inside += [lag] if lag is not None and abs(lag - expected) <= s.buffer else []
        if len(inside) >= s.least:
            half = Q.T_975[len(inside) - 1] * np.std(inside, ddof=1) / np.sqrt(len(inside))
            if 2 * half <= s.width:
                return i + 1, float(np.mean(inside)), True
        if seen >= s.most:
            return i + 1, float(np.mean(inside)) if inside else expected, True
    return len(lags), float(np.mean(inside)) if inside else expected, False


def test_lags_are_drawn_until_they_agree(spark):
    r, s = random.Random(9), G.LagSettings(batch=4)
    lags = {k: [None if r.random() < 0.15 else r.gauss(40, k * 3.0) + (500 if r.random() < 0.1 else 0) for _ in range(r.choice([0, 3, 20, 60]))] for k in range(24)}
    rows = [(k, i, x) for k, of in lags.items() for i, x in enumerate(of)]
    asked = []

    def estimate(drawn):
        asked.append(drawn.count())
        return drawn.select("k", "draw", "hidden").withColumnRenamed("hidden", "lag").where("lag is not null")

    samples = spark.createDataFrame(rows, "k long, draw int, hidden double")
    expected = spark.createDataFrame([(k, 45.0) for k in lags], "k long, expected double")
    got = {x["k"]: (x["draws"], x["lag"], x["stopped"]) for x in G.sequential_lags(samples, estimate, expected, ["k"], s).collect()}
    for k, of in lags.items():
        want = lag_rule(of, 45.0, s)
        assert got[k] == (want[0], pytest.approx(want[1]), want[2]), k
    assert sum(asked) < len(rows)  # entries that agree are asked no more
    none = G.sequential_lags(samples.where("k < 0"), estimate, expected, ["k"], s).collect()
    assert {(x["draws"], x["lag"]) for x in none} == {(0, 45.0)}


def test_lag_from_a_place(spark):
    index = spark.createDataFrame([(1, 0, 10, 0.0), (1, 10, 30, 5.0), (1, 30, 40, 25.0)], "k long, start_loc long, end_loc long, ts double")
    found = spark.createDataFrame([(1, 0, 20), (1, 1, 10), (1, 2, 35), (1, 3, 99)], "k long, query long, at long")
    samples = spark.createDataFrame([(1, i, 1.0) for i in range(4)], "k long, query long, begins double")
    got = {x["query"]: x["lag"] for x in G.lags_of_places(found, index, samples, ["k"]).collect()}
    assert got == {0: 14.0, 1: 4.0, 2: 24.0}  # 10 lies in two slices: the first counts


def test_functions_of_stretches():
    r = random.Random(12)
    for _ in range(300):
        whole, steps = X.SAME, []
        for _ in range(r.randint(1, 12)):
            x = r.randint(0, 400) / 4
            steps.append((x, [r.randint(0, 400) / 4 for _ in range(r.randint(0, 4))]))
            whole = X.composed(whole, X.step_pieces(*steps[-1], 30.0))
        for time in [r.randint(-200, 600) / 4 for _ in range(30)]:
            want = time
            for x, ahead in steps:
                want = X.value_at(X.step_pieces(x, ahead, 30.0), want)
            assert X.value_at(whole, time) == want


def test_repair_by_jumps_as_a_scan(spark):
    r, series = random.Random(13), {}
    for k in range(60):
        n = r.choice([1, 2, 9, 12, 13, 50, 200])
        series[k] = [max(0.0, 0 if i < 3 and k % 3 else i * 2 + r.choice([0, 0, 0, 40, -40, 150, 900]) + r.randint(0, 3) / 4) if k else 0.0 for i in range(n)]
    df = spark.createDataFrame([(k, i, x) for k, of in series.items() for i, x in enumerate(of)], "k long, idx long, sec double")
    got = {k: [None] * len(of) for k, of in series.items()}
    for x in X.repaired_by_scan(df, ["k"], stretch=12).collect():
        got[x["k"]][x["idx"]] = x["sec"]
    for k, of in series.items():
        assert got[k] == S.repair_by_jumps(of), k


def test_calls_are_tried_again():
    seen = []

    def call(x):
        seen.append(x)
        if len(seen) < 3:
            raise ConnectionError
        return x

    assert corpus.retried(call, wait=0.0)(7) == 7 and seen == [7, 7, 7]
    with pytest.raises(ConnectionError):
        corpus.retried(lambda: (_ for _ in ()).throw(ConnectionError()), tries=2, wait=0.0)()
    with pytest.raises(KeyError):  # not an error of the service
        corpus.retried(lambda: {}["x"], wait=0.0)()


def test_speech_by_stretches(spark):
    r, series = random.Random(14), {}
    for k in range(12):
        p, n = [], r.choice([40, 1500, 6000, 9000]) if k else 0
        while len(p) < n:
            p += [r.choice([0.02, 0.04]) if r.random() < 0.3 else r.choice([0.98, 0.97, 1.0])] * r.choice([5, 60, 230, 400])
        series[k] = p
    df = spark.createDataFrame([(k, i, x) for k, p in series.items() for i, x in enumerate(p)], "k long, frame_idx long, prob double")
    got = {k: [] for k in series}
    for x in X.speech_by_stretches(df, ["k"], S.VadSettings(least=1.0), stretch=700).orderBy("k", "start").collect():
        got[x["k"]].append((x["start"], x["end"]))
    for k, p in series.items():
        assert got[k] == S.speech_ranges(p, S.VadSettings(least=1.0)), k
    assert sum(map(len, got.values())) > 40


class Shelf:
    """A source of five entries in memory."""

    def __init__(self):
        self.segments = self.rows = None

    def entries(self, spark):
        return spark.createDataFrame([(e, {"lang": "he", "seconds": "60"}) for e in ("new", "old", "mute", "blank", "lost")], "entry string, meta map<string,string>")

    def audio(self, spark):
        return spark.createDataFrame([(e, f"/{e}.mp3") for e in ("new", "old", "blank", "lost")], "entry string, path string")

    def transcripts(self, spark):
        return spark.createDataFrame([(e, i, 10.0 * i, 10.0 * i + 10, f"w{i} w{i + 1}") for e in ("new", "old", "mute") for i in range(3)] + [("lost", 0, 0.0, 1.0, "  ")], "entry string, id int, start double, end double, text string")

    def aligned(self, spark):
        return spark.createDataFrame([("old", 0, 0.0, 2.0, "w0", [("w0", 0.0, 2.0, 0.5)])], f"entry string, piece int, start double, end double, text string, words {R.WORDS}")

    def language(self):
        return F.col("meta")["lang"]

    def duration(self):
        return F.col("meta")["seconds"]

    def save_aligned(self, segments):
        self.segments = segments.collect()

    def save_entries(self, rows):
        self.rows = rows.collect()


def test_a_source_is_normalised(spark):
    def align(start, stop, text):
        return [{"start": start + i, "end": start + i + 1, "text": w, "words": [(w, start + i, start + i + 1, 0.9)]} for i, w in enumerate(text.split())]

    source = Shelf()
    run = lambda **how: {r["entry"]: r for r in corpus.normalize(source, spark, lambda texts, jobs: R.recovered(texts, R.as_model(align)), **how).collect()}
    got = run()
    assert {k: r["status"] for k, r in got.items()} == {"new": "aligned", "old": "done", "mute": "no audio", "blank": "no transcript", "lost": "not aligned"}
    new = got["new"]
    assert (new["language"], new["duration"], new["quality_score"], new["segments_count"], new["words_count"], new["avg_words_per_minute"], new["failed"]) == ("he", 60.0, 0.9, 6, 6, 6.0, False)
    assert {r["entry"] for r in source.segments} == {"new"} and {r["entry"] for r in source.rows} == {"new"} and got["old"]["quality_score"] is None
    got = run(rescore=True)
    assert got["old"]["status"] == "rescored" and got["old"]["quality_score"] == 0.5 and {r["entry"] for r in source.rows} == {"new", "old"}
    assert run(force=True)["old"]["words_count"] == 6


def test_packing_where_sums_round(spark):
    """end - start falls short of the limit, but start + limit rounds down to end: such a cue once led to itself, and the doubling never ended."""
    starts = [s for s in (i / 20 for i in range(200_000, 240_000)) if (e := (round(s * 20) + 598) / 20) - s < 29.9 <= 29.9 + s <= e][:3]
    assert starts
    cues = [c for s in starts for c in [(s, (round(s * 20) + 598) / 20), (s + 1, s + 2), (s + 40, s + 41)]]
    cues = sorted(cues)
    rows = [(1, i, a, b) for i, (a, b) in enumerate(cues)]
    jumps = P.next_starts(spark.createDataFrame(rows, "k long, i long, start double, end double"), ["k"]).collect()
    for j in jumps:
        want = next((i for i in range(j["i"] + 1, len(cues)) if cues[i][1] - j["start"] >= S.PACK_LIMIT), None)
        assert j["to"] == want, j
    got = P.pack_captions(spark.createDataFrame([(*r, "x") for r in rows], "k long, pos long, start double, end double, text string"), ["k"])
    assert sorted((r["first_pos"], r["last_pos"]) for r in got.collect()) == S.greedy_groups(cues)

def test_most_alike_in_blocks(spark, monkeypatch):
    from cantilena.functions.vectors import cosine
    from cantilena.operators import neighbours as N

    monkeypatch.setattr(N, "QUERY_BLOCK", 3)
    monkeypatch.setattr(N, "ROW_BLOCK", 17)
    r = random.Random(5)
    vectors = [[r.choice([-1.0, 0.5, 0.25, r.random()]) for _ in range(4)] for _ in range(120)]
    for i in range(30, 70):
        vectors[i] = vectors[31] if i % 2 else [2 * x for x in vectors[31]]  # copies and multiples: ties go by id
    vectors[0], vectors[20], vectors[40], vectors[7], vectors[8], vectors[9], vectors[11] = None, [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan")] * 4, [1.0, 2.0], [], [float("inf"), 1.0, 0.0, 0.0]
    vectors[80], vectors[100] = [1.0, 2.0], vectors[7]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").repartition(3)
    got = N.most_alike(df.where("vec_id % 10 = 0"), df, "vec_id", "embedding", 5).collect()
    pairs = df.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("a")).crossJoin(df).where("query != vec_id").withColumn("s", cosine(F.col("a"), F.col("embedding")))
    want = pairs.withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.round("s", 9).desc(), "vec_id"))).where("rank <= 5").collect()
    assert len(want) == 60 and sorted((x["query"], x["rank"], x["vec_id"], repr(x["similarity"])) for x in got) == sorted((x["query"], x["rank"], x["vec_id"], repr(x["s"])) for x in want)
    assert N.most_alike(df.where("vec_id < 0"), df, "vec_id", "embedding", 5).count() == 0


def test_hash_of_spark(spark):
    from cantilena.functions.hashes import xxhash64

    texts = ["", "a", "abcd", "abcdefgh", "é" * 11, "x" * 31, "y" * 32, "z" * 77, "0123456789ab"]
    got = spark.createDataFrame([(i - 3, t) for i, t in enumerate(texts)], "n long, t string").select("n", "t", F.xxhash64("t").alias("h"), F.xxhash64("n", "n", "t").alias("m")).collect()
    assert [(r["h"], r["m"]) for r in got] == [(xxhash64(r["t"]), xxhash64(r["n"], r["n"], r["t"])) for r in got]


def test_recovery_by_entry_draws_what_a_zone_needs(spark):
    """A long entry of many zones, which once cost some thirty jobs a step: the same segments, and not all of the text is heard at each try."""
    s, drawn = R.ControlSettings(window=8.0, hop=2.0, least_skip=3.0, most_skip=24.0, back=6.0, radius=54.0, probe=18), [0]

    def voice(key):
        def align(start, stop, text):
            words = text.split()
            for i in range(0, len(words), 4):
                drawn[0] += 1
                at = [start + (i + k) / 4 for k in range(5)]
                said = [(w, at[k], at[k + 1], 0.1 if stop is None and zlib.crc32(f"{key}{int(at[k] / 10)}".encode()) % 3 == 0 else 0.75 + len(w) % 2 / 4) for k, w in enumerate(words[i : i + 4])]
                yield {"start": said[0][1], "end": said[-1][2], "text": " ".join(words[i : i + 4]), "words": said}

        return align

    r, rows, want = random.Random(6), [], []
    for k, n in enumerate([0, 1, 2, 40, 400]):
        texts = [" ".join("w" * r.randint(1, 6) + str(r.randint(0, 50)) for _ in range(r.randint(1, 30))) for _ in range(n)]
        ends = np.cumsum([len(t.split()) / 5 for t in texts]).tolist()
        whole = [{"start": a, "end": b, "text": t} for a, b, t in zip([0.0, *ends], ends, texts, strict=False)]
        rows += [(k, i, x["start"], x["end"], x["text"]) for i, x in enumerate(whole)]
        drawn[0] = 0
        eager = R.align_with_recovery(whole, lambda *a, v=voice(k): list(v(*a)), s)
        all_drawn, drawn[0] = drawn[0], 0
        assert R.align_with_recovery(whole, voice(k), s, R.heard_in_order) == eager
        assert n < 400 or drawn[0] * 10 < all_drawn
        want += [(k, i, x["start"], x["end"], x["text"], x["words"]) for i, x in enumerate(eager)]
    got = R.recovered_by_entry(spark.createDataFrame(rows, "entry long, id long, start double, end double, text string").repartition(3), voice, "entry", s).collect()
    assert sorted((g["entry"], g["piece"], g["start"], g["end"], g["text"], [tuple(w) for w in g["words"]]) for g in got) == want


def test_warp_without_most_cells(monkeypatch):
    """Bases that stand in the reference, are worn, stand there twice or nowhere: the ends and distances of warp_ends, and for most of those that stand there not by it."""
    r, whole = random.Random(11), [0]
    text = lambda n: "".join(r.choice("eeeetaaoinsrh  ") for _ in range(n))
    whole_warp = M.warp_ends
    monkeypatch.setattr(M, "warp_ends", lambda *a: whole.__setitem__(0, whole[0] + 1) or whole_warp(*a))
    for kind in ("in", "in", "in", "in", "begin", "end", "worn", "worn", "twice", "nowhere", "short", "longer", "one"):
        reference = text(1500)
        at = {"begin": 0, "end": 1200}.get(kind, 700)
        base = text(300) if kind == "nowhere" else "e" * 100 if kind == "one" else reference[at : at + (40 if kind == "short" else 300)]
        if kind == "worn":
            base = "".join(c for c in base if r.random() > 0.08)
        reference = {"twice": reference + base + text(50), "longer": base[:200]}.get(kind, reference)
        weights, before = M.rarity(reference), whole[0]
        query, columns = M.unit_rows(M.sliding_histograms(base, weights, 20)), M.reference_shares(reference, weights)
        want, got = whole_warp(query, columns), M.nearest_warp(query, columns)
        assert got[0] == pytest.approx(want[0], abs=1e-12), kind
        assert got[1:] == want[1:] or kind in ("twice", "one"), kind
        assert whole[0] == before or kind not in ("in", "begin", "end"), kind


def test_speech_of_runs(spark):
    """Rows that stand for many equal frames, across stretches too; once each frame was a row of its own."""
    r, runs, series = random.Random(15), [], {}
    for k in range(9):
        at, series[k] = 0, []
        for _ in range(k * 3):
            n, p = r.choice([1, 7, 100, 230, 900]), 0.02 if r.random() < 0.3 else 0.98
            runs.append((k, at, p, n))
            series[k] += [p] * n
            at += n
    df = spark.createDataFrame(runs, "k long, frame_idx long, prob double, n long").repartition(3)
    got = {k: [] for k in series}
    for x in X.speech_by_stretches(df, ["k"], S.VadSettings(least=1.0), stretch=700, times="n").orderBy("k", "start").collect():
        got[x["k"]].append((x["start"], x["end"]))
    assert all(got[k] == S.speech_ranges(p, S.VadSettings(least=1.0)) for k, p in series.items())
    assert sum(map(len, got.values())) >= 15
