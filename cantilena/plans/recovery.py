"""The alignment controller: where words lose the audio, go back to a sure segment and try again, at last skip the stretch and go on behind it.

`recovered` advances all entries at once. A table holds each entry's state: where its audio goes on, the text left, the zone of confusion, how often it was tried. A step sends
every entry's text through the model, judges the answer by joins, and writes what is settled; entries that are through leave the table. Its steps follow the entry with the most
confusion, so it is made for models that must answer many entries at once. `recovered_by_entry` shares entries out instead, for models that answer one text at a time: one job,
however long an entry is. `align_with_recovery` is one entry in plain Python, which tests hold both against.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import takewhile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import clamp_range
from ..operators.quality import BAD, confusion_zone
from ..storage import cut

Segment = dict  # start, end, text, words: list of (word, start, end, probability)
#: Aligns a text to the audio from a time on, up to another if there is one; given by the caller, as models are no part of this library.
Aligner = Callable[[float, float | None, str], list[Segment]]
WORDS = "array<struct<word:string,start:double,end:double,prob:double>>"


@dataclass(frozen=True)
class ControlSettings:
    window: float = 120.0
    hop: float = 30.0
    limit: float = 0.8
    tries: int = 2
    least_skip: float = 15.0
    most_skip: float = 120.0
    back: float = 30.0
    hops: int = 6
    sure: float = 0.8
    probe: int = 90  # characters of the text left that are looked for in the transcript
    radius: float = 270.0  # seconds around the place, wider by the factor on each further look
    wider: float = 1.5
    looks: int = 3
    joiner: str = " "

    def radii(self) -> list[float]:
        return [self.radius * self.wider**i for i in range(self.looks)]


def zone_of(words: Sequence[tuple], s: ControlSettings) -> tuple[float, float] | None:
    """The first window whose bad words outlast its good ones too far."""
    if not words:
        return None
    at, last = min(w[1] for w in words), max(w[2] for w in words)
    first, k = at, 0
    while at + s.window < last:
        inside = [w for w in words if w[1] < at + s.window and w[2] > at]
        bad = sum(max(0.1, w[2] - w[1]) for w in inside if w[3] < BAD)
        good = sum(w[2] - w[1] for w in inside if w[3] >= BAD)
        if not good or bad / good > s.limit:
            return at, at + s.window
        k += 1
        at = first + k * s.hop
    return None


def anchor_before(segments: Sequence[Segment], t: float, s: ControlSettings) -> int | None:
    """The earliest sure segment of the nearest window before t that has one."""
    best = None
    for i, seg in enumerate(segments):
        probs = [w[3] for w in seg["words"]]
        if seg["start"] < t and probs and sum(probs) / len(probs) >= s.sure:
            hop = int((t - seg["start"]) // s.back)
            if hop < s.hops and (best is None or hop < best[0]):
                best = (hop, i)
    return None if best is None else best[1]


def clamped(seg: Segment, floor: float, ceiling: float | None) -> Segment:
    """A segment whose words lie in [floor, ceiling], starts never behind ends."""
    words = []
    for word, start, end, prob in seg["words"]:
        end = max(end, start, floor)
        end = end if ceiling is None else min(end, ceiling)
        words.append((word, min(max(start, floor), end), end, prob))
    return {**seg, "start": min((w[1] for w in words), default=seg["start"]), "end": max((w[2] for w in words), default=seg["end"]), "words": words}


@dataclass(frozen=True)
class Skip:
    """What is left unaligned: segments first to behind - 1 of the transcript, the first one from a character on."""

    first: int
    cut: int
    behind: int


def skip_of(original: Sequence[Segment], text: str, around: float, zone_end: float, matched: float, s: ControlSettings) -> tuple[Skip | None, int]:
    """Where the text left begins in the transcript, looked for around a time but not before `matched`, and the segment to go on with: the first that starts behind the zone."""
    behind = next((i for i, x in enumerate(original) if x["start"] >= zone_end), len(original))
    near: list[int] = []
    at = -1
    for radius in s.radii():
        lo, hi = max(matched, around - radius), around + radius
        near = [i for i, x in enumerate(original) if x["start"] < hi and x["end"] > lo]
        at = s.joiner.join(original[i]["text"] for i in near).find(text[: s.probe])
        if at >= 0:
            break
    if not near:
        return None, behind
    at, i = max(at, 0), 0
    while i + 1 < len(near) and at >= len(original[near[i]]["text"]) + len(s.joiner):
        at -= len(original[near[i]]["text"]) + len(s.joiner)
        i += 1
    return Skip(near[i], at, max(behind, near[i] + 1)), max(behind, near[i] + 1)


#: What an aligner said of a text: segments, the zone of confusion or None, and the text behind segment i.
Heard = tuple[list[Segment], tuple[float, float] | None, Callable[[int], str]]


def heard_whole(got: Sequence[Segment], start: float, text: str, s: ControlSettings) -> Heard | None:
    """None if there are no words."""
    words = [w for seg in got for w in seg["words"]]
    if not words:
        return None
    found = zone_of(words, s) if got[0]["start"] != got[-1]["end"] else (start, start + s.least_skip)
    return list(got), found, lambda i: s.joiner.join(x["text"] for x in got[i + 1 :])


def heard_in_order(said: Iterable[Segment], start: float, text: str, s: ControlSettings) -> Heard | None:
    """heard_whole of segments and words in order of time, whose texts, joined, are the text: no more of them is drawn than the first zone needs."""
    said, got, words = iter(said), [], deque()

    def draw() -> bool:
        if (seg := next(said, None)) is None:
            return False
        got.append(seg)
        words.extend(seg["words"])
        return True

    def behind(i: int) -> str:
        return text[sum(len(x["text"]) + len(s.joiner) for x in got[: i + 1]) :]

    while not words or got[-1]["end"] <= got[0]["start"]:
        if not draw():
            return (got, (start, start + s.least_skip) if got[0]["start"] == got[-1]["end"] else None, behind) if words else None
    at = first = words[0][1]
    k = 0
    while True:
        while words[-1][1] < at + s.window or words[-1][2] <= at + s.window:
            if not draw():
                break
        if not at + s.window < words[-1][2]:
            return got, None, behind
        while words[0][2] <= at:  # later windows don't see it either
            words.popleft()
        inside = list(takewhile(lambda w: w[1] < at + s.window, words))
        bad = sum(max(0.1, w[2] - w[1]) for w in inside if w[3] < BAD)
        good = sum(w[2] - w[1] for w in inside if w[3] >= BAD)
        if not good or bad / good > s.limit:
            return got, (at, at + s.window), behind
        k += 1
        at = first + k * s.hop


def align_with_recovery(original: Sequence[Segment], align: Aligner, settings: ControlSettings = ControlSettings(), heard: Callable[..., Heard | None] = heard_whole) -> list[Segment]:
    """Aligns an entry's segments (start, end, text: the transcript with rough times). What is skipped is aligned inside its bounds."""
    s, out, start, text = settings, [], 0.0, settings.joiner.join(x["text"] for x in original)
    zone, tries, matched = (0.0, 0.0), 0, 0.0
    while text:
        if (answer := heard(align(start, None, text), start, text, s)) is None:
            break
        got, found, behind_of = answer
        if found is None:
            out += got
            break
        zone, tries = (found, 0) if found[0] > zone[1] else ((min(zone[0], found[0]), max(zone[1], found[1])), tries)
        at, around = anchor_before(got, found[0], s), start
        if at is not None:
            out += got[: at + 1]
            start = around = got[at]["end"]
            text = behind_of(at)
            if tries < s.tries:
                tries += 1
                continue
        end = min(max(zone[1], start + s.least_skip), start + s.most_skip)
        skip, behind = skip_of(original, text, around, end, matched, s)
        top = out[-1]["end"] if out else 0.0
        if skip is not None:
            first = original[skip.first]
            begins = min(max(top, start), first["end"]) if skip.cut else first["start"]
            said = s.joiner.join([first["text"][skip.cut :], *(x["text"] for x in original[skip.first + 1 : skip.behind])])
            ceiling = original[behind]["start"] if behind < len(original) else None
            out += [clamped(x, top, ceiling) for x in align(max(top, begins), ceiling, said)]
            last = original[skip.behind - 1]
            matched = max(top, last["end"]) if skip.behind == skip.first + 1 and skip.cut else last["end"]
        if behind == len(original):
            break
        start, text = original[behind]["start"], s.joiner.join(x["text"] for x in original[behind:])
        zone, tries = (0.0, 0.0), 0
    return out


def as_model(align: Aligner, key: str = "entry") -> Callable[[DataFrame], DataFrame]:
    """An aligner of one text as a model of requests (key, start, stop, text): (key, seg, start, end, text, words)."""

    def model(requests: DataFrame) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = []
                for k, start, stop, text in zip(pdf[key], pdf["start"], pdf["stop"], pdf["text"], strict=True):
                    for i, x in enumerate(align(start, None if pd.isna(stop) else stop, text)):
                        rows.append((k, i, x["start"], x["end"], x["text"], [dict(zip(("word", "start", "end", "prob"), w, strict=True)) for w in x["words"]]))
                yield pd.DataFrame(rows, columns=[key, "seg", "start", "end", "text", "words"])

        return requests.select(key, "start", "stop", "text").mapInPandas(run, f"`{key}` {dict(requests.dtypes)[key]}, seg int, start double, end double, text string, words {WORDS}")

    return model


def _joined(rows: DataFrame, key: str, order: str, s: ControlSettings, name: str = "text") -> DataFrame:
    """(key, name): the texts of a key's rows in order, as one."""
    parts = F.array_sort(F.collect_list(F.struct(order, "text")))
    return rows.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["text"]), s.joiner).alias(name))


def _judged(state: DataFrame, got: DataFrame, key: str, s: ControlSettings) -> DataFrame:
    """state with known (there are words), through, zone_from, zone_to, tries, anchor (the sure segment before the zone, or null), anchor_end and again (try once more)."""
    spoken = got.select(key, F.explode("words").alias("_w")).select(key, "_w.*").withColumn("duration", F.col("end") - F.col("start"))
    ends = got.groupBy(key).agg(F.min_by("start", "seg").alias("_first"), F.max_by("end", "seg").alias("_last"), F.sum(F.size("words")).alias("_n"))
    zones = confusion_zone(spoken, key, window=s.window, hop=s.hop, limit=s.limit).select(key, F.col("zone_start").alias("_zs"), F.col("zone_end").alias("_ze"))
    rows = state.join(ends, key, "left").join(zones, key, "left")
    lost = F.col("_first") == F.col("_last")  # nothing was aligned: the zone lies at the start
    rows = rows.withColumns({"_zs": F.when(lost, F.col("start")).otherwise(F.col("_zs")), "_ze": F.when(lost, F.col("start") + s.least_skip).otherwise(F.col("_ze"))})
    fresh = F.col("_zs") > F.col("zone_to")
    rows = rows.withColumns(
        {
            "known": F.coalesce(F.col("_n") > 0, F.lit(False)),
            "tries": F.when(fresh, 0).otherwise(F.col("tries")),
            "zone_from": F.when(fresh, F.col("_zs")).otherwise(F.least("zone_from", "_zs")),
            "zone_to": F.when(fresh, F.col("_ze")).otherwise(F.greatest("zone_to", "_ze")),
        }
    ).withColumn("through", ~F.col("known") | F.col("_zs").isNull())
    mean = F.aggregate("words", F.lit(0.0), lambda a, w: a + w["prob"]) / F.size("words")
    asked = got.where(F.size("words") > 0).withColumn("_p", mean).join(rows.select(key, F.col("_zs").alias("_t")), key).where((F.col("_p") >= s.sure) & (F.col("start") < F.col("_t")))
    asked = asked.withColumn("_hop", F.floor((F.col("_t") - F.col("start")) / s.back)).where(F.col("_hop") < s.hops)
    anchors = asked.groupBy(key).agg(F.min(F.struct("_hop", "seg", "end")).alias("_a")).select(key, F.col("_a.seg").alias("anchor"), F.col("_a.end").alias("anchor_end"))
    rows = rows.join(anchors, key, "left")
    return rows.withColumn("again", ~F.col("through") & F.col("anchor").isNotNull() & (F.col("tries") < s.tries)).drop("_first", "_last", "_n", "_zs", "_ze")


def _skips(lost: DataFrame, original: DataFrame, key: str, s: ControlSettings) -> DataFrame:
    """lost (key, start, text, zone_to, matched, top) with first, cut, behind (ids of the transcript; first is null if nothing lies near), ceiling, begins, said, rest and ends."""
    zone_end = F.least(F.greatest("zone_to", F.col("start") + s.least_skip), F.col("start") + s.most_skip)
    lost = lost.withColumn("_ze", zone_end)
    seen = original.select(key, "id", F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("text").alias("_t")).join(lost, key)

    def near(radius: float) -> Column:
        inside = (F.col("_s") < F.col("start") + radius) & (F.col("_e") > F.greatest(F.col("matched"), F.col("start") - radius))
        return F.array_sort(F.collect_list(F.when(inside, F.struct("id", F.col("_t").alias("t")))))

    looks = seen.groupBy(key).agg(F.min(F.when(F.col("_s") >= F.col("_ze"), F.col("id"))).alias("_behind"), *[near(r).alias(f"_near{i}") for i, r in enumerate(s.radii())])
    rows = lost.join(looks, key, "left")
    probe = F.substring("text", 1, s.probe)
    at = [F.instr(F.array_join(F.transform(f"_near{i}", lambda x: x["t"]), s.joiner), probe) - 1 for i in range(s.looks)]
    found, where = F.lit(0), F.col(f"_near{s.looks - 1}")
    for i in reversed(range(s.looks)):
        found, where = F.when(at[i] >= 0, at[i]).otherwise(found), F.when(at[i] >= 0, F.col(f"_near{i}")).otherwise(where)
    rows = rows.withColumns({"_at": found, "_near": where})
    step = F.length(F.lit(s.joiner)) if s.joiner else F.lit(0)
    walked = F.aggregate(  # the segment in which the place lies, and how far in it
        F.slice("_near", 1, F.greatest(F.size("_near") - 1, F.lit(0))),
        F.struct(F.col("_at").alias("at"), F.lit(0).alias("i"), F.lit(False).alias("ends")),
        lambda a, x: F.when(a["ends"] | (a["at"] < F.length(x["t"]) + step), F.struct(a["at"].alias("at"), a["i"].alias("i"), F.lit(True).alias("ends"))).otherwise(
            F.struct((a["at"] - F.length(x["t"]) - step).alias("at"), (a["i"] + 1).alias("i"), F.lit(False).alias("ends"))
        ),
    )
    rows = rows.withColumn("_w", walked).withColumns({"first": F.when(F.size("_near") > 0, F.try_element_at("_near", F.col("_w.i") + 1)["id"]), "cut": F.col("_w.at")})
    last = original.groupBy(key).agg((F.max("id") + 1).alias("_beyond"))
    rows = rows.join(last, key).withColumn("behind", F.greatest(F.coalesce("_behind", "_beyond"), F.coalesce(F.col("first") + 1, F.lit(0))))
    kept = rows.select(key, "start", "top", "first", "cut", "behind", "_beyond")
    parts = original.select(key, "id", F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("text").alias("_t")).join(kept, key)
    whole = (F.col("id") >= F.col("first")) & (F.col("id") < F.col("behind"))
    said = F.when(whole, F.struct("id", F.when(F.col("id") == F.col("first"), F.substring(F.col("_t"), F.col("cut") + 1, F.length("_t"))).otherwise(F.col("_t")).alias("t")))
    text = lambda c: F.array_join(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["t"]), s.joiner)
    begins = F.when(F.col("cut") > 0, F.least(F.greatest("top", "start"), "_e")).otherwise(F.col("_s"))
    made = parts.groupBy(key).agg(
        text(said).alias("said"),
        text(F.when(F.col("id") >= F.col("behind"), F.struct("id", F.col("_t").alias("t")))).alias("rest"),
        F.max(F.when(F.col("id") == F.col("first"), F.greatest(F.col("top"), begins))).alias("begins"),
        F.max(F.when(F.col("id") == F.col("behind"), F.col("_s"))).alias("ceiling"),
        F.max(F.when(F.col("id") == F.col("behind") - 1, F.when((F.col("id") == F.col("first")) & (F.col("cut") > 0), F.greatest("top", "_e")).otherwise(F.col("_e")))).alias("ends"),
    )
    return rows.select(*lost.columns, "first", "behind", (F.col("behind") < F.col("_beyond")).alias("more")).join(made, key)


def recovered(original: DataFrame, model: Callable[[DataFrame], DataFrame], key: str = "entry", settings: ControlSettings = ControlSettings()) -> DataFrame:
    """(key, piece, start, end, text, words): the aligned segments of every entry, in order of piece.

    original: (key, id, start, end, text), the transcript's segments with rough times, ids from 0 without gaps, in order of start. model: requests (key, start, stop, text) to segments
    (key, seg, start, end, text, words), whose texts, joined, are the request's. A step is a few joins over the entries that are not through; it costs two calls of the model.
    """
    s, spark = settings, original.sparkSession
    original = cut(original.select(key, "id", "start", "end", "text"))
    state = _joined(original, key, "id", s).where("text != ''").withColumns(
        {"start": F.lit(0.0), "zone_from": F.lit(0.0), "zone_to": F.lit(0.0), "tries": F.lit(0), "matched": F.lit(0.0), "top": F.lit(0.0)}
    )
    state, pieces, turn = cut(state), [], 0
    while not state.isEmpty():
        got = cut(model(state.select(key, "start", F.lit(None).cast("double").alias("stop"), "text")))
        judged = cut(_judged(state, got, key, s))
        settled = got.join(judged.select(key, "known", "through", "anchor"), key).where("known and (through or seg <= anchor)")
        pieces.append(settled.select(key, F.lit(turn).alias("turn"), "seg", "start", "end", "text", "words"))
        left = judged.where("not through")
        rest = got.join(left.where("anchor is not null").select(key, "anchor"), key).where("seg > anchor")
        left = left.join(_joined(rest, key, "seg", s, "_rest"), key, "left")
        back = F.col("anchor").isNotNull()
        left = left.withColumns({"text": F.when(back, F.coalesce("_rest", F.lit(""))).otherwise(F.col("text")), "top": F.coalesce("anchor_end", "top"), "start": F.coalesce("anchor_end", "start")})
        left = cut(left.select(*state.columns, "again"))
        again = left.where("again").withColumn("tries", F.col("tries") + 1)
        skips = cut(_skips(left.where("not again").drop("again"), original, key, s))
        asked = skips.where("first is not null").select(key, F.col("begins").alias("start"), F.col("ceiling").alias("stop"), F.col("said").alias("text"))
        filled = model(asked).join(skips.select(key, "top", "ceiling"), key)
        inside = lambda w: clamp_range(w["start"], w["end"], F.col("top"), F.col("ceiling"))
        words = F.transform("words", lambda w: F.struct(w["word"].alias("word"), inside(w)[0].alias("start"), inside(w)[1].alias("end"), w["prob"].alias("prob")))
        filled = filled.withColumn("words", words).withColumns({"start": F.coalesce(F.array_min(F.transform("words", lambda w: w["start"])), "start"), "end": F.coalesce(F.array_max(F.transform("words", lambda w: w["end"])), "end")})
        filled = cut(filled.select(key, F.lit(turn + 1).alias("turn"), "seg", "start", "end", "text", "words"))
        pieces.append(filled)
        tops = filled.groupBy(key).agg(F.max_by("end", "seg").alias("_top"))
        on = skips.where("more").join(tops, key, "left").select(
            key, F.col("rest").alias("text"), F.col("ceiling").alias("start"), F.lit(0.0).alias("zone_from"), F.lit(0.0).alias("zone_to"), F.lit(0).alias("tries"), F.coalesce("ends", "matched").alias("matched"), F.coalesce("_top", "top").alias("top")
        )
        state, turn = cut(again.select(*state.columns).unionByName(on.select(*state.columns)).where("text != ''")), turn + 2
    if not pieces:
        return spark.createDataFrame([], f"`{key}` {dict(original.dtypes)[key]}, piece int, start double, end double, text string, words {WORDS}")
    every = pieces[0]
    for p in pieces[1:]:
        every = every.unionByName(p)
    return every.withColumn("piece", F.row_number().over(W.partitionBy(key).orderBy("turn", "seg")) - 1).select(key, "piece", "start", "end", "text", "words")


def recovered_by_entry(original: DataFrame, voice: Callable[[object], Callable[[float, float | None, str], Iterable[Segment]]], key: str = "entry", settings: ControlSettings = ControlSettings()) -> DataFrame:
    """recovered for an aligner of one text that voice gives for a key: entries are shared out among tasks, each of which sees one entry at a time.

    Segments and words must come in order of time, their texts, joined, be the request's; they may come one by one, and what lies behind a zone of confusion isn't drawn. So an entry costs its zones,
    not its zones times its length.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        whole = [{"start": a, "end": b, "text": x} for a, b, x in zip(pdf["start"].tolist(), pdf["end"].tolist(), pdf["text"], strict=True)]
        out = align_with_recovery(whole, voice(pdf[key].iloc[0]), settings, heard_in_order)
        rows = [(pdf[key].iloc[0], i, x["start"], x["end"], x["text"], [dict(zip(("word", "start", "end", "prob"), w, strict=True)) for w in x["words"]]) for i, x in enumerate(out)]
        return pd.DataFrame(rows, columns=[key, "piece", "start", "end", "text", "words"])

    schema = f"`{key}` {dict(original.dtypes)[key]}, piece int, start double, end double, text string, words {WORDS}"
    return original.select(key, "id", "start", "end", "text").groupBy(key).applyInPandas(run, schema)
