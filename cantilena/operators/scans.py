"""Operators that go along an entry from begin to end without ever holding all of it.

The jump-capped repair of times is a scan: what a stretch of an entry does to any time that comes into it is a function of few pieces, and functions of
stretches can be put together without walking the entry. Speech ranges take a stretch of every entry a round and hand on where the next slice begins.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import cut
from .sequential import VadSettings, silences

#: (from, shifts, value): from there on, up to the next piece, a time becomes the value, or moves on by it if shifts.
Pieces = list[tuple[float, bool, float]]
SAME: Pieces = [(-math.inf, True, 0.0)]
#: Times that a pointer looks ahead for: its next but one, and every second one up to so many places on.
AHEAD = 8


def value_at(pieces: Pieces, time: float) -> float:
    _, shifts, value = pieces[bisect.bisect_right(pieces, time, key=lambda p: p[0]) - 1]
    return time + value if shifts else value


def step_pieces(x: float, ahead: Sequence[float], most: float) -> Pieces:
    """What a pointer of time x makes of the time before it: no step back, and none over most unless what follows agrees with it."""
    kept = [(x - most, False, x), (x, True, 0.0)]
    if len(ahead):
        middle = float(np.median(ahead))
        back = 2 * middle - x  # times before that lie farther from the middle than x does
        return [(-math.inf, False, x), *([(back, True, most)] if back < x - most else []), *kept]
    near = math.nextafter(x - 2 * most, math.inf)  # nothing follows: x itself must lie within twice the most
    return [(-math.inf, True, most), *([(near, False, x)] if near < x - most else []), *kept]


def composed(first: Pieces, then: Pieces) -> Pieces:
    """then after first."""
    out: Pieces = []
    for i, (lo, shifts, value) in enumerate(first):
        hi = first[i + 1][0] if i + 1 < len(first) else math.inf
        if not shifts:
            made = [(lo, False, value_at(then, value))]
        else:
            k = max(0, bisect.bisect_right(then, lo + value, key=lambda p: p[0]) - 1)
            made = []
            for at, moves, v in then[k:]:
                begin = max(lo, at - value)
                if begin >= hi:
                    break
                made.append((begin, moves, value + v if moves else v))
        for piece in made:
            if out and out[-1][0] == piece[0]:
                out[-1] = piece
            elif not out or out[-1][1:] != piece[1:]:
                out.append(piece)
    return out


def repaired_by_scan(pointers: DataFrame, keys: list[str], most: float = 30.0, stretch: int = 4096) -> DataFrame:
    """Time pointers (keys, idx, sec) with repaired sec: sequential.repair_by_jumps, an entry shared by many tasks. idx numbers an entry's pointers from 0 without gaps.

    Two passes over stretches of an entry: the first makes each stretch's function, the second walks it from the time that the functions before it give. A stretch gets the few pointers behind it
    too, which it looks ahead to. Times must be numbers whose sums and doubles are exact (whole or binary fractions of seconds), or thresholds may round.
    """
    if stretch < AHEAD + 2:
        raise ValueError("a stretch must hold all that a pointer looks ahead to")
    kinds = dict(pointers.dtypes)
    rows = pointers.select(*keys, F.col("idx").cast("long").alias("idx"), F.col("sec").cast("double").alias("sec"))
    entries = rows.groupBy(*keys).agg(F.min(F.when(F.col("sec") > 0, F.struct("sec", "idx"))).alias("_m"), F.count("*").alias("_n"))
    entries = entries.select(*keys, F.when(F.col("_m").isNotNull(), F.greatest(F.col("_m.idx"), F.lit(1))).alias("first"), "_n")
    place = F.floor(F.col("idx") / stretch)
    dealt = rows.withColumn("part", F.explode(F.when((F.col("idx") % stretch < AHEAD + 2) & (F.col("idx") >= stretch), F.array(place - 1, place)).otherwise(F.array(place))))
    dealt = cut(dealt.join(entries, keys))

    def steps(pdf: pd.DataFrame):
        """The stretch's own pointers, and a function that gives the pieces that lead to pointer i (its number in the stretch)."""
        pdf = pdf.sort_values("idx")
        x, base = pdf["sec"].tolist(), int(pdf["part"].iloc[0]) * stretch
        return x, base, lambda i: step_pieces(x[i], x[i + 1 : i + 1 + AHEAD : 2], most)

    # The step into a pointer belongs to the stretch of the pointer before it, which sees what follows.
    def function(pdf: pd.DataFrame) -> pd.DataFrame:
        x, base, pieces = steps(pdf)
        first, whole = pdf["first"].iloc[0], SAME
        for i in range(1, min(stretch + 1, len(x))):
            if base + i > first:
                whole = composed(whole, pieces(i))
            elif base + i == first:
                whole = [(-math.inf, False, x[i])]
        if base == 0 == first:
            whole = composed([(-math.inf, False, x[0])], whole)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "part": [pdf["part"].iloc[0]], "at": [[p[0] for p in whole]], "shifts": [[p[1] for p in whole]], "value": [[p[2] for p in whole]]})

    def begins(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, time, out = pdf.sort_values("part"), 0.0, []
        for at, shifts, value in zip(pdf["at"], pdf["shifts"], pdf["value"], strict=True):
            out.append(time)
            time = value_at(list(zip(at, shifts, value, strict=True)), time)
        return pdf[[*keys, "part"]].assign(begin=out)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        x, base, pieces = steps(pdf)
        first, n, time, out = pdf["first"].iloc[0], min(stretch, len(x)), float(pdf["begin"].iloc[0]), []
        for i in range(n):
            if first is None or math.isnan(first):
                time = x[i]
            elif base + i < first:
                time = 0.0
            elif base + i == first:
                time = x[i]
            elif i:
                time = value_at(pieces(i), time)
            out.append(time)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] * n for k in keys}, "idx": range(base, base + n), "sec": out})

    named = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    wide = dealt.where(F.col("first").isNotNull() & (F.col("_n") > stretch))
    functions = wide.groupBy(*keys, "part").applyInPandas(function, f"{named}, part long, at array<double>, shifts array<boolean>, value array<double>")
    known = functions.groupBy(*keys).applyInPandas(begins, f"{named}, part long, begin double")  # a row a stretch
    return dealt.join(known, [*keys, "part"], "left").withColumn("begin", F.coalesce("begin", F.lit(0.0))).groupBy(*keys, "part").applyInPandas(walk, f"{named}, idx long, sec double")


def speech_by_stretches(frames: DataFrame, keys: list[str], settings: VadSettings = VadSettings(), stretch: int = 180_000, times: str | None = None) -> DataFrame:
    """Speech ranges (keys, start, end) of frames (keys, frame_idx, prob), numbered from 0 without gaps: sequential.speech_ranges for all entries at once.

    times: a column of whole numbers, 1 at least: so many frames, from frame_idx on, have the row's prob. Runs are shuffled as rows and become frames only in the task that looks at them.

    Where a slice begins hangs on the silences of the one before, so an entry goes slice by slice; but a round takes a stretch of frames of every entry, and a slice more that its last slice may
    reach into. No task sees more of an entry than that. Rounds follow the longest entry.
    """
    s = settings
    reach, kinds = math.ceil(s.slice_seconds / s.frame) + 2, dict(frames.dtypes)
    rows = frames.select(*keys, F.col("frame_idx").cast("long").alias("frame_idx"), F.col("prob").cast("double").alias("prob"), (F.col(times) if times else F.lit(1)).cast("long").alias("times"))
    totals = cut(rows.groupBy(*keys).agg(F.sum("times").alias("n")).withColumn("total", F.col("n") * s.frame))
    state, quiet = totals.select(*keys, "total", F.lit(0.0).alias("at")), None
    last = totals.agg(F.max("n")).first()[0] or 0
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "goes_on boolean, start double, end double"])

    def slices_from(base: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for *key, at, total, first, times, prob in pdf.itertuples(index=False, name=None):
                    here = np.minimum(first + times, base + stretch + reach) - np.maximum(first, base)
                    p = np.repeat(prob, here)
                    while at < total - 1e-9 and at < (base + stretch) * s.frame:
                        end = min(at + s.slice_seconds, total)
                        found = silences(p[round(at / s.frame) - base : round(end / s.frame) - base], at, s)
                        late = [a for a, _ in found if a > end - s.overlap]
                        following = end
                        if end < total and late:  # the next slice finds the last silence again
                            found, following = found[:-1], max(late[-1] - s.shrink, at + s.overlap)
                        out += [(*key, False, a, b) for a, b in found]
                        at = following if following > at else end
                    out.append((*key, True, at, None))
                yield pd.DataFrame(out, columns=[*keys, "goes_on", "start", "end"])

        return run

    for k in range(math.ceil(last / stretch)):
        base = k * stretch
        # A slice that began in the stretch before may end in this one: what is behind `at` isn't needed, what lies before the stretch neither.
        here = rows.where((F.col("frame_idx") + F.col("times") > base) & (F.col("frame_idx") < base + stretch + reach))
        open_ = state.where((F.col("at") < F.col("total") - 1e-9) & (F.col("at") < (base + stretch) * s.frame))
        # A row an entry, so that a task makes one table of many entries.
        runs = here.join(open_, keys).groupBy(*keys).agg(F.first("at").alias("at"), F.first("total").alias("total"), F.array_sort(F.collect_list(F.struct("frame_idx", "times", "prob"))).alias("_f"))
        made = cut(runs.select(*keys, "at", "total", "_f.frame_idx", "_f.times", "_f.prob").mapInPandas(slices_from(base), schema))
        found = made.where("not goes_on").select(*keys, "start", "end")
        quiet = found if quiet is None else quiet.unionByName(found)
        state = cut(state.join(made.where("goes_on").select(*keys, F.col("start").alias("_at")), keys, "left").select(*keys, "total", F.coalesce("_at", "at").alias("at")))
    edges = totals.select(*keys, F.col("total").alias("start"), F.col("total").alias("end"))
    every = edges if quiet is None else edges.unionByName(quiet)
    before = F.max("end").over(W.partitionBy(*keys).orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    return every.withColumn("_from", F.coalesce(before, F.lit(0.0))).where("_from < start").select(*keys, F.col("_from").alias("start"), F.col("start").alias("end"))
