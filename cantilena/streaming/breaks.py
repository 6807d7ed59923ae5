"""When an aligner that commits words must give up, told while the words keep coming: too many bad ones, or none for too long.

Words wait in the state until the watermark has passed them, so they are judged in order whatever order they came in, and each key has one event-time
timer: for the first word that waits, or for the silence behind the last one. A key that falls silent is woken by it without any further row of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .words import window_step

Word = tuple[float, float, float]  # end, duration, prob


@dataclass(frozen=True)
class BreakSettings:
    span: float = 120.0
    warm_up: float = 10.0
    limit: float = 0.8
    silence: float = 60.0


@dataclass
class Watch:
    """One key: the words of the trailing window, the last time heard, words that wait, and the break if there was one."""

    held: list[Word]
    last: float | None
    waiting: list[Word]
    broken: bool = False

    def advance(self, upto: float, settings: BreakSettings) -> tuple[float, str] | None:
        """Judges the words that ended before upto, in order; the first break, after which the key is done."""
        ready = sorted((w for w in self.waiting if w[0] < upto), key=lambda w: w[0])
        self.waiting = [w for w in self.waiting if w[0] >= upto]
        found, i = None, 0
        while i < len(ready) and not found:
            end = ready[i][0]
            j = next((k for k in range(i, len(ready)) if ready[k][0] != end), len(ready))
            if self.last is not None and end - self.last > settings.silence:
                found = (self.last + settings.silence, "silence")
                break
            said = [w for w in ready[i:j] if w[2] == w[2]]  # others only tell how far the audio was heard
            if said:
                self.held, rows = window_step(self.held, said, settings.span, settings.warm_up)
                ratio = rows[-1][1]
                if ratio is not None and ratio > settings.limit:
                    found = (end, "ratio")
            if said or self.last is None:
                self.last = end
            i = j
        if not found and self.last is not None and upto - self.last > settings.silence:
            found = (self.last + settings.silence, "silence")
        if found:
            self.held, self.waiting, self.broken = [], [], True
        return found

    def wakes_at(self, settings: BreakSettings) -> float | None:
        times = [w[0] for w in self.waiting] + ([] if self.last is None else [self.last + settings.silence])
        return None if self.broken or not times else min(times)


_COLUMNS = ("ends", "durations", "probs")


def _columns(words: Sequence[Word]) -> list[list[float]]:
    return [[float(w[i]) for w in words] for i in range(3)]


def break_stream(words: DataFrame, key: str = "entry", *, ts: str = "ts", late: str = "30 seconds", settings: BreakSettings = BreakSettings()) -> DataFrame:
    """(key, at, reason) once for each key of a stream that breaks: first_break of the words so far, "ratio" or "silence", as soon as the watermark tells it.

    words: (key, ts, duration, prob); ts is a word's end as a timestamp, and a row without prob says that the audio was heard until then and held no word. Words later than
    the watermark (`late` behind the newest ts of the stream) are dropped. Nothing follows a key's break. State holds a window and the words that wait.
    """
    kind = dict(words.dtypes)[key]
    rows = words.where(F.col(ts).isNotNull()).withWatermark(ts, late).select(key, ts, (F.unix_micros(ts) / 1e6).alias("end"), "duration", "prob")

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watch = Watch([], None, [])
        if state.exists:
            got = state.get
            last = got[6]
            watch = Watch(list(zip(*got[:3], strict=True)), None if last is None or math.isnan(last) else last, list(zip(*got[3:6], strict=True)), bool(got[7]))
        now = state.getCurrentWatermarkMs()
        if not state.hasTimedOut and not watch.broken:
            for pdf in frames:
                new = zip(pdf["end"], pdf["duration"].fillna(0.0), pdf["prob"].astype(float), strict=True)
                watch.waiting += [w for w in new if w[0] >= now / 1000]
        found = None if watch.broken else watch.advance(now / 1000, settings)
        state.update((*_columns(watch.held), *_columns(watch.waiting), math.nan if watch.last is None else watch.last, watch.broken))
        wakes = watch.wakes_at(settings)
        if wakes is not None:
            state.setTimeoutTimestamp(max(int(wakes * 1000), now + 1))
        if found:
            yield pd.DataFrame({key: [group[0]], "at": [found[0]], "reason": [found[1]]})

    arrays = ", ".join([*(f"{c} array<double>" for c in _COLUMNS), *(f"waiting_{c} array<double>" for c in _COLUMNS)])
    return rows.groupBy(key).applyInPandasWithState(run, f"`{key}` {kind}, at double, reason string", f"{arrays}, last double, broken boolean", "append", GroupStateTimeout.EventTimeTimeout)
