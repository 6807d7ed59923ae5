"""Incremental forms: the trailing word window with state, new entries only, and event-time windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BAD, LEAST = 0.4, 0.1


def window_step(held: list[tuple[float, float, float]], new: list[tuple[float, float, float]], span: float, warm_up: float) -> tuple[list[tuple[float, float, float]], list[tuple]]:
    """held and new: (end, duration, prob) in order. The words still held, and (end, ratio, mean_prob) for each new one."""
    out = []
    i = 0
    while i < len(new):
        j = i
        while j < len(new) and new[j][0] == new[i][0]:  # words that end together see each other
            j += 1
        held = [w for w in held if w[0] >= new[i][0] - span] + new[i:j]
        total = sum(max(LEAST, d) for _, d, _ in held)
        if total >= warm_up:
            bad, good = sum(max(d, LEAST) for _, d, p in held if p < BAD), sum(d for _, d, p in held if p >= BAD)
            row = (bad / good if good else float("inf"), sum(p for *_, p in held) / len(held))
        else:
            row = (None, None)
        out += [(w[0], *row) for w in new[i:j]]
        i = j
    return held, out


def word_window_stream(words: DataFrame, key: str = "entry", *, span: float = 120.0, warm_up: float = 10.0, limit: float = 0.8) -> DataFrame:
    """A stream of words (key, end, duration, prob) with the ratio and mean probability of the trailing window, and broken: over the limit; state holds a window a key.

    Words of a key must come in order from batch to batch; inside a batch they are sorted.
    """
    kind = dict(words.dtypes)[key]

    def run(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("end", kind="stable")
        held = list(zip(*state.get, strict=True)) if state.exists else []
        held, out = window_step(held, list(zip(rows["end"], rows["duration"], rows["prob"], strict=True)), span, warm_up)
        state.update(tuple([float(w[i]) for w in held] for i in range(3)))
        got = pd.DataFrame(out, columns=["end", "ratio", "mean_prob"]).astype("float64")
        got.insert(0, key, [group[0]] * len(got))
        yield got.assign(broken=got["ratio"] > limit)

    schema = f"`{key}` {kind}, end double, ratio double, mean_prob double, broken boolean"
    return words.groupBy(key).applyInPandasWithState(run, schema, "ends array<double>, durations array<double>, probs array<double>", "append", GroupStateTimeout.NoTimeout)


def process_new(spark: SparkSession, source: str, ddl: str, sink: Callable[[DataFrame, int], None], checkpoint: str, fmt: str = "parquet") -> None:
    """Everything that came to a folder since the last call, in one go; the checkpoint remembers what is done."""
    stream = spark.readStream.schema(ddl).format(fmt).load(source)
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def tumbling(events: DataFrame, ts: str, length: str, *aggregates: Column, late: str | None = None) -> DataFrame:
    rows = events.withWatermark(ts, late) if late else events
    out = rows.groupBy(F.window(ts, length).alias("w")).agg(*aggregates)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *[c for c in out.columns if c != "w"])


def sliding(events: DataFrame, keys: list[str], ts: str, length: str, hop: str, *aggregates: Column, late: str | None = None) -> DataFrame:
    events = events.withWatermark(ts, late) if late else events
    out = events.groupBy(*keys, F.window(ts, length, hop).alias("w")).agg(*aggregates)
    return out.select(*keys, F.col("w.start").alias("window_start"), *[c for c in out.columns if c not in (*keys, "w")])


def sessions(events: DataFrame, keys: list[str], ts: str, gap: str, *aggregates: Column, late: str | None = None) -> DataFrame:
    events = events.withWatermark(ts, late) if late else events
    out = events.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(*aggregates)
    return out.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *[c for c in out.columns if c not in (*keys, "w")])


def without_repeats(events: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """A stream's events, each key once within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)
