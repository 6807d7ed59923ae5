"""How far a recording lies behind its transcript: samples are looked up in the transcript, a few an entry and round, until the estimates of an entry agree."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import cut
from .quality import t_975
from .timeline import containing, interpolated_time


@dataclass(frozen=True)
class LagSettings:
    least: int = 5  # estimates in the probable range before an entry may stop
    most: int = 35  # estimates of any kind after which it does
    width: float = 8.0  # of the 95 % interval that is narrow enough
    buffer: float = 120.0  # seconds around the expected lag that make the probable range
    batch: int = 5  # samples an entry and round


def lags_of_places(found: DataFrame, index: DataFrame, samples: DataFrame, keys: list[str], span: float = 1000.0) -> DataFrame:
    """(keys, query, lag): the time of the place that each sample was found at, less the time it begins at.

    found: (keys, query, at), places in the transcript. index: (keys, start_loc, end_loc, ts), its slices in order of start_loc. samples: (keys, query, begins). The time of a place is
    linear between its slice's and the next one's; the first slice that holds the place counts, and the last one's time is its own. Places outside all slices have no row.
    """
    order = W.partitionBy(*keys).orderBy("start_loc", "end_loc")
    slices = index.select(*keys, "start_loc", "end_loc", "ts").withColumn("next_ts", F.coalesce(F.lead("ts").over(order), "ts"))
    placed = containing(found.select(*keys, "query", "at"), slices, keys, "at", "start_loc", "end_loc", span)
    time = interpolated_time(F.col("at"), F.col("start_loc"), F.col("end_loc"), F.col("ts"), F.col("next_ts"))
    return placed.select(*keys, "query", time.alias("_time")).join(samples.select(*keys, "query", "begins"), [*keys, "query"]).select(*keys, "query", (F.col("_time") - F.col("begins")).alias("lag"))


def stopping(estimates: DataFrame, keys: list[str], settings: LagSettings = LagSettings()) -> DataFrame:
    """The state of each entry at its first draw that ends the search, else at its last: (keys, draw, n, n_all, mean, low, high, stopped).

    estimates: (keys, draw, lag, expected); a null lag is a sample that was not found. n counts those in the probable range, mean and the interval are theirs. Prefixes of all draws are
    judged at once, by running aggregates.
    """
    s, order = settings, W.partitionBy(*keys).orderBy("draw")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    inside = F.when(F.col("lag").between(F.col("expected") - s.buffer, F.col("expected") + s.buffer), F.col("lag"))
    rows = estimates.withColumn("_in", inside).withColumns({"n": F.count("_in").over(upto), "n_all": F.count("lag").over(upto), "mean": F.avg("_in").over(upto), "_sd": F.stddev_samp("_in").over(upto)})
    half = t_975(F.col("n") - 1) * F.col("_sd") / F.sqrt("n")
    rows = rows.withColumns({"low": F.col("mean") - half, "high": F.col("mean") + half})
    rows = rows.withColumn("stopped", F.coalesce((F.col("n") >= s.least) & (F.col("high") - F.col("low") <= s.width), F.lit(False)) | (F.col("n_all") >= s.most))
    picked = F.coalesce(F.min(F.when(F.col("stopped"), F.col("draw"))).over(W.partitionBy(*keys)), F.max("draw").over(W.partitionBy(*keys)))
    return rows.withColumn("_pick", picked).where("draw = _pick").select(*keys, "draw", "n", "n_all", "mean", "low", "high", "stopped")


def sequential_lags(samples: DataFrame, estimate: Callable[[DataFrame], DataFrame], expected: DataFrame, keys: list[str], settings: LagSettings = LagSettings()) -> DataFrame:
    """(keys, draws, n, lag, low, high, stopped): each entry's lag, from as few samples as its stopping rule needs.

    samples: (keys, draw, ...), numbered from 0 in the order in which they may be drawn. estimate: rows of samples to (keys, draw, lag); samples that it can't place may be left out.
    expected: (keys, expected). A round draws the next samples of all entries that are still open and estimates those alone; entries whose interval is narrow enough leave. An entry
    without an estimate in its probable range gets the expected lag.
    """
    samples, known = cut(samples), None
    open_, at = cut(expected.select(*keys, "expected").join(samples.select(*keys).distinct(), keys)), 0
    last = samples.agg(F.max("draw")).first()[0]
    while last is not None and at <= last:
        drawn = samples.where((F.col("draw") >= at) & (F.col("draw") < at + settings.batch)).join(open_, keys)
        lags = estimate(drawn.drop("expected")).select(*keys, "draw", "lag")
        new = cut(drawn.select(*keys, "draw", "expected").join(lags, [*keys, "draw"], "left"))
        known = new if known is None else cut(known.unionByName(new))
        at += settings.batch
        ended = stopping(known.join(open_.select(*keys), keys), keys, settings).where("stopped")
        open_ = cut(open_.join(ended, keys, "left_anti"))
        if open_.isEmpty():
            break
    if known is None:
        return expected.select(*keys, F.lit(0).cast("long").alias("draws"), F.lit(0).cast("long").alias("n"), F.col("expected").alias("lag"), *[F.lit(None).cast("double").alias(c) for c in ("low", "high")], F.lit(False).alias("stopped"))
    out = expected.select(*keys, "expected").join(stopping(known, keys, settings), keys, "left")
    draws: Column = F.coalesce(F.col("draw") + 1, F.lit(0)).cast("long")
    return out.select(*keys, draws.alias("draws"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mean", "expected").alias("lag"), "low", "high", F.coalesce("stopped", F.lit(False)).alias("stopped"))
