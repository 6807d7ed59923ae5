"""Whole plans: sources by name, normalising entries, models as steps. The alignment controller is in recovery.py."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import entry_scores, entry_statistics, segment_scores, zero_length
from ..operators.relational import needs_work
from ..storage import cut


class Normalizer(Protocol):
    """What a source must give, as DataFrames by entry: how it names and stores things is its own affair."""

    def entries(self, spark: SparkSession) -> DataFrame:
        """(entry, ...): a row an entry with its metadata."""

    def audio(self, spark: SparkSession) -> DataFrame:
        """(entry, path) of the entries that have audio."""

    def transcripts(self, spark: SparkSession) -> DataFrame:
        """(entry, id, start, end, text): the segments of the entries that have a transcript, ids from 0."""

    def aligned(self, spark: SparkSession) -> DataFrame:
        """(entry, piece, start, end, text, words) of earlier runs."""

    def language(self) -> Column:
        """The language, from the columns of entries."""

    def duration(self) -> Column:
        """The seconds, from the columns of entries."""

    def save_aligned(self, segments: DataFrame) -> None:
        """Keeps new segments (entry, piece, start, end, text, words)."""

    def save_entries(self, rows: DataFrame) -> None:
        """Keeps the scores and statistics of entries."""


@dataclass
class Registry:
    """Sources by name."""

    builders: dict[str, Callable[..., DataFrame]] = field(default_factory=dict)

    def add(self, name: str):
        def put(f):
            self.builders[name] = f
            return f

        return put

    def build(self, name: str, *args, **kwargs) -> DataFrame:
        if name not in self.builders:
            raise ValueError(f"unknown source {name}: one of {sorted(self.builders)}")
        return self.builders[name](*args, **kwargs)


def normalized_entries(words: DataFrame, durations: DataFrame, key: str = "entry") -> DataFrame:
    """Scores and statistics of every entry, and the scores of its segments in order."""
    parts = segment_scores(words, key).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "end", "probability"))).alias("per_segment_quality_scores"))
    return entry_scores(words, key).join(parts, key).join(entry_statistics(words, durations, key), key)


def normalize(source: Normalizer, spark: SparkSession, align: Callable[[DataFrame, DataFrame], DataFrame], *, force: bool = False, rescore: bool = False, failure_threshold: float = 0.2) -> DataFrame:
    """(entry, status, language, duration, failed, scores and statistics): every entry of a source, aligned and scored where that is needed.

    align: segments (entry, id, start, end, text) and jobs (entry, path, language) to aligned segments (entry, piece, start, end, text, words); recovery.recovered with a model is one.
    status: "aligned" anew, "rescored" from an earlier alignment, "done" before and left alone, "no audio", "no transcript", or "not aligned" if the model gave nothing. failed: too many words
    without a length. New segments and the rows of entries that were aligned or rescored are saved. Joins by entry alone: nothing is done entry by entry on the driver.
    """
    texts, before = source.transcripts(spark), source.aligned(spark)
    known = source.entries(spark).select("entry", source.language().alias("language"), source.duration().cast("double").alias("duration"))
    known = known.join(before.select("entry").distinct().withColumn("_before", F.lit(True)), "entry", "left")
    known = known.join(source.audio(spark).groupBy("entry").agg(F.min("path").alias("path")), "entry", "left").join(texts.select("entry").distinct().withColumn("_text", F.lit(True)), "entry", "left")
    anew, again = needs_work(F.col("_before"), force), needs_work(F.col("_before"), force, rescore)
    status = F.when(~again, "done").when(anew & F.col("path").isNull(), "no audio").when(anew & F.col("_text").isNull(), "no transcript").when(anew, "aligned").otherwise("rescored")
    known = cut(known.withColumn("status", status).drop("_before", "_text"))
    jobs = known.where("status = 'aligned'").select("entry", "path", "language")
    fresh = cut(align(texts.join(jobs.select("entry"), "entry", "left_semi"), jobs).select("entry", "piece", "start", "end", "text", "words"))
    used = fresh.unionByName(before.join(known.where("status = 'rescored'").select("entry"), "entry", "left_semi").select(*fresh.columns))
    words = used.select("entry", F.col("piece").alias("seg"), F.explode("words").alias("_w")).select("entry", "seg", "_w.*").withColumn("duration", F.col("end") - F.col("start"))
    scored = normalized_entries(words, known.select("entry", "duration")).join(zero_length(words, threshold=failure_threshold).select("entry", "failed"), "entry")
    rows = known.drop("path").join(scored, "entry", "left")
    lost = (F.col("status") == "aligned") & F.col("quality_score").isNull()
    rows = cut(rows.withColumn("status", F.when(lost, "not aligned").otherwise(F.col("status"))))
    source.save_aligned(fresh)
    source.save_entries(rows.where(F.col("status").isin("aligned", "rescored")))
    return rows


def retried(call: Callable, tries: int = 3, wait: float = 1.0, on: tuple[type[Exception], ...] = (OSError,)) -> Callable:
    """call, called again if it fails with one of those errors, tries times at most; each wait is twice the last. For services behind a model or a feed."""

    @functools.wraps(call)
    def run(*args, **how):
        for k in range(tries):
            try:
                return call(*args, **how)
            except on:
                if k + 1 == tries:
                    raise
                time.sleep(wait * 2**k)

    return run


def modelled(rows: DataFrame, schema: str, model: Callable, **options) -> DataFrame:
    """rows through a model: a function of an iterator of pandas batches, made on the executors by model(**options)."""

    def run(batches):
        yield from model(**options)(batches)

    return rows.mapInPandas(run, schema)


from .recovery import Aligner, ControlSettings, Segment, align_with_recovery, recovered  # noqa: E402, F401
