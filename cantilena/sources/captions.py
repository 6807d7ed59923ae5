"""Caption files: WebVTT and broadcast subtitle captions, as DataFrame functions over (path, content)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

from ..functions.text import clean_for_alignment, clock_seconds, frame_clock_seconds

# Fixed value: the format's cue times.
_CUE = r"(\d{1,2}:\d{2}:\d{2}\.\d{3})\s*-->\s*(\d{1,2}:\d{2}:\d{2}\.\d{3})"


def vtt_segments(files: DataFrame) -> DataFrame:
    """(path, id, start, end, text) of WebVTT cues: of each block the first line with cue times, and the lines below it, joined by spaces.
    Cues without hours are left out, and so are header and NOTE lines above the times."""
    text = F.regexp_replace(F.regexp_replace("content", "^﻿", ""), "\r\n?", "\n")
    blocks = files.select("path", F.posexplode(F.split(text, r"\n[ \t]*\n")).alias("_at", "_b"))
    lines = F.filter(F.split("_b", "\n"), lambda x: F.trim(x) != "")
    times = F.transform("_l", lambda x, i: F.when(x.rlike(_CUE) & ~x.rlike(r"(?i)^\s*(WEBVTT|NOTE)"), i))
    blocks = blocks.withColumn("_l", lines).withColumn("_t", F.array_min(F.filter(times, lambda i: i.isNotNull()))).where("_t is not null")
    cue = F.get("_l", F.col("_t"))
    body = F.slice("_l", F.col("_t") + 2, F.size("_l"))
    said = F.concat(F.lit(" "), F.array_join(F.transform(body, F.trim), " "))
    rows = blocks.select("path", "_at", clock_seconds(F.regexp_extract(cue, _CUE, 1)).alias("start"), clock_seconds(F.regexp_extract(cue, _CUE, 2)).alias("end"), clean_for_alignment(said).alias("text"))
    return rows.select("path", (F.row_number().over(W.partitionBy("path").orderBy("_at")) - 1).alias("id"), "start", "end", "text")


def vtt_time_index(segments: DataFrame) -> DataFrame:
    """(path, start_loc, end_loc, timestamp): where each cue lies in the joined text; times in whole seconds, in order of time."""
    w = W.partitionBy("path").orderBy("id")
    end = F.sum(F.length("text")).over(w.rowsBetween(W.unboundedPreceding, 0))
    return segments.select("path", (end - F.length("text")).alias("start_loc"), end.alias("end_loc"), F.floor("start").cast("double").alias("timestamp"), "id")


@F.pandas_udf(StringType())
def decoded(content: pd.Series) -> pd.Series:
    """Bytes as text: by their byte order mark, else as UTF-8 if they are that, else as Hebrew Windows text."""

    def text(raw: bytes | None) -> str | None:
        if raw is None:
            return None
        if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
            return raw.decode("utf-16", "replace")
        try:
            return raw.decode("utf-8-sig")
        except UnicodeDecodeError:
            return raw.decode("cp1255", "replace")

    return content.map(text)


def subtitle_rows(files: DataFrame, *, fps: int = 25, offset: float = 3600.0) -> DataFrame:
    """(path, at, start_time, end_time, text) of broadcast subtitles: a line of two frame clocks between the begin and end marks, then one or
    two lines of text. Programme time begins offset seconds into the tape."""
    lines = files.select("path", F.posexplode(F.split(F.regexp_replace("content", "\r", ""), "\n")).alias("at", "line"))
    w = W.partitionBy("path").orderBy("at")
    mark = F.when(F.lower("line").contains("<begin subtitles>"), 1).when(F.lower("line").contains("<end subtitles>"), -1).otherwise(0)
    clock = r"^\s*(\d{2}:\d{2}:\d{2}:\d{2})\s+(\d{2}:\d{2}:\d{2}:\d{2})"
    rows = lines.withColumns({"_in": F.sum(mark).over(w.rowsBetween(W.unboundedPreceding, 0)), "_a": F.lead("line", 1, "").over(w), "_b": F.lead("line", 2, "").over(w)})
    rows = rows.where((F.col("_in") > 0) & F.col("line").rlike(clock))
    second = F.when((F.trim("_b") != "") & ~F.col("_b").rlike(clock) & ~F.lower("_b").contains("<end subtitles>"), F.concat(F.lit(" "), F.trim("_b"))).otherwise("")
    return rows.select("path", "at", (frame_clock_seconds(F.regexp_extract("line", clock, 1), fps) - offset).alias("start_time"), (frame_clock_seconds(F.regexp_extract("line", clock, 2), fps) - offset).alias("end_time"), F.concat(F.trim("_a"), second).alias("text"))
