"""Sinks: manifests, captions, frames, per-entry documents and published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import seconds_clock, seconds_clock_whole
from ..operators.relational import manifest


def write_manifest(entries: DataFrame, columns: list[str], path: str, files: int | None = None) -> None:
    """CSV with fixed columns; missing ones are empty, nested ones JSON. files: at most so many files; None: as many as there are tasks."""
    out = manifest([entries], columns)
    out = out.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in out.dtypes])
    (out if files is None else out.coalesce(files)).write.csv(path, header=True, mode="overwrite")


def write_time_index(index: DataFrame, path: str) -> None:
    index.select("start_loc", "end_loc", "timestamp").write.csv(path, header=True, mode="overwrite")


def write_entries(rows: DataFrame, path: str, keys: tuple[str, ...] = ("source", "episode")) -> None:
    """A JSON document for each row, in directories of its keys."""
    rows.write.partitionBy(*keys).json(path, mode="overwrite")


def vtt_text(captions: DataFrame, keys: list[str], *, whole_seconds: bool = False) -> DataFrame:
    """(keys, content): captions (keys, start, end, text) as WebVTT."""
    clock = seconds_clock_whole if whole_seconds else seconds_clock
    cue = F.concat(clock(F.col("start")), F.lit(" --> "), clock(F.col("end")), F.lit("\n"), F.col("text"))
    cues = F.array_sort(F.collect_list(F.struct("start", "end", cue.alias("cue"))))
    return captions.groupBy(*keys).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(cues, lambda c: c["cue"]), "\n\n"), F.lit("\n")).alias("content"))


def frame_text(frames: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, content): a probability with four digits a line, in order."""
    lines = F.array_sort(F.collect_list(F.struct("frame_idx", F.format_string("%.4f", "prob").alias("line"))))
    return frames.groupBy(*keys).agg(F.concat(F.array_join(F.transform(lines, lambda x: x["line"]), "\n"), F.lit("\n")).alias("content"))


def publish(rows: DataFrame, path: str, split: str | None = None) -> None:
    """Parquet, by split if there is one."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(split) if split else writer).parquet(path)
