"""Media listings, JSON documents and tables of text files, read by Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_parts
from ..schemas import ENTRIES

#: The columns of every manifest, and their types.
ENTRY_DDL = ENTRIES
ENTRY_COLUMNS = [c.split()[0] for c in ENTRIES.split(", ")]


def media_files(spark: SparkSession, roots: list[str], extensions: list[str], skip: list[str] = ()) -> DataFrame:
    """Files below the roots with an extension, outside skipped directories: (path, size, source, episode). Contents aren't read."""
    pattern = "*.{" + ",".join(x.lstrip(".") for x in extensions) + "}"
    found = None
    for root in roots:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root).select("path", F.col("length").alias("size"))
        parts = F.slice(F.split(F.replace(F.col("path"), F.lit(root), F.lit("")), "/"), 1, F.size(F.split(F.replace(F.col("path"), F.lit(root), F.lit("")), "/")) - 1)
        if skip:
            df = df.where(~F.arrays_overlap(parts, F.array(*map(F.lit, skip))))
        found = df if found is None else found.unionByName(df)
    source, episode = path_parts(F.col("path"))
    return found.select("path", "size", source.alias("source"), episode.alias("episode"))


def json_documents(spark: SparkSession, paths: str | list[str], ddl: str, *, recursive: bool = False, glob: str = "*.json") -> DataFrame:
    """One object a file, with its path; files that aren't JSON are left out. recursive: at any depth, else where paths say."""
    read = spark.read.schema(f"{ddl}, _bad string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("pathGlobFilter", glob)
    rows = read.option("recursiveFileLookup", recursive).json(paths).select("*", F.col("_metadata.file_path").alias("path"))
    return rows.where("_bad is null").drop("_bad")


def whole_files(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """(path, content), one row a file."""
    return spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def vad_frames(spark: SparkSession, paths: str | list[str], glob: str = "*.frame") -> DataFrame:
    """(source, episode, frame_idx, prob) from files of a probability a line."""
    rows = whole_files(spark, paths, glob).select("path", F.posexplode(F.split(F.rtrim("content"), "\n")).alias("frame_idx", "_p"))
    source, episode = path_parts(F.col("path"))
    return rows.where("_p != ''").select(source.alias("source"), episode.alias("episode"), F.col("frame_idx").cast("long").alias("frame_idx"), F.col("_p").cast("double").alias("prob"))


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def object_listing(spark: SparkSession, root: str) -> DataFrame:
    """(key, modified) of the objects below a root."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return rows.select(F.replace(F.col("path"), F.lit(root.rstrip("/") + "/"), F.lit("")).alias("key"), F.col("modificationTime").alias("modified"))


def audio_info(probed: DataFrame, column: str = "probe") -> DataFrame:
    """(sample_rate, channels, duration, codec_name, format_name) of the first audio stream of a probe's JSON."""
    ddl = "streams array<struct<codec_type:string,codec_name:string,sample_rate:string,channels:int,duration:string>>, format struct<format_name:string,duration:string>"
    rows = probed.withColumn("_j", F.from_json(column, ddl)).withColumn("_s", F.get(F.filter("_j.streams", lambda s: s["codec_type"] == "audio"), F.lit(0)))
    return rows.select(
        *[c for c in probed.columns if c != column],
        F.col("_s.sample_rate").try_cast("int").alias("sample_rate"),
        F.col("_s.channels").alias("channels"),
        F.coalesce(F.col("_s.duration"), F.col("_j.format.duration")).try_cast("double").alias("duration"),
        F.col("_s.codec_name").alias("codec_name"),
        F.get(F.split("_j.format.format_name", ","), F.lit(0)).alias("format_name"),
    )
