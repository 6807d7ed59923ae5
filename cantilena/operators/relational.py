"""Joins, filters, aggregates and set operations over corpus tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import cut


def pending(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs whose output doesn't exist yet."""
    return inputs.join(done, keys, "left_anti")


def with_any(inputs: DataFrame, *others: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs with the column found: whether any of the others holds the keys."""
    every = others[0].select(*keys)
    for o in others[1:]:
        every = every.unionByName(o.select(*keys))
    return inputs.join(every.distinct().withColumn("found", F.lit(True)), keys, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def complete_entries(media: DataFrame, index: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Entries with media, an index and at least one part; the parts are counted."""
    return media.join(index, key).join(parts.groupBy(key).agg(F.count("*").alias("n_parts")), key)


def lookup_first(rows: DataFrame, table: DataFrame, key: str, order: str) -> DataFrame:
    """Each row with the first match of its key by order; rows without one go."""
    values = [c for c in table.columns if c != key]
    first = table.groupBy(key).agg(F.min_by(F.struct(*values), order).alias("_v")).select(key, "_v.*")
    return rows.join(first, key)


def sidecar(files: DataFrame, descriptions: DataFrame, directory: str = "dir", segment: str = "segment") -> DataFrame:
    """Split files with their span, by the place in the description of their directory."""
    spans = descriptions.select(directory, F.posexplode("splits").alias(segment, "_s")).select(directory, segment, F.element_at("_s", 1).alias("start"), F.element_at("_s", 2).alias("end"))
    return files.join(spans, [directory, segment], "left")


def session_rows(sessions: DataFrame, documents: DataFrame, users: DataFrame, languages: list[str], status: str = "uploaded") -> DataFrame:
    """Sessions with their document and user, in the languages wanted, oldest first."""
    out = sessions.join(documents, "document_id", "left").join(users, "user_id", "left")
    return out.where((F.col("status") == status) & F.col("lang").isin(languages)).orderBy("created_at", "id")


def language_or_error(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    known = F.col(column).isin(allowed)
    return df.withColumn(column, F.when(known, F.col(column)).otherwise(F.raise_error(F.concat(F.lit("language not supported: "), F.coalesce(F.col(column), F.lit("null")))).cast("string")))


def only_ids(df: DataFrame, column: str, ids: list) -> DataFrame:
    """Rows of the ids; all rows if none are given."""
    return df.where(F.col(column).isin(ids)) if ids else df


def needs_work(exists: Column, force: bool = False, rescore: bool = False) -> Column:
    return ~F.coalesce(exists, F.lit(False)) | F.lit(force or rescore)


def curated(rows: DataFrame, *, drop_source: str | None, test_sources: list[str], split: str) -> DataFrame:
    """Labelled rows for a split: not skipped, not to be redone, not of the dropped source; sources belong to one split."""
    out = rows.where(~F.coalesce(F.col("skipped"), F.lit(False)))
    out = out.where(F.col("attributes").isNull() | ~F.array_contains("attributes", "retranscribe"))
    if drop_source is not None:
        out = out.where(F.col("source") != drop_source)
    return out.where(F.col("source").isin(test_sources) == F.lit(split == "test"))


def uuid_of(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def joined_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), " ")


def source_statistics(rows: DataFrame) -> DataFrame:
    """rows: (source, splits), splits an array of (start, end). Totals, counts, summed and longest durations by source, all combined before
    the shuffle; split_durations has the durations themselves."""
    last = F.when(F.size("splits") > 0, F.element_at("splits", -1)["end"]).otherwise(0.0)
    durations = F.transform("splits", lambda s: s["end"] - s["start"])
    summed = F.aggregate(durations, F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("source").agg(F.sum(last).alias("total"), F.count("*").alias("episodes"), F.sum(F.size("splits")).alias("segments"), F.sum(summed).alias("duration"), F.max(F.array_max(durations)).alias("longest"))


def split_durations(rows: DataFrame) -> DataFrame:
    """(source, duration), one row a split: a source's list of durations without gathering it in one row."""
    return rows.select("source", F.explode("splits").alias("_s")).select("source", (F.col("_s.end") - F.col("_s.start")).alias("duration"))


def coverage(files: DataFrame, hours: Column, covered: Column) -> DataFrame:
    """Files and hours, those covered, and the share; null share without hours."""
    out = files.agg(F.count("*").alias("files"), F.count_if(covered).alias("covered_files"), F.sum(hours).alias("hours"), F.sum(F.when(covered, hours)).alias("covered_hours"))
    return out.withColumn("percent", F.try_divide(F.col("covered_hours") * 100, F.col("hours")))


def best_media(files: DataFrame, key: str, path: str = "path", size: str = "size") -> DataFrame:
    """A group's largest mp4, or its largest file without one; the lesser path of equals."""
    rank = F.struct(F.lower(F.col(path)).endswith(".mp4").alias("mp4"), F.col(size).alias("size"))
    best = files.groupBy(key).agg(F.max(rank).alias("_best"))
    return files.join(best, key).where((F.col("_best.mp4") == F.lower(F.col(path)).endswith(".mp4")) & (F.col("_best.size") == F.col(size))).groupBy(key).agg(F.min(path).alias(path), F.first(size).alias(size))


def earliest(rows: DataFrame, key: str, time: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(time).alias(time)).orderBy(time, key)


def keep_first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first by order: deterministic, unlike dropDuplicates. Spark limits the window's groups before the shuffle too, so a
    key sends one row from each task, however many rows it has."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def batches(rows: DataFrame, order: list[Column], size: int, partitions: str | None = None) -> DataFrame:
    """rows with batch: runs of size rows, inside each value of partitions if given. order must be total."""
    nth = numbered(rows, order) if partitions is None else rows.withColumn("_at", F.row_number().over(W.partitionBy(partitions).orderBy(*order)) - 1)
    return nth.withColumn("batch", F.floor(F.col("_at") / size)).drop("_at")


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """rows with _at, their place from 0 in the whole order: places inside ranges of the order, and the counts of the ranges before."""
    ranged = cut(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counted = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # a row a task
    before = counted.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_before"))
    placed = ranged.withColumn("_in", F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1)
    return placed.join(before, "_range").withColumn("_at", F.col("_before") + F.col("_in")).drop("_range", "_in", "_before")


def union_splits(**named: DataFrame) -> DataFrame:
    """One table with the column split."""
    out = None
    for name, df in named.items():
        df = df.withColumn("split", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def manifest(tables: list[DataFrame], columns: list[str]) -> DataFrame:
    """Tables with different columns as one with fixed columns; missing ones are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns])


def ordered_concat(rows: DataFrame, key: str, order: str, text: str, separator: str = "") -> DataFrame:
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), separator).alias(text))


def descendants(items: DataFrame) -> DataFrame:
    """items (id, parent, title, url): leaves (root, id, title, url), however deep. Items that no root leads to, those on a cycle among
    them, go.

    Each round doubles the distance that an item's pointer reaches, so 20 rounds serve a depth of a million; every round is written.
    """
    parents = items.where("parent is not null").select(F.col("parent").alias("id")).distinct()
    up = cut(items.select("id", "title", "url", F.coalesce("parent", "id").alias("up"), F.col("parent").isNull().alias("done")))
    open_before = -1
    while (still := up.where("not done").count()) not in (0, open_before):
        further = up.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("done").alias("_done"))
        moved = up.where("not done").join(further, "up").select("id", "title", "url", F.col("_up").alias("up"), F.col("_done").alias("done"))
        up, open_before = cut(up.where("done").unionByName(moved)), still
    return up.where("done").join(parents, "id", "left_anti").select(F.col("up").alias("root"), "id", "title", "url")


def enclosure(links: Column) -> Column:
    """The one link with rel = enclosure; null without one; several raise an error."""
    found = F.filter(links, lambda x: x["rel"] == "enclosure")
    return F.when(F.size(found) > 1, F.raise_error(F.lit("several enclosures")).cast("string")).otherwise(F.get(found, F.lit(0))["href"])


def flat_name(source: Column, episode: Column, extension: str = "wav") -> Column:
    """The name of a file in a folder of many sources."""
    return F.concat(source, F.lit("__"), episode, F.lit(f".{extension}"))


def restored_names(results: DataFrame, files: DataFrame, name: str = "name") -> DataFrame:
    """results by flat name, with the source and episode of the files they were made from; results of no file go."""
    return results.join(files.select(flat_name(F.col("source"), F.col("episode")).alias(name), "source", "episode"), name)


def words_inside(words: Column, start: Column, end: Column) -> Column:
    """The words of an array that lie strictly inside a slice."""
    return F.filter(words, lambda w: (w["start"] > start) & (w["end"] < end))


def lag_sample(splits: DataFrame, key: str, n: int = 35, seed: int = 0) -> DataFrame:
    """At most n splits of each entry in an order drawn once and for all by the seed."""
    order = W.partitionBy(key).orderBy(F.xxhash64(F.lit(seed), *splits.columns), *splits.columns)
    return splits.withColumn("draw", F.row_number().over(order)).where(F.col("draw") <= n)


def media_slices(groups: DataFrame, extension: Column) -> DataFrame:
    """What to cut from which file: groups (path, grp, start, end) as whole milliseconds and a target name."""
    stem = F.regexp_replace("path", r"\.[^./]*$", "")
    return groups.select("path", F.round(F.col("start") * 1000).cast("long").alias("start_ms"), F.round(F.col("end") * 1000).cast("long").alias("end_ms"), F.concat(stem, F.lit("."), F.col("grp").cast("string"), F.lit("."), extension).alias("target"))


def first_entity(rows: DataFrame, order: list[Column], **equal) -> DataFrame:
    """The first of the rows whose columns equal the values given: a filtered lookup of a staged remote table."""
    for c, v in equal.items():
        rows = rows.where(F.col(c) == v)
    return rows.orderBy(*order).limit(1)


def head(rows: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first n rows by a total order, after all filters; all of them if n is None."""
    return rows if n is None else rows.orderBy(*order).limit(n)
