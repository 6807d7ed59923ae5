"""Greedy packing of captions without walking an entry: where each group would end is found for every caption at once, and the group starts that
are really reached are found by doubling the jumps. An entry may be spread over many tasks between the steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import cut
from .sequential import PACK_LIMIT


def next_starts(cues: DataFrame, keys: list[str], limit: float = PACK_LIMIT) -> DataFrame:
    """Cues (keys, i, start, end) with to: the first later cue whose end lies limit or more behind this one's start, where a group that starts here would end; null if none.

    i numbers an entry's cues from 0; starts must not fall nor be negative. A cue that lasts limit or more ends the group of every cue before it. Among the others none reaches limit behind
    a later cue's start, so the running maximum of their ends tells the first that does: one sort of ends and asked times together.
    """
    inside = W.partitionBy(*keys)
    long = F.col("end") - F.col("start") >= limit
    rows = cues.withColumns(
        {
            "_top": F.max(F.when(~long, F.col("end"))).over(inside.orderBy("i").rowsBetween(W.unboundedPreceding, 0)),
            "_long": F.min(F.when(long, F.col("i"))).over(inside.orderBy(F.col("i").desc()).rowsBetween(W.unboundedPreceding, -1)),  # a frame to the end would be summed up anew for each row
        }
    )
    both = rows.withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))  # 0: what a cue reaches, 1: what it asks for
    # start + limit and end - start may round to either side: the difference decides, as in the definition. What is asked for is the least double that lies limit or more behind the start.
    at = F.col("start") + F.lit(float(limit))
    near = F.transform(F.array(*[F.lit(float(k)) for k in range(-4, 5)]), lambda k: at + k * at * F.lit(2.0**-53))
    value = F.when(F.col("_side") == 0, F.col("_top")).otherwise(F.array_min(F.filter(near, lambda v: v - F.col("start") >= limit)))
    falling = W.partitionBy(*keys).orderBy(F.col("_value").desc_nulls_last(), "_side").rowsBetween(W.unboundedPreceding, 0)
    seen = both.withColumn("_value", value).withColumn("_first", F.min(F.when((F.col("_side") == 0) & F.col("_top").isNotNull(), F.col("i"))).over(falling))
    return seen.where("_side = 1").withColumn("to", F.least("_first", "_long")).drop("_side", "_value", "_first", "_top", "_long")


def reached(jumps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, at): what is reached from 0 along jumps (keys, at, to) that lead onwards (others would never end and are no jumps). Each round doubles both the jumps and what is reached."""
    jumps = cut(jumps.where("to > at").select(*keys, "at", "to"))
    found, n = cut(jumps.where("at = 0").select(*keys, "at")), 0
    while (now := found.count()) > n:
        n = now
        found = cut(found.unionByName(found.join(jumps, [*keys, "at"]).select(*keys, F.col("to").alias("at"))))
        jumps = cut(jumps.withColumnRenamed("to", "_via").join(jumps.select(*keys, F.col("at").alias("_via"), "to"), [*keys, "_via"]).select(*keys, "at", "to"))
    return found


def pack_captions(cues: DataFrame, keys: list[str], limit: float = PACK_LIMIT, least: int = 3) -> DataFrame:
    """Captions (keys, pos, start, end, text) as groups (keys, grp, first_pos, last_pos, start, end, text) of consecutive captions that last less than limit.

    Captions are in order of pos, and starts must not fall. An entry's last caption is left out, and an entry of fewer than `least` has no groups.
    """
    order = W.partitionBy(*keys).orderBy("pos")
    n = F.count("*").over(W.partitionBy(*keys))
    rows = cues.select(*keys, "pos", "start", "end", "text").withColumns({"i": F.row_number().over(order) - 1, "_n": n})
    rows = cut(rows.where((F.col("_n") >= least) & (F.col("i") < F.col("_n") - 1)).drop("_n"))
    starts = reached(next_starts(rows.select(*keys, "i", "start", "end"), keys, limit).withColumnRenamed("i", "at"), keys)
    inside = W.partitionBy(*keys).orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    opens = rows.join(starts.select(*keys, F.col("at").alias("i"), F.lit(1).alias("_opens")), [*keys, "i"], "left")
    grouped = opens.withColumn("grp", F.sum(F.when((F.col("_opens") == 1) & (F.col("i") > 0), 1).otherwise(0)).over(inside)).groupBy(*keys, "grp")
    said = F.array_sort(F.collect_list(F.struct("i", F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" ")).alias("t"))))  # a group lasts less than limit
    return grouped.agg(
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.min_by("start", "i").alias("start"),
        F.max_by("end", "i").alias("end"),
        F.array_join(F.transform(said, lambda s: s["t"]), " ").alias("text"),
    )
