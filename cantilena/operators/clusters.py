"""Two classes of a number, for all entries at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut


def _nearer_zero(value: Column, c0: Column, c1: Column) -> Column:
    return F.abs(value - c0) <= F.abs(value - c1)


def two_means(rows: DataFrame, keys: list[str], value: str, steps: int = 20) -> DataFrame:
    """rows with cls, 0 or 1, by Lloyd's steps from centroids 0 and 1: the classes of sequential.two_means. A null value has a null class.

    Values are counted once; a step is then a sum on either side of each entry's threshold over the distinct values alone. Entries that don't move any more leave; the rest goes on, `steps` at most.
    """
    counted = cut(rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n")))
    moving = counted.select(*keys).distinct().withColumns({"_c0": F.lit(0.0), "_c1": F.lit(1.0)})
    settled, left = None, steps
    while left > 1:
        low = _nearer_zero(F.col("_v"), F.col("_c0"), F.col("_c1"))
        side = lambda on: F.sum(F.when(on, F.col("_v") * F.col("_n"))) / F.sum(F.when(on, F.col("_n")))
        new = counted.join(moving, keys).groupBy(*keys, "_c0", "_c1").agg(side(low).alias("_a"), side(~low).alias("_b"))
        new = new.withColumns({"_a": F.coalesce("_a", "_c0"), "_b": F.coalesce("_b", "_c1")})
        close = lambda a, c: F.abs(F.col(a) - F.col(c)) <= 1e-8 + 1e-5 * F.abs(F.col(c))
        new = cut(new.withColumn("_still", close("_a", "_c0") & close("_b", "_c1")))
        still = new.where("_still").select(*keys, "_c0", "_c1")
        settled = still if settled is None else settled.unionByName(still)
        moving, left = new.where("not _still").select(*keys, F.col("_a").alias("_c0"), F.col("_b").alias("_c1")), left - 1
        if moving.isEmpty():
            break
    every = moving if settled is None else settled.unionByName(moving)
    label = F.when(_nearer_zero(F.col(value).cast("double"), F.col("_c0"), F.col("_c1")), 0).otherwise(1).cast("long")
    return rows.join(every, keys, "left").withColumn("cls", F.when(F.col(value).isNotNull(), label)).drop("_c0", "_c1")
