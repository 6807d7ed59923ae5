"""A uniform shuffle of rows into shards of exact sizes, by matrices of how many rows go from where to where.

Rows lie in source blocks of bounded size. How many rows of each block go to each shard is drawn first: the matrix that a uniform permutation
would show has a multivariate hypergeometric law, given the sizes of blocks and shards. It is drawn down a tree over the blocks: a node knows how many of
its rows go to each shard and deals them out to its children, so no task or driver sees more than one node's counts. Then each block permutes its rows
(by a hash of their numbers) and cuts the order by its row of the matrix; rows meet in their shards. Inside a shard they are permuted again: directly while a shard
is small, and by further rounds of the same kind into parts of exact sizes while it isn't.

DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, keeps_columns

#: Rows of a source block or last part at most, parts that a round splits a shard into at most, and children of a node.
BLOCK, PARTS, CHILDREN = 4096, 16, 16
LAW = "rows"


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def _draw(good: Column, total: Column, n: Column, u: Column) -> Column:
    """How many good ones n draws of total without return hold, by inversion of u in [0, 1): the weights of counts are walked from the mode
    outwards, up and down at once, by the ratio of neighbours. Counts beyond eight standard deviations have no weight in doubles."""
    zero, one = F.lit(0.0), F.lit(1.0)

    def walk(v: Column, target: Column) -> Column:
        """The weights' total and the count at which it exceeds target; nothing is added behind."""

        def step(s: Column, j: Column) -> Column:
            up, down = v["mode"] + j - 1, v["mode"] - j + 1
            a = F.when((up >= v["hi"]) | (s["a"] == 0), zero).otherwise(s["a"] * ((v["k"] - up) * (v["d"] - up)) / ((up + 1) * (v["rest"] - v["d"] + up + 1)))
            b = F.when((down <= v["lo"]) | (s["b"] == 0), zero).otherwise(s["b"] * (down * (v["rest"] - v["d"] + down)) / ((v["k"] - down + 1) * (v["d"] - down + 1)))
            x = lambda w: F.when(s["sum"] + w["a"] > target, up + 1).when(s["sum"] + w["a"] + w["b"] > target, down - 1)
            moved = _with(F.struct(a.alias("a"), b.alias("b")), lambda w: F.struct(w["a"].alias("a"), w["b"].alias("b"), (s["sum"] + w["a"] + w["b"]).alias("sum"), x(w).alias("x")))
            return F.when(s["x"].isNotNull(), s).otherwise(moved)

        start = F.struct(one.alias("a"), one.alias("b"), one.alias("sum"), F.when(one > target, v["mode"]).alias("x"))
        steps = F.when(v["reach"] > 0, F.sequence(F.lit(1), v["reach"])).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, start, step)

    k, t, d = (F.greatest(c, F.lit(1)).cast("double") for c in (good, total, n))
    given = F.struct(k.alias("k"), t.alias("t"), d.alias("d"), (t - k).alias("rest"), F.greatest(zero, d + k - t).alias("lo"), F.least(d, k).alias("hi"), F.floor((d + 1) * (k + 1) / (t + 2)).cast("double").alias("mode"))
    spread = lambda v: F.sqrt(F.greatest(zero, v["d"] * (v["k"] / v["t"]) * (v["rest"] / v["t"]) * (v["t"] - v["d"]) / F.greatest(v["t"] - 1, one)))
    mode = lambda v: F.least(v["hi"], F.greatest(v["lo"], v["mode"]))
    reach = lambda v: F.least(F.greatest(v["hi"] - v["mode"], v["mode"] - v["lo"]), F.ceil(spread(v) * 8).cast("double") + 16).cast("int")
    drawn = _with(given, lambda g: _with(g.withField("mode", mode(g)), lambda m: _with(m.withField("reach", reach(m)), lambda v: _with(u * walk(v, F.lit(float("inf")))["sum"], lambda target: F.coalesce(walk(v, target)["x"], v["mode"]).cast("long")))))
    return F.when((good <= 0) | (n <= 0), F.lit(0).cast("long")).when(n >= total, good).otherwise(drawn)


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that hangs on its parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(2**53))


def drawn_row(left: Column, n: Column, *tag: Column) -> Column:
    """How n rows, drawn from a pool with left[s] places in shard s, divide: an array as long as left."""

    def step(s: Column, k: Column) -> Column:
        drawn = _draw(k, s["total"], s["n"], _uniform(*tag, F.size(s["out"])))
        return _with(drawn, lambda x: F.struct((s["total"] - k).alias("total"), (s["n"] - x).alias("n"), F.concat(s["out"], F.array(x)).alias("out")))

    whole = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x)
    start = F.struct(whole.alias("total"), n.cast("long").alias("n"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(left, start, step)["out"]


def _dealt_node(node: Column, places: Column, at: Column, children: Column, seed: int) -> Column:
    """A node's places for its children, in their order: an array of (child, places, at). at: how many rows of each shard lie before the node."""

    def step(s: Column, child: Column) -> Column:
        def taken(row: Column) -> Column:
            made = F.struct(child["child"].alias("child"), row.alias("places"), s["at"].alias("at"))
            less, more = F.zip_with(s["left"], row, lambda a, b: a - b), F.zip_with(s["at"], row, lambda a, b: a + b)
            return F.struct(less.alias("left"), more.alias("at"), F.concat(s["out"], F.array(made)).alias("out"))

        return _with(drawn_row(s["left"], child["n"], F.lit(seed), *node, child["child"]), taken)

    empty = F.array().cast("array<struct<child:bigint,places:array<bigint>,at:array<bigint>>>")
    return F.aggregate(children, F.struct(places.alias("left"), at.alias("at"), empty.alias("out")), step)["out"]


def matrix(blocks: DataFrame, groups: DataFrame, depth: int, seed: int) -> DataFrame:
    """(grp, block, places, at): how many rows of each block (grp, block, n) go to each shard of its group, and how many rows of the blocks before
    it do. groups: (grp, places), the sizes of a group's shards. Blocks have numbers below CHILDREN ** depth."""
    nodes = groups.select("grp", F.lit(0).cast("long").alias("block"), "places", F.transform("places", lambda _: F.lit(0).cast("long")).alias("at"))
    for level in reversed(range(depth)):
        wide = CHILDREN**level
        child, above = F.floor(F.col("block") / wide), F.floor(F.col("block") / (wide * CHILDREN))
        counted = blocks.groupBy("grp", above.alias("block"), child.alias("child")).agg(F.sum("n").alias("n"))
        families = counted.groupBy("grp", "block").agg(F.array_sort(F.collect_list(F.struct("child", "n"))).alias("_children"))  # CHILDREN at most
        dealt = _dealt_node([F.col("grp"), F.lit(level)], F.col("places"), F.col("at"), F.col("_children"), seed)
        nodes = nodes.join(families, ["grp", "block"]).select("grp", F.explode(dealt).alias("_d")).select("grp", F.col("_d.child").alias("block"), "_d.places", "_d.at")
    return nodes


def even_sizes(n: int, parts: int) -> list[int]:
    """Sizes at most one apart, larger ones first."""
    return [n // parts + (i < n % parts) for i in range(parts)]


def exchanged(rows: DataFrame, groups: DataFrame, depth: int, seed: int) -> DataFrame:
    """rows (grp, block, row, ...) with part, the shard of its group that a row goes to, and at, its number there, gapless from 0."""
    blocks = cut(rows.groupBy("grp", "block").agg(F.count("*").alias("n")))
    order = W.partitionBy("grp", "block").orderBy(F.xxhash64(F.lit(seed), "row"), "row")  # a block has BLOCK rows at most
    placed = rows.withColumn("_i", F.row_number().over(order) - 1).join(matrix(blocks, groups, depth, seed), ["grp", "block"])
    # The part whose range of the block's order holds the row.
    ends = F.aggregate("places", F.array().cast("array<bigint>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long")))))
    placed = placed.withColumn("_ends", ends).withColumn("part", F.size(F.filter("_ends", lambda e: e <= F.col("_i"))))
    before = F.when(F.col("part") == 0, 0).otherwise(F.element_at("_ends", F.greatest(F.col("part"), F.lit(1))))
    return placed.withColumn("at", F.element_at(F.col("at"), F.col("part") + 1) + F.col("_i") - before).drop("_i", "_ends", "places")


def _depth(blocks: int) -> int:
    return max(1, math.ceil(math.log(max(blocks, 2), CHILDREN) - 1e-9))


def assigned(rows: DataFrame, shards: int, *, seed: int = 0, block: int = BLOCK, parts: int = PARTS) -> DataFrame:
    """(row, shard, slot) for rows that have a column row, distinct numbers as monotonically_increasing_id makes them.

    Each set of exact shard sizes, and each order inside the shards, is as likely as any other. Rows with the same numbers get the same places.
    """
    # The source blocks: stretches of `block` rows of the partitions that rows lay in.
    inside = F.col("row").bitwiseAND(F.lit(2**33 - 1))
    spots = rows.select("row", F.shiftrightunsigned("row", 33).alias("_p"), F.floor(inside / block).alias("_s"))
    n, most_p, most_s = spots.agg(F.count("*"), F.coalesce(F.max("_p"), F.lit(0)), F.coalesce(F.max("_s"), F.lit(0))).first()
    state = spots.select(F.lit(0).cast("long").alias("grp"), (F.col("_p") * (most_s + 1) + F.col("_s")).alias("block"), "row")
    depth, split, largest, round_ = _depth((most_p + 1) * (most_s + 1)), shards, n, 0
    groups = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("grp"), F.array(*[F.lit(s).cast("long") for s in even_sizes(n, shards)]).alias("places"))
    while True:
        moved, part = exchanged(state, groups, depth, seed * 1009 + round_), F.col("part").cast("long")
        if round_ == 0:  # offset: how many rows of the shard lie before the part, total: how many in it
            shard, offset, whole = part.cast("int"), F.lit(0).cast("long"), F.lit(n)
        else:
            shard, whole = F.col("shard"), F.col("total")
            offset = F.col("offset") + part * F.floor(whole / split) + F.least(part, whole % split)
        total = F.floor(whole / split) + F.when(part < whole % split, 1).otherwise(0)
        state = moved.select("row", "at", shard.alias("shard"), offset.alias("offset"), total.alias("total"))
        largest = -(-largest // split)
        if largest <= block:
            break
        split, round_ = min(parts, -(-largest // block)), round_ + 1
        state = state.select((F.col("offset") * shards + F.col("shard")).alias("grp"), F.floor(F.col("at") / block).alias("block"), "row", "shard", "offset", "total")
        base, more = F.floor(F.col("total") / split), F.col("total") % split
        groups = state.select("grp", "total").distinct().select("grp", F.array(*[base + F.when(more > i, 1).otherwise(0) for i in range(split)]).alias("places"))
        depth = _depth(-(-largest // block))
        state = cut(state)
    last = W.partitionBy("shard", "offset").orderBy(F.xxhash64(F.lit(seed * 1009 + 997), "row"), "row")  # a last part has BLOCK rows at most
    return state.select("row", "shard", (F.col("offset") + F.row_number().over(last) - 1).alias("slot"))


@keeps_columns
def shuffled_shards(rows: DataFrame, shards: int = 16, *, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """rows with law ("rows": sizes of shards are at most one apart), shard and slot, a row's place in its shard, gapless from 0.

    Each row is put somewhere once, whatever it holds: nulls, empty and long texts, repeated rows and ties are rows like others, and no value is a key, so no
    value is hot. Columns of these names are replaced. Shards are empty if there are fewer rows than shards. An empty table stays empty. Over the same files, split
    alike, the same seed gives the same places. Texts are written once (to the shared folder) and shuffled once; all else moves row numbers.
    """
    kept = cut(rows.drop("law", "shard", "slot").withColumn("_row", F.monotonically_increasing_id()))
    places = assigned(kept.select(F.col("_row").alias("row")), shards, seed=seed, block=block).withColumnRenamed("row", "_row")
    return kept.join(places, "_row").withColumn("law", F.lit(LAW)).drop("_row")


def write_shards(sharded: DataFrame, path: str, *, block: int = 100_000) -> None:
    """Shards as folders shard=0, shard=1 ..., their files in the order of slots, block rows each: a part of a shard is a task."""
    part = F.floor(F.col("slot") / block)
    tasks = max(1, int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = sharded.withColumn("_part", part).repartitionByRange(tasks, "shard", "_part").sortWithinPartitions("shard", "slot")
    ranged.drop("_part").write.partitionBy("shard").option("maxRecordsPerFile", block).parquet(path)
