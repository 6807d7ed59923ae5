"""Mixing sources to target weights by cube-method balanced sampling.

Each document starts with the inclusion probability that its source's target asks for. A flight moves probabilities inside
the null space of two constraints, the totals of tokens and of documents, until all but a few units of a block are 0 or
1. Blocks of a source fly in parallel; what they leave flies again in fewer blocks, until one block of a source is left.
Its last units, LANDING and two at most, land on the sample whose totals are nearest to theirs, and a few single exchanges
in that block take away what is left of the difference in tokens.
"""

from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .common import cut, keeps_columns, text_of

WORD = "[^\\x20\\x09-\\x0D]+"
BLOCK, LANDING, EXCHANGES, MAX_COPIES, WEIGHTS, EPS = 8192, 12, 8, 3, (1, 2, 3), 1e-9


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sized: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Rows (source, source_size, n, target), one a source.

    Sources by code point, null last, take the weights in turn and share the total size by them; a target stops at max_copies
    times its source's size, and the rest is shared among the others. Windows without a partition sort one row per source.
    """
    total = W.partitionBy()
    rank = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), rank + 1).cast("double"))
    # In the order in which sources reach their caps, the level is that of the first source which doesn't reach it.
    cap = F.col("source_size") * max_copies
    order = W.orderBy(cap / F.col("_w"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    per = per.withColumn("_level", (F.sum("source_size").over(total) - before) / left).withColumn("_at", F.row_number().over(order))
    first = F.min(F.when(cap >= F.col("_level") * F.col("_w") * (1 - 1e-12), F.struct("_at", "_level"))).over(total)
    target = F.least(cap.cast("double"), F.col("_w") * first["_level"])
    return per.select("source", "source_size", "n", F.coalesce(target, F.lit(0.0)).alias("target"))


def _move(pi: list, u: tuple, units: list, draw) -> list:
    """Moves pi along u until a unit is 0 or 1; the units still between."""
    up = min((1 - pi[i]) / x if x > 0 else pi[i] / -x for i, x in zip(units, u, strict=True) if x)
    down = min(pi[i] / x if x > 0 else (1 - pi[i]) / -x for i, x in zip(units, u, strict=True) if x)
    step = up if draw() * (up + down) < down else -down
    for i, x in zip(units, u, strict=True):
        at = pi[i] + step * x
        pi[i] = 0.0 if at < EPS else 1.0 if at > 1 - EPS else at
    return [i for i in units if 0 < pi[i] < 1]


def _landed(pi: list, size: list, units: list) -> None:
    """Rounds pi of the units to 0 or 1 so that their totals of tokens and of documents change least, tokens first."""
    p, x = np.asarray([pi[i] for i in units]), np.asarray([size[i] for i in units], dtype=float)
    takes = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
    cost = np.abs(takes @ x - p @ x) / max(1.0, x.mean()) + 0.05 * np.abs(takes.sum(1) - p.sum())
    for i, take in zip(units, takes[int(cost.argmin())], strict=True):
        pi[i] = float(take)


def _exchanged(pi: list, size: list, units: list, goal: float) -> None:
    """Takes or leaves single units, the best first, while that brings the total of tokens nearer to the goal."""
    x = np.asarray([size[i] for i in units], dtype=float)
    taken = np.asarray([pi[i] for i in units])
    for _ in range(EXCHANGES):
        off = taken @ x - goal
        after = np.abs(off + (1 - 2 * taken) * x)
        k = int(after.argmin())
        if after[k] >= abs(off) - 1e-6:
            break
        taken[k] = 1 - taken[k]
    for i, t in zip(units, taken, strict=True):
        pi[i] = float(t)


def flight(pi: list[float], size: list[int], draw, land: bool) -> list[float]:
    """pi moved until LANDING + 2 units at most lie between 0 and 1; with land, none.

    A unit far larger than the others is among the last to be decided, so LANDING ordinary ones are left beside it to make up for it.
    """
    todo, live = [i for i, p in enumerate(pi) if 0 < p < 1], []
    goal, last = sum(pi[i] * size[i] for i in todo), max(0, len(todo) - LANDING)
    for i in todo[:last]:
        live.append(i)
        while len(live) == 3:
            a, b, c = (size[k] for k in live)
            live = _move(pi, (b - c, c - a, a - b) if not a == b == c else (1, -1, 0), live, draw)
    if land and todo:
        _landed(pi, size, live + todo[last:])
        _exchanged(pi, size, todo, goal)
    return pi


def _flight_of(turn: int, seed: int, keys: list[str], names: list[str]):
    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "size", *keys], kind="stable")
        source = pdf["source"].iloc[0]
        name = "\0" if source is None or source != source else str(source)
        draw = random.Random(zlib.crc32(f"{seed} {turn} {int(pdf['_block'].iloc[0])} {name}".encode())).random
        pdf["_pi"] = flight(pdf["_pi"].tolist(), pdf["size"].tolist(), draw, int(pdf["_blocks"].iloc[0]) <= 1)
        return pdf[names]

    return fly


def mix(units: DataFrame, *, keys: list[str], weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """units (keys, source, size) with source_size, target, copies and taken = copies * size.

    A unit is taken floor(target / source_size) times, and once more if the sample has it. The same rows and seed give the
    same result, whatever the partitions.

    Null source: a source of its own, last. Null size: 0. Sources without a word have target 0. Repeated rows are units
    of their own. An empty table gives an empty one. Other columns are dropped.
    """
    if block < 2 * (LANDING + 2):
        raise ValueError("a block must hold more than two blocks leave")
    units = units.select(*keys, "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    goal = cut(targets(units, weights=weights, max_copies=max_copies))
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0)
    goal = goal.withColumns({"_whole": F.floor(ratio).cast("int"), "_pi": ratio - F.floor(ratio)}).withColumnRenamed("source", "_source")
    rows = units.join(goal, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source").withColumn("_order", F.xxhash64(F.lit(seed), *keys))
    most = goal.agg(F.max("n")).first()[0] or 0
    blocks, out, names = F.ceil(F.col("n") / block), [], rows.columns
    for turn in itertools.count():  # each turn leaves at most half of the blocks
        groups = blocks
        rows = rows.withColumns({"_blocks": groups.cast("long"), "_block": F.pmod(F.xxhash64(F.lit(turn), "_order"), F.greatest(groups, F.lit(1)))})

        rows = cut(rows.groupBy("source", "_block").applyInPandas(_flight_of(turn, seed, keys, names), T.StructType([rows.schema[c] for c in names])))
        out.append(rows.where("_pi in (0, 1)"))
        if most <= block:
            break
        rows, most, blocks = rows.where("_pi not in (0, 1)"), (LANDING + 2) * math.ceil(most / block), F.ceil((LANDING + 2) * blocks / block)
    flown = out[0]
    for x in out[1:]:
        flown = flown.unionByName(x)
    copies = F.col("_whole") + F.col("_pi").cast("int")
    return flown.select(*keys, "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


@keeps_columns
def mixed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs, each as often as mix() takes it. Equal rows share what is taken of them evenly.

    Null id or text: as any other value. All columns pass through.
    """
    key = {"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))), "_row": F.xxhash64(text_of(text_col), F.col(source_col))}
    units = docs.select(key["_id"].alias("_id"), key["_row"].alias("_row"), F.col(source_col).alias("source"), n_words(text_of(text_col)).alias("size"))
    takes = mix(units, keys=["_id", "_row"], **how).groupBy("_id", "_row").agg(F.sum("copies").alias("_sum"), F.count("*").alias("_n"))
    takes = cut(takes.where("_sum > 0"))
    same = W.partitionBy("_id", "_row").orderBy(F.lit(0))
    rows = docs.withColumns(key).withColumn("_nth", F.row_number().over(same)).join(takes, ["_id", "_row"])
    share = F.floor(F.col("_sum") / F.col("_n")) + F.when(F.col("_nth") <= F.col("_sum") % F.col("_n"), 1).otherwise(0)
    return rows.withColumn("_share", share.cast("int")).where("_share > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_share")))).select(*docs.columns)
