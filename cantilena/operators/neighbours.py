"""The rows most like each query row, by brute force in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import relational as R

#: Queries of a block, rows that meet them at once, and queries whose candidates are looked at together.
QUERY_BLOCK, ROW_BLOCK, CHUNK = 2048, 2048, 64
#: How far the product of unit vectors may lie from the similarity, and how far apart similarities of equal 9 digits may be.
SLACK, EQUAL = 1e-8, 2e-9


def _summed(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of columns i of a with columns j of b, entries added one by one from the first, as functions.vectors.dot adds them."""
    out = np.zeros(len(i))
    for x, y in zip(a, b, strict=True):
        out = out + x[i] * y[j]
    return out


def block_best(asked: np.ndarray, queries: list, ids: np.ndarray, vectors: list, best: int) -> pd.DataFrame:
    """(query, id, similarity, known) of all rows of a block that may be among the best of a query: similarities as functions.vectors.cosine has them, not known where that is null.

    Products of unit vectors, a matrix product, tell which rows come near the best; those alone are added up entry by entry. Of rows equally like a query the first ids do.
    """
    out, lengths = [], np.asarray([-1 if v is None else len(v) for v in vectors])
    sizes = np.asarray([-1 if v is None else len(v) for v in queries])
    for n in np.unique(sizes):
        here, fit = np.flatnonzero(sizes == n), np.flatnonzero((lengths == n) & (n > 0))
        rest = np.sort(ids[(lengths != n) | (n <= 0)])[: best + 1]  # these have no similarity: one more, as the query itself may be among them
        out.append(pd.DataFrame({"query": np.repeat(asked[here], len(rest)), "id": np.tile(rest, len(here)), "similarity": 0.0, "known": False}))
        if not len(fit):
            continue
        q, r = (np.array([x[i] for i in at], dtype=float).T.copy() for x, at in ((queries, here), (vectors, fit)))
        with np.errstate(all="ignore"):
            nq, nr = (np.sqrt(_summed(x, x, at := np.arange(x.shape[1]), at)) for x in (q, r))
            odd_q, odd_r = (~((x > 1e-100) & (x < 1e100)) for x in (nq, nr))
            uq, ur = np.where(odd_q, 0.0, q / nq), np.where(odd_r, 0.0, r / nr)
            for lo in range(0, len(here), CHUNK):
                part = slice(lo, lo + CHUNK)
                own = asked[here[part], None] == ids[None, fit]
                like = np.where(own | odd_r, -np.inf, uq[:, part].T @ ur)
                least = np.partition(like, -best, axis=1)[:, -best] if len(fit) >= best else np.full(len(like), -np.inf)
                i, j = np.nonzero(((like >= least[:, None] - SLACK) | odd_r | odd_q[part, None]) & ~own)
                norm = nq[part][i] * nr[j]
                got = _summed(q[:, part], r, i, j) / norm
                out.append(pd.DataFrame({"query": asked[here[part]][i], "id": ids[fit][j], "similarity": got, "known": norm != 0}))
    found = pd.concat(out, ignore_index=True)
    found = found[found["query"] != found["id"]]
    key = np.where(found["known"], found["similarity"].fillna(9.0), -9.0)  # as in Spark, what is no number comes first, null last
    found = found.assign(_key=key).sort_values(["query", "_key", "id"], ascending=[True, False, True], kind="stable")
    found = found[found.groupby(["query", "_key"]).cumcount() < best]
    place, by = found.groupby("query").cumcount(), found.groupby("query")["_key"]
    last = by.transform("min").where(by.transform("size") < best, found["_key"].where(place == best - 1).groupby(found["query"]).transform("max"))
    return found[found["_key"] >= last - EQUAL].drop(columns="_key")


def most_alike(queries: DataFrame, rows: DataFrame, key: str, vector: str, best: int) -> DataFrame:
    """(query, key, rank, similarity): the best rows for each query by cosine similarity to 9 digits, ties by key, the query itself left out. Keys must be whole numbers and unique.

    Each block of queries meets each block of rows once, in a task that keeps a few rows a query; blocks are of fixed size. The work is queries times rows.
    """
    kind = dict(rows.dtypes)[key]
    whole = F.when(F.forall(vector, lambda x: x.isNotNull()), F.col(vector).cast("array<double>")).alias("v")
    blocks = lambda df, size, to: R.batches(df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), whole), [F.col("k")], size).groupBy(F.col("batch").alias(to)).agg(F.collect_list("k").alias(f"{to}_k"), F.collect_list(F.struct("v")).alias(f"{to}_v"))
    n = -(-queries.count() // QUERY_BLOCK)
    if not n:
        none = queries.limit(0)
        return none.select(F.col(key).alias("query"), key, F.lit(0).alias("rank"), F.lit(0.0).alias("similarity"))
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                vectors = lambda x: [s["v"] for s in x]
                yield block_best(np.asarray(p.a_k), vectors(p.a_v), np.asarray(p.b_k), vectors(p.b_v), best)

    met = blocks(rows, ROW_BLOCK, "b").withColumn("a", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    met = met.join(blocks(queries, QUERY_BLOCK, "a"), "a").repartition(tasks, "a", "b").select("a_k", "a_v", "b_k", "b_v")
    found = met.mapInPandas(run, f"query {kind}, id {kind}, similarity double, known boolean")
    like = F.when(F.col("known"), F.coalesce("similarity", F.lit(float("nan"))))
    ranked = found.withColumn("similarity", like).withColumn("rank", F.row_number().over(W.partitionBy("query").orderBy(F.round("similarity", 9).desc(), "id")))
    return ranked.where(F.col("rank") <= best).select("query", F.col("id").alias(key), "rank", "similarity")
