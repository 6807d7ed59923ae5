"""N-gram Jaccard join: MinHash banding finds candidates, full n-gram sets decide.

1. Documents with equal n-gram sets are one node; all that follows is about nodes.
2. Nodes that share a band's hash share a bucket. The number of bands follows from the rows of a band and the recall wanted at the threshold.
3. Each member of a bucket is compared with the bucket's least member, so pairs grow with the members, not with their square.
4. Links so found give components. Only buckets whose other members still lie in different components are compared in
   full, in blocks of bounded size inside tasks, which return at most a link for each member. No link between components is lost.
5. Links are counted inside components, again in blocks inside tasks: counts leave a task, pairs don't.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, keeps_columns, release_memory, text_of

WORDS, THRESHOLD, RECALL, BAND_ROWS = 5, 0.8, 0.9999, 6
CACHED_WORDS, CHUNK = 100_000, 4096
#: The most nodes of a block, and how many n-grams (of 8 bytes) a block and a bin of small units hold about.
BLOCK, GRAMS = 512, 2**20
FIRST_ID = -(2**63)


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """How many bands find a pair at the threshold with the recall wanted."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}
        self.odd = _mixed(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").split()  # at ASCII white space
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > CACHED_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - self.words + 1)  # a text of fewer words has one n-gram, all of it
        out = np.full(n, np.uint64(len(h) if len(h) < self.words else self.words))
        for j in range(min(self.words, len(h))):
            out += h[j : j + n] * self.odd[j]
        return np.unique(_mixed(out))


class Banding:
    """Band hashes of a set: MinHash with rows minima a band."""

    def __init__(self, rows: int, bands: int, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.rows, self.bands = rows, bands
        self.a = draw.integers(0, 2**64, (rows * bands, 1), dtype=np.uint64, endpoint=False) | np.uint64(1)
        self.b = draw.integers(0, 2**64, (rows * bands, 1), dtype=np.uint64, endpoint=False)
        self.fold = draw.integers(0, 2**64, (bands, rows), dtype=np.uint64, endpoint=False) | np.uint64(1)
        self.salt = draw.integers(0, 2**64, bands, dtype=np.uint64, endpoint=False)

    def __call__(self, s: np.ndarray) -> np.ndarray:
        if not len(s):
            return np.zeros(0, np.int64)
        least = np.full(self.rows * self.bands, np.uint64(2**64 - 1))
        for i in range(0, len(s), 512):
            x = s[None, i : i + 512] * self.a
            x += self.b
            np.minimum(least, x.min(axis=1), out=least)
        return _mixed((_mixed(least).reshape(self.bands, self.rows) * self.fold).sum(axis=1, dtype=np.uint64) + self.salt).view(np.int64)


def _signed(rows: int, bands: int, words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_memory()
        shingle, band = Shingler(words), Banding(rows, bands)
        for pdf in batches:
            sets = [shingle(t) for t in pdf.pop("text")]
            yield pdf.assign(
                _key=[hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                _size=np.asarray([len(s) for s in sets], dtype="int64"),
                _bands=[band(s) for s in sets],
            )
        del shingle, band
        release_memory()

    return run


def _set_rows(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for pdf in batches:
            sets = [shingle(t) for t in pdf["text"]]
            yield pd.DataFrame({"_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "_set": [s.view(np.int64) for s in sets]})
        del shingle
        release_memory()

    return run


def similar(a: list[np.ndarray], b: list[np.ndarray] | None, threshold: float) -> np.ndarray:
    """Matrix of whether sets of a are at least that similar to sets of b (None: a itself), from sizes of intersections."""
    every = a if b is None else a + b
    values, place, df = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    shared = df[place] > 1  # what one set alone has adds nothing
    column = np.cumsum(df > 1) - 1
    place, owner = column[place[shared]], owner[shared]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    n, m = len(a), len(every)
    both = np.zeros((n, n if b is None else m - n), np.float32)
    for first in range(0, int((df > 1).sum()), CHUNK):
        lo, hi = np.searchsorted(place, [first, first + CHUNK])
        x = np.zeros((m, CHUNK), np.float32)
        x[owner[lo:hi], place[lo:hi] - first] = 1
        both += x[:n] @ (x[:n] if b is None else x[n:]).T
    sizes = np.asarray([len(s) for s in every], dtype=np.float64)
    total = sizes[:n, None] + (sizes[None, :n] if b is None else sizes[None, n:])
    return both.astype(np.float64) * (1 + threshold) >= threshold * total - 1e-6


def _roots(n: int, pairs) -> list[int]:
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def _halves(pdf: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame | None]:
    """A unit's rows without repeats, as one block or two."""
    pdf = pdf.drop_duplicates(["node", "_side"])
    one, two = pdf[pdf["_side"] == 0], pdf[pdf["_side"] == 1]
    return one, two if len(two) else None


def _bridges(threshold: float):
    """Links between different components of a unit: at most one a row."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, unit in pdf.groupby("_unit", sort=True):
            one, two = _halves(unit)
            other = one if two is None else two
            if not len(one) or not len(other):
                continue
            hit = similar([np.asarray(s, dtype=np.int64) for s in one["_set"]], None if two is None else [np.asarray(s, dtype=np.int64) for s in two["_set"]], threshold)
            hit &= one["comp"].to_numpy()[:, None] != other["comp"].to_numpy()[None, :]
            left, right = one["node"].to_numpy(), other["node"].to_numpy()
            place = {c: i for i, c in enumerate(sorted({*one["comp"], *other["comp"]}))}
            lc, rc = [place[c] for c in one["comp"]], [place[c] for c in other["comp"]]
            root = list(range(len(place)))
            for i, j in zip(*np.nonzero(hit), strict=True):
                x, y = lc[i], rc[j]
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    out.append((left[i], right[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _counts(threshold: float):
    """For each node of a unit, the copies of the nodes that it is linked to there."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, unit in pdf.groupby("_unit", sort=True):
            one, two = _halves(unit)
            sets = [np.asarray(s, dtype=np.int64) for s in one["_set"]]
            if two is None:
                if unit["_pair"].iloc[0]:
                    continue  # the other block of the pair is empty
                hit = similar(sets, None, threshold)
                np.fill_diagonal(hit, False)
                out.append(pd.DataFrame({"node": one["node"].to_numpy(), "links": hit @ one["copies"].to_numpy()}))
            elif len(one):
                hit = similar(sets, [np.asarray(s, dtype=np.int64) for s in two["_set"]], threshold)
                out.append(pd.DataFrame({"node": one["node"].to_numpy(), "links": hit @ two["copies"].to_numpy()}))
                out.append(pd.DataFrame({"node": two["node"].to_numpy(), "links": hit.T @ one["copies"].to_numpy()}))
        return pd.concat(out).astype("int64") if out else pd.DataFrame({"node": [], "links": []}).astype("int64")

    return run


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, comp) of all nodes of edges (a, b): comp is the least node that can be reached.

    Large-star and small-star steps in turn until nothing changes; minima are aggregates with map-side combine and come back by
    a join, so a node with very many edges is no hot spot.
    """
    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = large.where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(low.select("a", F.col("_m").alias("b"))).where("a != b")
        edges = cut(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            break
        mark = tuple(now)
    return edges.groupBy("a").agg(F.min("b").alias("comp")).select(F.col("a").alias("node"), "comp").unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def _units(rows: DataFrame, group: str, n: str, grams: str, bins: int) -> DataFrame:
    """rows with _bin, _unit, _side, _pair: work of bounded size. A group of at most BLOCK rows and GRAMS n-grams is a unit, and bins hold many; a larger one
    is cut into blocks by hash, and each pair of blocks is a unit and a bin."""
    blocks = F.greatest(F.ceil(F.col(n) / BLOCK), F.least(F.ceil(F.col(grams) / GRAMS), F.col(n))).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("_b", mine).withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("_b", "_o"), F.greatest("_b", "_o")
    rows = rows.withColumns({"_pair": low != high, "_side": F.when(F.col("_b") > F.col("_o"), 1).otherwise(0), "_unit": F.concat_ws("/", F.col(group).cast("string"), low.cast("string"), high.cast("string"))})
    return rows.withColumn("_bin", F.when(blocks == 1, F.pmod(F.xxhash64(F.lit(5), group), F.lit(bins)).cast("string")).otherwise(F.col("_unit"))).drop("_b", "_o")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL, band_rows: int = BAND_ROWS) -> DataFrame:
    """Rows (doc_id, row_hash, class_key, class_id, class_size, n_links), one a row of docs.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams is at least the threshold; a class holds
    all that links connect, and class_id is its least doc_id; n_links counts the documents that a document is linked to, copies
    included. row_hash is the xxhash64 of the text; class_key tells classes apart where ids are null.

    Words stand between ASCII white space. A text of fewer words than an n-gram is one n-gram; texts without a word have equal, empty
    sets and are copies of each other, null texts among them. Null ids sort first; repeated rows are documents of their own. An empty table
    gives no rows. Other columns are dropped.
    """
    spark = docs.sparkSession
    bands = bands_for(threshold, recall, band_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("row_hash"), text_of(text_col).alias("text"))
    signed = cut(texts.mapInPandas(_signed(band_rows, bands, words), "doc_id long, row_hash long, _key binary, _size long, _bands array<long>"))
    key = F.coalesce("doc_id", F.lit(FIRST_ID))
    nodes = signed.groupBy("_key").agg(F.min(key).alias("first"), F.count("*").alias("copies"), F.first("_size").alias("size"), F.first("_bands").alias("_bands"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()))
    banded = nodes.select("node", "size", F.explode("_bands").alias("_band"))
    buckets = cut(banded.groupBy("_band").agg(F.count("*").alias("_n"), F.min("node").alias("pivot")).where("_n > 1"))
    members = cut(banded.join(buckets, "_band").where("node != pivot").select("_band", "_n", "node", "size", "pivot"))
    node_sizes = nodes.select("node", "size")
    pairs = members.select("node", "pivot").distinct().join(node_sizes, "node").join(node_sizes.select(F.col("node").alias("pivot"), F.col("size").alias("_pivot_size")), "pivot")
    pairs = pairs.where(F.least("size", "_pivot_size") >= threshold * F.greatest("size", "_pivot_size") - 1e-9).select("node", "pivot")
    wanted = cut(members.select("node").unionByName(members.select(F.col("pivot").alias("node"))).distinct().join(nodes.select("node", "_key", "first"), "node"))
    first = wanted.select(F.col("first").alias("_first")).distinct()
    some = texts.withColumn("_first", key).join(first, "_first", "left_semi").select("text")
    # Copies under one id, null among them, are read together: one set a node.
    sets = cut(some.mapInPandas(_set_rows(words), "_key binary, _set array<long>").groupBy("_key").agg(F.first("_set").alias("_set")).join(wanted.select("_key", "node"), "_key").select("node", "_set"))
    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("pivot"), F.col("_set").alias("_other")), "pivot")
    common = F.size(F.array_intersect("_set", "_other"))
    links = cut(both.where(common * (1 + threshold) >= threshold * (F.size("_set") + F.size("_other")) - 1e-6).select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    comps = cut(components(links))
    # Buckets whose members, the pivot aside, lie in several components.
    placed = members.where("_n > 2").select("_band", "node", "size").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = placed.groupBy("_band").agg(F.count("*").alias("_n"), F.min("comp").alias("_lo"), F.max("comp").alias("_hi"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("_sum"), F.sum("size").alias("_grams")).where("_lo != _hi")
    mixed = cut(mixed.groupBy("_n", "_sum").agg(F.min(F.struct("_band", "_grams")).alias("_m")).select("_m._band", "_n", "_m._grams"))  # the same members: once
    if not mixed.isEmpty():
        rows = placed.join(mixed, "_band").join(sets, "node")
        bins = max(1, mixed.agg(F.sum("_grams")).first()[0] // GRAMS)
        found = _units(rows, "_band", "_n", "_grams", bins).select("_bin", "_unit", "_side", "_pair", "node", "comp", "_set").groupBy("_bin").applyInPandas(_bridges(threshold), "a long, b long")
        found = cut(found)
        if not found.isEmpty():
            comps = cut(components(links.unionByName(found)))
    linked = comps.join(nodes.select("node", "copies", "first", "size"), "node")
    sizes = cut(linked.groupBy("comp").agg(F.count("*").alias("_n"), F.sum("size").alias("_grams")))
    several = sizes.where("_n > 2")
    total = several.agg(F.sum("_grams")).first()[0] or 0
    if total:
        rows = linked.join(several, "comp").join(sets, "node")
        rows = _units(rows, "comp", "_n", "_grams", max(1, total // GRAMS)).select("_bin", "_unit", "_side", "_pair", "node", "copies", "_set")
        counted = rows.groupBy("_bin").applyInPandas(_counts(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    else:
        counted = spark.createDataFrame([], "node long, links long")
    classes = linked.groupBy("comp").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size")).join(sizes, "comp")
    own = linked.select("node", "comp", "copies").join(classes, "comp").join(counted, "node", "left")
    # Of two nodes, each is linked to the other.
    own = own.select("node", "comp", "class_id", "class_size", F.when(F.col("_n") == 2, F.col("class_size") - F.col("copies")).otherwise(F.coalesce("links", F.lit(0))).alias("_links"))
    own = cut(nodes.select("node", "_key", "first", "copies").join(own, "node", "left").select("_key", F.coalesce("comp", "node").alias("class_key"), F.coalesce("class_id", "first").alias("class_id"), F.coalesce("class_size", "copies").alias("class_size"), (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    out = signed.select("doc_id", "row_hash", "_key").join(own, "_key")
    return out.select("doc_id", "row_hash", "class_key", F.when(F.col("class_id") != FIRST_ID, F.col("class_id")).alias("class_id"), "class_size", "n_links")


@keeps_columns
def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that are the first of their class, by id and then by hash of the text; of equal rows one. All columns pass."""
    key = {"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST_ID)), "_row": F.xxhash64(text_of(text_col))}
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    mine = F.struct(F.coalesce("doc_id", F.lit(FIRST_ID)).alias("_id"), F.col("row_hash").alias("_row"))
    keep = cut(found.groupBy("class_key").agg(F.min(mine).alias("_k")).select("_k.*").distinct())
    same = W.partitionBy("_id", "_row").orderBy(F.lit(0))
    return docs.withColumns(key).withColumn("_nth", F.row_number().over(same)).where("_nth = 1").join(keep, ["_id", "_row"], "left_semi").select(*docs.columns)
