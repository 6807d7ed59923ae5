"""Text matching by character histograms, and alignment of transcripts by them."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import squeeze_marks
from ..storage import cut

_SPLIT = re.compile(r"[\s.,;!?()\[\]{}]")


def character_weights(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, char, n, weight): weights grow with rarity: the softmax of 1 less the scaled logarithm of the count."""
    chars = texts.select(*keys, F.explode(F.split(squeeze_marks(F.col(text)), "")).alias("char")).where("char != ''")
    counted = chars.groupBy(*keys, "char").agg(F.count("*").alias("n"))
    w = W.partitionBy(*keys)
    log = F.ln("n")
    lo, hi = F.min(log).over(w), F.max(log).over(w)
    rare = F.exp(1 - F.when(hi > lo, (log - lo) / (hi - lo)).otherwise(0.0))
    return counted.withColumn("_r", rare).select(*keys, "char", "n", (F.col("_r") / F.sum("_r").over(w)).alias("weight"))


def weighted_counts(text: str, weights: dict[str, float], starts: np.ndarray, width: int) -> np.ndarray:
    """Weighted counts of the alphabet in the windows of width that begin at starts."""
    codes = np.asarray([ord(c) for c in text], np.int64)
    out = np.zeros((len(starts), len(weights)))
    for k, c in enumerate(sorted(weights)):
        total = np.concatenate([[0], (codes == ord(c)).cumsum()])
        out[:, k] = (total[starts + width] - total[starts]) * weights[c]
    return out


def best_starts(text: str, query: str, weights: dict[str, float], ranges: Sequence[tuple[int, int]], stride: int, best: int) -> list[tuple[int, float]]:
    """(start, similarity) of the windows of the query's length inside ranges most like it; of like ones the first. Windows without a known character are skipped."""
    starts = np.unique(np.concatenate([np.arange(a, b - len(query) + 1, stride) for a, b in ranges]).astype(np.int64)) if ranges else np.zeros(0, np.int64)
    if not len(starts) or not any(c in weights for c in query):
        return []
    got = weighted_counts(text, weights, starts, len(query))
    want = np.asarray([query.count(c) * weights[c] for c in sorted(weights)])
    norm = np.linalg.norm(got, axis=1)
    like = np.where(norm > 0, got @ want / np.maximum(norm, 1e-300) / np.linalg.norm(want), -1.0).round(12)
    return [(int(starts[i]), float(like[i])) for i in np.argsort(-like, kind="stable")[:best] if like[i] >= 0]


def union_ranges(ranges: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_start(text: str, query: str, weights: dict[str, float], *, coarse: tuple[int, int, int] = (150, 50, 5), fine: tuple[int, int] = (250, 5)) -> tuple[int, float] | None:
    """Where the query begins in the text, and how like it is: a coarse search (characters of the query, stride, hits), then a fine one
    (characters, stride) over the union of the ranges around its hits."""
    width, stride, best = coarse
    hits = best_starts(text, query[:width], weights, [(0, len(text))], stride, best)
    ranges = union_ranges([(max(0, at - 2 * width), min(len(text), at + 3 * width)) for at, _ in hits])
    return next(iter(best_starts(text, query[: fine[0]], weights, ranges, fine[1], 1)), None)


def _searched(texts: DataFrame, queries: DataFrame, key: str, find: Callable[[str, str, dict[str, float]], list[tuple[int, float]]]) -> DataFrame:
    """(key, query, at, similarity, rank): what find gives for each query (query, query_text) in the text (key, text) of its key, by all characters of the text with their rarity."""
    kinds = dict(queries.dtypes) | dict(texts.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, text, query, wanted in zip(pdf[key], pdf["text"], pdf["query"], pdf["query_text"], strict=True):
                if text and wanted:
                    rows += [(k, query, *hit, i + 1) for i, hit in enumerate(find(text, wanted, rarity(text)))]
            yield pd.DataFrame(rows, columns=[key, "query", "at", "similarity", "rank"])

    rows = texts.join(queries, key).select(key, "text", "query", "query_text")
    return rows.mapInPandas(run, f"`{key}` {kinds[key]}, query {kinds['query']}, at int, similarity double, rank int")


def window_search(texts: DataFrame, queries: DataFrame, *, key: str = "doc_id", stride: int = 50, best: int = 5) -> DataFrame:
    """(key, query, at, similarity, rank): the windows of texts (key, text) most like each query (query, query_text) of the same key, by the cosine of their characters' counts,
    weighted by rarity in the key's text. Windows have the query's length and start every stride characters; those without a known character are skipped."""
    return _searched(texts, queries, key, lambda text, wanted, weights: best_starts(text, wanted, weights, [(0, len(text))], stride, best))


def fine_search(texts: DataFrame, queries: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(key, query, at, similarity): find_start of each query (query, query_text) in the text (key, text) of its key."""
    return _searched(texts, queries, key, lambda text, wanted, weights: [hit] if (hit := find_start(text, wanted, weights)) else []).drop("rank")


def rarity(text: str) -> dict[str, float]:
    """The weights of character_weights for one text."""
    count = Counter(re.sub(r"[\s,.?]+", " ", text))
    log = np.log(list(count.values()))
    rare = np.exp(1 - (log - log.min()) / ((log.max() - log.min()) or 1.0))
    return dict(zip(count, (rare / rare.sum()).tolist(), strict=True))


def sliding_histograms(text: str, weights: dict[str, float], width: int) -> np.ndarray:
    """For each character, the weighted shares of the alphabet in the window of width centred on it."""
    codes, letters = np.fromiter(map(ord, text), np.int64, len(text)), np.asarray([ord(c) for c in sorted(weights)], np.int64)
    hot = np.zeros((len(text) + 1, len(letters)))
    if len(letters):
        k = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
        known = np.flatnonzero(letters[k] == codes)
        hot[known + 1, k[known]] = 1
    total, half, at = hot.cumsum(0), width // 2, np.arange(len(text))
    counts = total[np.minimum(at + half + 1, len(text))] - total[np.maximum(at - half, 0)]
    shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    return shares * np.asarray([weights[c] for c in sorted(weights)])


def cosine_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    na, nb = np.linalg.norm(a, axis=1, keepdims=True), np.linalg.norm(b, axis=1, keepdims=True)
    return 1 - (a / np.maximum(na, 1e-12)) @ (b / np.maximum(nb, 1e-12)).T


def dtw(cost: np.ndarray) -> tuple[float, list[tuple[int, int]]]:
    """Warps the query (rows) into any part of the reference (columns): each step takes a row and none, one or two columns.

    The distance is divided by the query's length; infinite if there is no path.
    """
    n, m = cost.shape
    if not n or not m:
        return float("inf"), []
    total, come = np.full((n, m), np.inf), np.zeros((n, m), np.int8)
    total[0] = cost[0]
    for i in range(1, n):
        ways = np.full((3, m), np.inf)
        for k in range(3):
            ways[k, k:] = total[i - 1, : m - k] if k else total[i - 1]
        come[i] = ways.argmin(0)
        total[i] = ways.min(0) + cost[i]
    j = int(total[-1].argmin())
    path, best = [], float(total[-1, j] / n)
    if not np.isfinite(best):
        return best, []
    for i in range(n - 1, -1, -1):
        path.append((i, j))
        j -= int(come[i, j])
    return best, path[::-1]


def unit_rows(a: np.ndarray) -> np.ndarray:
    return a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-12)


def warp_ends(query: np.ndarray, reference: np.ndarray, rows: int = 16) -> tuple[float, int, int]:
    """The distance of dtw, and the first and last column of its path; rows of query and columns of reference have length 1 (or 0).

    Costs are made for some rows at a time and starts go along with the totals, so memory grows with the reference alone.
    """
    n, m = len(query), reference.shape[1]
    used = query.any(0)
    query, reference = query[:, used], reference[used]
    total, start = np.empty(0), np.arange(m, dtype=np.int32)
    for i in range(0, n, rows):
        for cost in 1 - query[i : i + rows] @ reference:
            if not len(total):
                total = cost.copy()
                continue
            best, come = total.copy(), start.copy()
            for k in (1, 2):
                if m > k:
                    better = total[:-k] < best[k:]
                    np.copyto(best[k:], total[:-k], where=better)
                    np.copyto(come[k:], start[:-k], where=better)
            best += cost
            total, start = best, come
    j = int(total.argmin())
    return float(total[j] / n), int(start[j]), j


#: Rows at either end of a query that nearest_warp warps over the whole reference, and how far sums of the same costs may lie apart.
EDGE_ROWS, ROUNDING = 16, 1e-9


def _edge_totals(query: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The least totals of some rows at each column."""
    total = np.empty(0)
    for cost in 1 - query @ reference:
        if len(total):
            best = total.copy()
            for k in (1, 2):
                if len(total) > k:
                    np.minimum(best[k:], total[:-k], out=best[k:])
            cost += best
        total = cost
    return total


def _kept_row(cells: tuple[np.ndarray, np.ndarray, np.ndarray], row: np.ndarray, reference: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns, totals and starts after a row more, of the cells of the row before; only totals up to most stay."""
    columns, total, start = cells
    new = np.unique(np.concatenate([columns, columns + 1, columns + 2]))
    new = new[new < reference.shape[1]]
    best, come = np.full(len(new), np.inf), np.zeros(len(new), start.dtype)
    for k in (0, 1, 2):
        at = np.minimum(np.searchsorted(columns, new - k), len(columns) - 1)
        better = (columns[at] == new - k) & (total[at] < best)
        best[better], come[better] = total[at[better]], start[at[better]]
    best += 1 - row @ reference[:, new]
    stay = best <= most
    return new[stay], best[stay], come[stay]


def _straight_on(cells: tuple[np.ndarray, np.ndarray, np.ndarray], query: np.ndarray, reference: np.ndarray, most: float) -> tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """How many rows every cell goes straight on, as any other step would exceed most, and the cells then."""
    columns, total, start = cells
    rows = min(len(query), reference.shape[1] - 1 - int(columns[-1]))
    if rows < 1:
        return 0, cells
    ahead = columns[:, None] + np.arange(1, rows + 1)
    aside = np.full(ahead.shape, np.inf)
    for k in (-1, 1):
        inside = np.minimum(ahead + k, reference.shape[1] - 1)
        cost = 1 - np.einsum("rl,lcr->cr", query[:rows], reference[:, inside])
        np.minimum(aside, np.where(ahead + k < reference.shape[1], cost, np.inf), out=aside)
    cost = 1 - np.einsum("rl,lcr->cr", query[:rows], reference[:, ahead])
    sums = np.concatenate([total[:, None], cost], axis=1).cumsum(1)
    # What stays below this bound, all costs before it being at least -ROUNDING in sum, could turn aside or end here.
    bad = ((total[:, None] + aside <= most + ROUNDING) | (sums[:, 1:] > most)).any(0)
    n = int(bad.argmax()) if bad.any() else rows
    return n, (columns + n, sums[:, n], start)


def nearest_warp(query: np.ndarray, reference: np.ndarray, edge: int = EDGE_ROWS) -> tuple[float, int, int]:
    """warp_ends without most of its cells: what can't lead to the best total is left out.

    Costs aren't negative. The first rows are warped over all columns, and so are the last, backwards: their least total is what any path still has to pay. Straight paths from the best columns
    give a total that the best one doesn't exceed; cells whose total and what is still to pay exceed it are dropped. A base that stands in the reference leaves one cell a row, one that doesn't more, at worst all.
    """
    n, m = len(query), reference.shape[1]
    if n < 4 * edge or m < 2:
        return warp_ends(query, reference)
    used = query.any(0)
    part, columns = np.ascontiguousarray(query[:, used]), reference[used]
    first = _edge_totals(part[:edge], columns)
    still = _edge_totals(part[n - edge :][::-1], columns[:, ::-1])[::-1]  # from the column of row n - edge on
    least, inner = float(still.min()) - ROUNDING, n - 2 * edge
    most, last, near = np.inf, 0, min(4, m)
    for j in np.argpartition(first, near - 1)[:near]:
        along = j + np.arange(1, inner + 1)
        if along[-1] + 1 < m:
            straight = 1 - np.einsum("lr,lr->r", part[edge : n - edge].T, columns[:, along[0] : along[-1] + 1])
            total = float(first[j] + straight.sum())
            if (then := total + float(still[along[-1] : along[-1] + 3].min())) < most:
                most, last, reached = then, int(along[-1]), total
    bound = most - least + ROUNDING
    alive = np.flatnonzero(first <= bound)
    if not np.isfinite(most) or len(alive) > max(64, m // 64):
        return warp_ends(query, reference)
    lo = max(0, int(alive[0]) - 2 * edge + 2)
    ends = np.flatnonzero(still <= most - float(first.min()) + ROUNDING)
    if most - float(first.min()) - float(still.min()) <= ROUNDING and alive[-1] - lo <= 32 * edge and ends[0] >= last and ends[-1] <= last + 2:
        # The straight path is as good as any: if all that stays has one start and one end, these are the best path's.
        _, starts = advanced(np.empty(0), np.arange(lo, alive[-1] + 1, dtype=np.int32), part[:edge], columns[:, lo : alive[-1] + 1].T)
        starts = np.unique(starts[alive - lo])
        tail = columns[:, last : last + 2 * edge + 1].T
        totals, _ = advanced(np.where(np.arange(len(tail)) == 0, reached, np.inf), np.zeros(len(tail), np.int32), part[n - edge :], tail)
        if len(starts) == 1 and (totals <= totals.min() + ROUNDING).sum() == 1:
            return float(totals.min() / n), int(starts[0]), last + int(totals.argmin())
    # Totals and starts of the cells that stay, from the columns that lead to them.
    cells = (np.unique((alive[:, None] - np.arange(2 * edge - 1)).clip(0)), *(np.empty(0),) * 2)
    cells = (cells[0], 1 - part[0] @ columns[:, cells[0]], cells[0].astype(np.int32))
    for i in range(1, edge):
        cells = _kept_row(cells, part[i], columns, bound)
    i, wait = edge, 0
    while i < n:
        if len(cells[0]) > max(64, m // 16):
            return warp_ends(query, reference)
        ahead = 0
        if i < n - edge and not wait and len(cells[0]) <= 16:
            ahead, cells = _straight_on(cells, part[i : n - edge], columns, bound)
            wait = 0 if ahead else 4
        if ahead:
            i += ahead
            continue
        cells = _kept_row(cells, part[i], columns, bound if i < n - edge else most + 2 * ROUNDING)
        i, wait = i + 1, max(0, wait - 1)
    best = int(cells[1].argmin())
    return float(cells[1][best] / n), int(cells[2][best]), int(cells[0][best])


#: Rows of the query that a superstep of tiled_warp takes, columns of a tile (twice the rows at least), and the product of lengths from which align_splits uses tiles.
TILE_ROWS, TILE_COLUMNS, TILED_FROM = 512, 4096, 2**31
#: Splits of an entry that one task takes, for which the histograms of their reference are made once.
TOGETHER = 16


def piece_shares(text: str, lo: int, begin: int, end: int, weights: dict[str, float], width: int) -> np.ndarray:
    """Unit histograms of places begin to end of a text of which `text` is the part from lo on, with half a width more than that on either side, or to the text's own ends."""
    return unit_rows(sliding_histograms(text, weights, width)[begin - lo : end - lo])


def advanced(total: np.ndarray, start: np.ndarray, query: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Totals and starts after some rows of the query more. Without totals the first row begins them, at the columns named by start."""
    for cost in 1 - query @ columns.T:
        if not len(total):
            total = cost.copy()
            continue
        best, come = total.copy(), start.copy()
        for k in (1, 2):
            if len(total) > k:
                better = total[:-k] < best[k:]
                np.copyto(best[k:], total[:-k], where=better)
                np.copyto(come[k:], start[:-k], where=better)
        total, start = best + cost, come
    return total, start


def tiled_warp(splits: DataFrame, keys: list[str], *, width: int = 20, rows: int = TILE_ROWS, columns: int = TILE_COLUMNS) -> DataFrame:
    """(keys, distance, first, last) of warp_ends for splits (keys, base, reference, weights), many tasks a split.

    The reference is cut into tiles of columns. A total hangs on the row before, at its own column and the two to the left, so a superstep can take some rows of the query in all tiles at once,
    if each tile starts with twice as many of its left neighbour's columns too: what is wrong at their left rim doesn't reach its own. Between supersteps those columns
    change hands in a shuffle. Splits whose query is through leave. Base and reference must not be empty.
    """
    if columns < 2 * rows:
        raise ValueError("a tile must be as wide as two columns for each row of a superstep")
    half, halo = width // 2, 2 * rows
    n, m = F.length("base"), F.length("reference")
    lo = F.greatest(F.col("tile") * columns - halo - half, F.lit(0))
    tiles = splits.select(*keys, "weights", "reference", n.alias("n"), m.alias("m"), F.explode(F.sequence(F.lit(0), F.floor((m - 1) / columns).cast("int"))).alias("tile"))
    tiles = tiles.withColumn("lo", lo).withColumn("piece", F.substring(F.col("reference"), F.col("lo") + 1, F.lit(columns + halo + 2 * half + 1))).drop("reference")
    tiles = cut(tiles)
    slices = splits.select(*keys, F.col("base"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / rows).cast("int"))).alias("step"))
    slices = slices.withColumn("from", F.greatest(F.col("step") * rows - half, F.lit(0))).withColumn("said", F.substring(F.col("base"), F.col("from") + 1, F.lit(rows + 2 * half + 1))).drop("base")
    slices = cut(slices)
    steps = slices.agg(F.max("step")).first()[0]
    if steps is None:
        return splits.select(*keys, F.lit(None).cast("double").alias("distance"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    held = "totals array<double>, starts array<int>"
    schema = ", ".join([*(f"`{k}` {t}" for k, t in splits.select(*keys).dtypes), "tile int, n int", held])
    session = splits.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            totals, starts = [], []
            for r in pdf.itertuples(index=False):
                weights = dict(r.weights)
                begin, end = max(0, r.tile * columns - halo), min(r.m, (r.tile + 1) * columns)
                query = piece_shares(r.said, r[names["from"]], r.step * rows, min(r.n, (r.step + 1) * rows), weights, width)
                reference = piece_shares(r.piece, r.lo, begin, end, weights, width)
                if r.step == 0:
                    total, start = np.empty(0), np.arange(begin, end, dtype=np.int32)
                else:
                    left = [np.asarray(x if x is not None else [], dtype=t) for x, t in ((r.left_totals, float), (r.left_starts, np.int32))]
                    total, start = np.concatenate([left[0], r.totals]), np.concatenate([left[1], r.starts]).astype(np.int32)
                total, start = advanced(total, start, query, reference)
                own = min(r.m, (r.tile + 1) * columns) - r.tile * columns
                totals.append(total[-own:])
                starts.append(start[-own:])
            yield pdf[[*keys, "tile", "n"]].assign(totals=totals, starts=starts)

    empty = [F.array().cast("array<double>").alias("totals"), F.array().cast("array<int>").alias("starts")]
    state, done = tiles.select(*keys, "tile", "n", *empty), []
    for step in range(steps + 1):
        handed = state.select(*keys, (F.col("tile") + 1).alias("tile"), F.expr(f"slice(totals, greatest(size(totals) - {halo - 1}, 1), {halo})").alias("left_totals"), F.expr(f"slice(starts, greatest(size(starts) - {halo - 1}, 1), {halo})").alias("left_starts"))
        asked = slices.where(F.col("step") == step)
        work = state.drop("n").join(handed, [*keys, "tile"], "left").join(tiles, [*keys, "tile"]).join(asked, keys)
        names = {c: i for i, c in enumerate(work.columns)}
        state = cut(work.repartition(tasks, *keys, "tile").mapInPandas(run, schema))
        over = F.col("n") <= (step + 1) * rows
        if step == steps or not (ended := state.where(over)).isEmpty():
            ended = state.where(over)
            best = F.array_min(F.transform("totals", lambda x, i: F.struct(x.alias("t"), (F.col("tile") * columns + i).alias("j"), F.element_at("starts", i + 1).alias("s"))))
            done.append(ended.groupBy(*keys, "n").agg(F.min(best).alias("_b")).select(*keys, (F.col("_b.t") / F.col("n")).alias("distance"), F.col("_b.s").cast("int").alias("first"), F.col("_b.j").cast("int").alias("last")))
            state = state.where(~over)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def matching_edge(reference: str, cuts: Sequence[int], near: int, query_edge: str, weights: dict[str, float], reach: int = 2, limit: float = 0.35, least: int = 4) -> int | None:
    """Of the cuts around a place, the one whose piece up to the next cut is most like the query's edge; None if none is like enough."""
    if len(query_edge) < least or not len(cuts):
        return None
    k = int(np.abs(np.asarray(cuts) - near).argmin())

    def shares(t: str) -> np.ndarray:
        return np.asarray([t.count(c) * weights[c] for c in sorted(weights)], float)

    want, best = shares(query_edge), (limit, None)
    for i in range(max(0, k - reach), min(k + reach, len(cuts) - 1)):
        got = shares(reference[cuts[i] : cuts[i + 1]])
        norm = np.linalg.norm(want) * np.linalg.norm(got)
        distance = 1 - float(want @ got) / norm if norm else 1.0
        if distance < best[0]:
            best = (distance, cuts[i])
    return best[1]


def split_points(text: str) -> list[int]:
    """Where a text may be cut: its begin, and each space or mark."""
    return sorted({0, *(m.start() for m in _SPLIT.finditer(text))})


def reference_edges(base: str, reference: str, first: int, last: int, weights: dict[str, float], least: int = 4) -> tuple[int, int]:
    """Where to cut the reference for a base that warps onto first to last: at the pieces like the base's own first and last pieces of at least so many characters.

    The last cut is the reference's end, so that its last piece can be taken too.
    """
    cuts, own = split_points(reference), split_points(base)
    if cuts[-1] < len(reference):
        cuts.append(len(reference))
    nearest = lambda at: cuts[int(np.abs(np.asarray(cuts) - at).argmin())]
    head = base[: next((c for c in own if c >= least), len(base))]
    tail = base[next((c for c in reversed(own) if c <= len(base) - least), 0) :]

    def edge(piece: str, at: int, otherwise: int) -> int:
        if not any(c in weights for c in piece):
            return otherwise
        found = matching_edge(reference, cuts, at, piece, weights, least=1)
        return nearest(at) if found is None else found

    hi = edge(tail, last, len(reference))
    return edge(head, first, 0), next((c for c in cuts if c > hi), len(reference))


def reference_shares(reference: str, weights: dict[str, float], width: int = 20, step: int = 1) -> np.ndarray:
    return np.ascontiguousarray(unit_rows(sliding_histograms(reference, weights, width)[::step]).T)


def align_text(base: str, reference: str, weights: dict[str, float], *, width: int = 20, limit: float = 0.35, step: int = 1, shares: np.ndarray | None = None) -> tuple[str, float, bool]:
    """(aligned, distance, fallback): the part of the reference that base stands for, cut where its pieces are like the base's ends; base itself if it can't be found.

    shares: the reference's reference_shares, if they are known.
    """
    if not any(c in weights for c in base) or not any(c in weights for c in reference):
        return base, float("inf"), True
    shares = reference_shares(reference, weights, width, step) if shares is None else shares
    distance, first, last = nearest_warp(unit_rows(sliding_histograms(base, weights, width)[::step]), shares)
    return cut_out(base, reference, weights, distance, first * step, last * step, limit)


def cut_out(base: str, reference: str, weights: dict[str, float], distance: float, first: int, last: int, limit: float = 0.35) -> tuple[str, float, bool]:
    """align_text once the base is known to warp onto places first to last."""
    if distance >= limit:
        return base, distance, True
    left, right = reference_edges(base, reference, first, last, weights)
    aligned = reference[left:right].strip()
    return (aligned, distance, False) if aligned else (base, distance, True)


def raw_weights(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, weights): a map from each character of the texts of a key, repeated rows counted, to its rarity."""
    several = texts.groupBy(*keys, text).agg(F.count("*").alias("_n"))
    counted = several.select(*keys, "_n", F.explode(F.split(F.col(text), "")).alias("_c")).where("_c != ''").groupBy(*keys, "_c").agg(F.ln(F.sum("_n")).alias("_log"))
    span = counted.groupBy(*keys).agg(F.min("_log").alias("_lo"), F.max("_log").alias("_hi"), F.collect_list(F.struct("_c", "_log")).alias("_all"))  # a row an alphabet
    rare = F.transform("_all", lambda x: F.struct(x["_c"].alias("c"), F.exp(1 - F.when(F.col("_hi") > F.col("_lo"), (x["_log"] - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(0.0)).alias("w")))
    total = F.aggregate("_rare", F.lit(0.0), lambda a, x: a + x["w"])
    return span.select(*keys, rare.alias("_rare")).select(*keys, F.map_from_entries(F.transform("_rare", lambda x: F.struct(x["c"], x["w"] / total))).alias("weights"))


def align_splits(splits: DataFrame, keys: list[str], *, width: int = 20, limit: float = 0.35, step: int = 1, tiled_from: int = TILED_FROM) -> DataFrame:
    """splits (keys, split_idx, base, reference): with aligned, alignment_distance and is_fallback; weights come from an entry's references.
    step: every which character is compared.

    Splits are dealt out a few neighbours (by split_idx, a number) at a time, so a long entry is shared by many tasks; a split meets its own reference only. A split whose lengths multiply to more than tiled_from is itself
    shared by many tasks, in tiles (if every character is compared).
    """
    kinds = dict(splits.dtypes)
    columns = [*keys, "split_idx", "base", "reference"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, shares = None, None  # of the last reference: those of an entry follow each other
        for pdf in batches:
            got = []
            for b, r, w in zip(pdf["base"], pdf["reference"], pdf.pop("weights"), strict=True):
                reference, weights = r or "", dict(w or {})
                if known != (reference, weights):
                    known, shares = (reference, weights), reference_shares(reference, weights, width, step) if reference and weights else None
                got.append(align_text(b or "", reference, weights, width=width, limit=limit, step=step, shares=shares))
            yield pdf.assign(aligned=[g[0] for g in got], alignment_distance=[g[1] for g in got], is_fallback=[g[2] for g in got])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [cut_out(r.base, r.reference, dict(r.weights), r.distance, r.first, r.last, limit) for r in pdf.itertuples(index=False)]
            yield pdf[columns].assign(aligned=[g[0] for g in got], alignment_distance=[g[1] for g in got], is_fallback=[g[2] for g in got])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "aligned string", "alignment_distance double", "is_fallback boolean"])
    rows = splits.select(*columns).join(raw_weights(splits.select(*keys, "reference"), keys, "reference"), keys, "left")
    # Little data and much work: adaptive execution would gather it in one task, but leaves a number of partitions that is asked for.
    tasks = max(int(splits.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * splits.sparkSession.sparkContext.defaultParallelism)
    dealt = lambda df: df.repartition(tasks, F.xxhash64(*keys, F.floor(F.col("split_idx") / TOGETHER))).sortWithinPartitions(*keys).mapInPandas(run, schema)
    cells = F.coalesce(F.length("base").cast("long") * F.length("reference"), F.lit(0))
    if step != 1 or (splits.agg(F.max(cells)).first()[0] or 0) <= tiled_from:
        return dealt(rows)
    # Texts without a known character are left to align_text, which takes them as they are.
    large = (cells > tiled_from) & F.exists(F.map_keys("weights"), lambda c: F.contains("base", c))
    known = [*keys, "split_idx", F.md5(F.col("base").cast("binary")).alias("_base"), F.md5(F.col("reference").cast("binary")).alias("_reference")]
    ids = [*keys, "split_idx", "_base", "_reference"]
    wide = rows.where(large).select("*", *known[len(keys) + 1 :])
    warped = tiled_warp(wide.dropDuplicates(ids).select(*ids, "base", "reference", "weights"), ids, width=width)
    tiled = wide.join(warped, ids).repartition(tasks, F.xxhash64(*columns)).mapInPandas(finish, schema)
    return dealt(rows.where(~F.coalesce(large, F.lit(False)))).unionByName(tiled)


def locate_text(window: Column, wanted: Column, radii: Sequence[int], centre: Column) -> Column:
    """Where the wanted text begins in a window (from 0), looking first near the centre, then farther; null if nowhere."""
    out = F.lit(None).cast("int")
    for r in reversed(radii):
        lo = F.greatest(centre - r, F.lit(0))
        at = F.instr(F.substring(window, lo + 1, F.lit(2 * r) + F.length(wanted)), wanted)
        out = F.when(at > 0, lo + at - 1).otherwise(out)
    return out
