"""Offsets, islands, intervals and nearest times: ordered-sequence operators as windows.

keys name the columns of an entry; rows of an entry are ordered by order, which must be total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _order(keys: list[str], order: list):
    return W.partitionBy(*keys).orderBy(*order)


def text_offsets(rows: DataFrame, keys: list[str], order: list, text: str = "text") -> DataFrame:
    """rows with start_loc (inclusive) and end_loc (exclusive) in the concatenated text of an entry."""
    w, n = _order(keys, order), F.length(F.coalesce(F.col(text), F.lit("")))
    return rows.withColumn("start_loc", F.coalesce(F.sum(n).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("end_loc", F.col("start_loc") + n)


def with_next(rows: DataFrame, keys: list[str], order: list, ts: str = "ts") -> DataFrame:
    """rows with next_ts; the last row's is its own."""
    return rows.withColumn("next_ts", F.coalesce(F.lead(ts).over(_order(keys, order)), F.col(ts)))


def merge_equal_times(rows: DataFrame, keys: list[str], order: list, ts: str = "ts") -> DataFrame:
    """Consecutive rows of equal time as one slice: (keys, grp, ts, start_loc, end_loc, n)."""
    w = _order(keys, order)
    change = F.when(F.col(ts).eqNullSafe(F.lag(ts).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return rows.withColumn("_c", change).withColumn("grp", F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, 0))).groupBy(*keys, "grp").agg(F.first(ts).alias(ts), F.min("start_loc").alias("start_loc"), F.max("end_loc").alias("end_loc"), F.count("*").alias("n"))


def captions(slices: DataFrame, keys: list[str], text: DataFrame, *, emit_tail: bool = False) -> DataFrame:
    """Slices (keys, ts, start_loc, end_loc) as captions (keys, pos, start, end, text) of the entries' whole text.

    Text before the first slice is a caption from 0 to the first time. A slice lasts until the next; the last one is left out, unless
    emit_tail.
    """
    w = _order(keys, ["ts", "start_loc"])
    rows = slices.withColumns({"_next": F.lead("ts").over(w), "_n": F.row_number().over(w)})
    body = rows.where(F.col("_next").isNotNull() | F.lit(emit_tail)).select(*keys, F.col("_n").alias("pos"), F.col("ts").alias("start"), F.coalesce("_next", "ts").alias("end"), "start_loc", "end_loc")
    head = rows.where("_n = 1 and start_loc > 0").select(*keys, F.lit(0).alias("pos"), F.lit(0.0).cast(rows.schema["ts"].dataType).alias("start"), F.col("ts").alias("end"), F.lit(0).cast(rows.schema["start_loc"].dataType).alias("start_loc"), F.col("start_loc").alias("end_loc"))
    part = F.substring(F.col("text"), F.col("start_loc") + 1, F.col("end_loc") - F.col("start_loc"))
    return body.unionByName(head).join(text.select(*keys, "text"), keys).select(*keys, "pos", "start", "end", F.trim(part).alias("text"))


def islands(rows: DataFrame, keys: list[str], order: list, flag: Column) -> DataFrame:
    """Runs of rows whose flag holds: (keys, island, first_at, last_at, n) with row numbers from 0."""
    w = _order(keys, order)
    rows = rows.withColumns({"_f": F.coalesce(flag, F.lit(False)), "_i": F.row_number().over(w) - 1})
    rows = rows.withColumn("_g", F.sum(F.when(F.col("_f"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.where("_f").groupBy(*keys, F.col("_g").alias("island")).agg(F.min("_i").alias("first_at"), F.max("_i").alias("last_at"), F.count("*").alias("n"))


def tightened(ranges: DataFrame, by: float, start: str = "start", end: str = "end") -> DataFrame:
    """Ranges shrunk at both ends; collapsed ones go."""
    return ranges.withColumns({start: F.col(start) + by, end: F.col(end) - by}).where(F.col(start) < F.col(end))


def complement(ranges: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """What disjoint ranges (keys, start, end) leave of [0, total] (keys, total)."""
    w = _order(keys, ["start", "end"])
    edge = totals.select(*keys, F.col("total").alias("start"), F.col("total").alias("end"))
    rows = ranges.select(*keys, "start", "end").unionByName(edge).withColumn("_from", F.lag("end", 1, 0.0).over(w))
    return rows.where("_from < start").select(*keys, F.col("_from").alias("start"), F.col("start").alias("end"))


def union_ranges(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and touching ranges as one: (keys, start, end, n)."""
    w = _order(keys, ["start", "end"])
    before = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = ranges.withColumn("_new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("_g", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).drop("_g")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], ts: str, payload: list[str]) -> DataFrame:
    """Each left row with the payload of the right row of its keys nearest in time (ties: the earlier), and the gap.

    One shuffle: both sides are sorted together, and the last right row is carried along, forwards and backwards: linear in the rows of a
    key. Of right rows of one time the least payload counts. Without any right row the payload and the gap are null.
    """
    held = F.struct(F.col(ts).alias("ts"), *[F.col(c) for c in payload])
    lcols = [c for c in left.columns if c not in (*keys, ts)]
    a = left.select(*keys, ts, F.struct(*lcols).alias("_l"), F.lit(None).cast(right.select(held.alias("r")).schema["r"].dataType).alias("_r"))
    b = right.select(*keys, ts, F.lit(None).cast(a.schema["_l"].dataType).alias("_l"), held.alias("_r"))
    both = a.unionByName(b)
    carried = lambda at: F.last("_r", True).over(W.partitionBy(*keys).orderBy(at, F.col("_r").isNull(), F.col("_r").desc()).rowsBetween(W.unboundedPreceding, W.currentRow))
    both = both.withColumns({"_before": carried(F.col(ts)), "_after": carried(F.col(ts).desc())}).where("_l is not null")
    gap_b, gap_a = F.col(ts) - F.col("_before.ts"), F.col("_after.ts") - F.col(ts)
    pick = F.when(gap_a.isNull() | (gap_b <= gap_a), F.col("_before")).otherwise(F.col("_after"))
    return both.withColumn("_p", pick).select(*keys, ts, "_l.*", *[F.col("_p")[c].alias(c) for c in payload], F.abs(F.col("_p.ts") - F.col(ts)).alias("gap"))


def _level(length: Column, span: float) -> Column:
    """The level of a dyadic hierarchy of bins, span * 2 ** level long, at which a range of this length lies in two bins at most."""
    return F.greatest(F.ceil(F.log2(F.greatest(length, F.lit(float(span))) / span)), F.lit(0)).cast("int")


def _bin(at: Column, level: Column, span: float) -> Column:
    return F.floor(at / (F.lit(float(span)) * F.pow(F.lit(2.0), level)))


def containing(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: str, end: str, span: float = 1000.0) -> DataFrame:
    """Each point with the first range of its keys that holds it, both ends included; points without one go.

    Ranges lie in bins of the level that fits their length, two at most; a point looks into one bin of each level that ranges have. span: the length of the least bins. Equal
    points share one search and come back as often as they are.
    """
    leveled = ranges.withColumn("_level", _level(F.col(end) - F.col(start), span))
    levels = [r[0] for r in leveled.select("_level").distinct().sort("_level").collect() if r[0] is not None]  # one a level: at most 64
    dealt = leveled.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_level"), span), F.greatest(_bin(F.col(start), F.col("_level"), span), _bin(F.col(end), F.col("_level"), span)))))
    once = points.groupBy(*points.columns).agg(F.count("*").alias("_n"))
    asked = once.withColumn("_id", F.struct(*points.columns)).withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>"))).withColumn("_bin", _bin(F.col(at), F.col("_level"), span))
    rows = asked.join(dealt, [*keys, "_level", "_bin"]).where((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end)))
    rest = [c for c in ranges.columns if c not in keys]
    best = rows.groupBy("_id").agg(F.min(F.struct(start, *[c for c in rest if c != start])).alias("_r"), F.first("_n").alias("_n"))
    return best.select("_id", "_r", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select("_id.*", *[F.col("_r")[c].alias(c) for c in rest])


def interpolated_time(at: Column, start_loc: Column, end_loc: Column, ts: Column, next_ts: Column) -> Column:
    """The time of a place in a slice, linearly between its own and the next slice's."""
    share = F.when(end_loc > start_loc, (at - start_loc) / (end_loc - start_loc)).otherwise(0.0)
    return ts + share * (next_ts - ts)


def overlapping(a: DataFrame, b: DataFrame, keys: list[str], span: float) -> DataFrame:
    """Pairs of ranges that overlap (open ends). span: the length of the least bins of a dyadic hierarchy.

    Ranges lie in the bins, two at most, of each level from the one that fits their length up to the highest of the other side. A pair is made at the level of its longer range, in the bin
    where its later start lies, so once. Rows of a range grow with the logarithm of lengths, not with its length.
    """
    left = a.withColumn("_fits", _level(F.col("end") - F.col("start"), span))
    right = b.select(*keys, *[F.col(c).alias(f"other_{c}") for c in b.columns if c not in keys]).withColumn("_other_fits", _level(F.col("other_end") - F.col("other_start"), span))
    top_a, top_b = left.agg(F.max("_fits")).first()[0] or 0, right.agg(F.max("_other_fits")).first()[0] or 0

    def dealt(rows: DataFrame, start: str, end: str, fits: str, top: int) -> DataFrame:
        rows = rows.withColumn("_level", F.explode(F.sequence(F.col(fits), F.greatest(F.col(fits), F.lit(top)))))
        return rows.withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_level"), span), F.greatest(_bin(F.col(start), F.col("_level"), span), _bin(F.col(end), F.col("_level"), span)))))

    hit = dealt(left, "start", "end", "_fits", top_b).join(dealt(right, "other_start", "other_end", "_other_fits", top_a), [*keys, "_level", "_bin"])
    hit = hit.where((F.col("start") < F.col("other_end")) & (F.col("end") > F.col("other_start")) & (F.col("_level") == F.greatest("_fits", "_other_fits")))
    return hit.where(F.col("_bin") == _bin(F.greatest("start", "other_start"), F.col("_level"), span)).drop("_level", "_bin", "_fits", "_other_fits")


def slice_text(index: DataFrame, ranges: DataFrame, text: DataFrame, keys: list[str], pad: float = 0.0) -> DataFrame:
    """ranges with the text of the slices (keys, ts, start_loc, end_loc) from the one nearest to start - pad to the one nearest to
    end + pad, grown outwards to natural cuts. Ranges without text raise an error; those of keys without a slice go."""
    rows, found = ranges.distinct(), index.select(*keys, "ts", "start_loc", "end_loc")
    for name, at in (("a", F.col("start") - pad), ("b", F.col("end") + pad)):
        rows = nearest(rows.withColumn("ts", at), found, keys, "ts", ["start_loc", "end_loc"]).drop("ts", "gap").withColumnsRenamed({"start_loc": f"_{name}_start", "end_loc": f"_{name}_end"})
    rows = rows.where("_a_start is not null").withColumns({"_lo": F.least("_a_start", "_b_start"), "_hi": F.greatest("_a_end", "_b_end")}).join(text, keys)
    cuts = F.filter(F.transform(F.split("text", ""), lambda c, i: F.when(c.rlike(r"(?U)^[\s.,;!?()\[\]{}]$"), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_cuts", F.concat(F.array(F.lit(0)), cuts))
    lo = F.coalesce(F.array_max(F.filter("_cuts", lambda c: c < F.col("_lo"))), F.lit(0))
    hi = F.coalesce(F.array_min(F.filter("_cuts", lambda c: c > F.col("_hi"))), F.length("text"))
    part = F.substring(F.col("text"), lo + 1, (hi - lo).cast("int"))
    return rows.withColumn("slice", F.when(F.length(part) > 0, part).otherwise(F.raise_error(F.lit("no text for a range")).cast("string"))).select(*ranges.columns, "slice")


def monotone(rows: DataFrame, keys: list[str], order: list, ts: str = "ts", lead_in: float = 3.0) -> DataFrame:
    """Only rows whose time exceeds all times before it; leading zeros become the first later time less lead_in."""
    w = _order(keys, order)
    first = F.first(F.when(F.col(ts) > 0, F.col(ts)), True).over(w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    before = F.max(ts).over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumns({"_first": first, "_max": before})
    lead = (F.col(ts) == 0) & F.coalesce(F.col("_max") == 0, F.lit(True))
    keep = lead & F.col("_max").isNull() | F.coalesce(F.col(ts) > F.col("_max"), F.col(ts) > 0)
    return rows.where(keep).withColumn(ts, F.when(lead, F.greatest(F.col("_first") - lead_in, F.lit(0))).otherwise(F.col(ts))).drop("_first", "_max")
