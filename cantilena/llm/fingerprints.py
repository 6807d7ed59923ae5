"""Document fingerprints by winnowing, in DataFrame functions alone.

Each k-gram of code points is hashed; of each window of consecutive hashes the least is chosen, the rightmost of equal
ones; chosen hashes keep their positions. Two texts that share a run of WINDOW + GRAM - 1 code points share a fingerprint, and
no shared run shorter than GRAM is seen.

A hash and its position are one long: 31 bits of hash, then the position's complement, so that the least long is the least hash
at the rightmost place.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, text_of

GRAM, WINDOW = 12, 25
#: Bytes of text in a range of documents and in a task, and how many bounds of ranges are looked up.
RANGE, TASK, BOUNDS = 2**20, 2**24, 1024
_LAST = 2**32 - 1
_HIGH = 2**63 - 2**32


def _entry(text: Column, complement: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(_HIGH)).bitwiseOR(complement)


def gram_entries(text: Column, complement: Column) -> Column:
    """The entries of all k-grams; complement is that of the first one's position, a long."""
    grams = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1))
    return F.transform(grams, lambda g, i: _entry(g, complement - i))


def _bound(value: Column, f) -> Column:
    """f(value) with value computed once, though f reads it several times."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def window_minima(entries: Column) -> Column:
    """Of each whole window the least entry. Minima of ever longer stretches: 1, 2, 4, ... places, the last step as long as is left.

    A stretch that reaches beyond the end has the minimum of what there is, and is cut off at last.
    """
    out, covered = entries, 1
    while covered < WINDOW:
        step = min(covered, WINDOW - covered)
        out = _bound(out, lambda a: F.zip_with(a, F.slice(a, step + 1, F.greatest(F.size(a) - step, F.lit(0))), lambda x, y: F.least(x, y)))
        covered += step
    return _bound(out, lambda a: F.slice(a, 1, F.greatest(F.size(a) - (WINDOW - 1), F.lit(0))))


def _short(text: Column, entries: Column) -> Column:
    """The fingerprint of a text without a whole window."""
    return F.when(F.length(text) == 0, F.expr("cast(array() as array<bigint>)")).when(F.size(entries) == 0, F.array(_entry(text, F.lit(_LAST)))).otherwise(F.array(F.array_min(entries)))


def winnow(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the column out: the chosen entries of the text, by position.

    A text shorter than a window has one entry, its least (or that of the whole text, if it is shorter than a k-gram); an empty or null
    text has none.
    """
    df = df.withColumn("_t", text_of(text)).withColumn("_e", gram_entries(F.col("_t"), F.lit(_LAST)))
    df = df.withColumn("_m", window_minima(F.col("_e")))
    return df.withColumn(out, F.when(F.size("_m") > 0, F.array_distinct("_m")).otherwise(_short(F.col("_t"), F.col("_e")))).drop("_t", "_e", "_m")


def hashes(entries: Column) -> Column:
    return F.array_distinct(F.transform(entries, lambda x: F.shiftright(x, 32)))


def positions(entries: Column) -> Column:
    return F.transform(entries, lambda x: F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; 1 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, 1.0).otherwise(both / F.greatest(every, F.lit(1)))


def as_text(entries: Column) -> Column:
    """The entries in hexadecimal, by position: the hash, then the complement of the position to 2^32 - 1, eight digits each."""
    return F.array_join(F.transform(entries, lambda x: F.lpad(F.hex(x), 16, "0")), " ")


def ranges_by_bytes(rows: DataFrame) -> tuple[Column, int]:
    """For rows (doc_id, text): the number of a row's range in the order by descending id, null last, then descending hash of the text, and how
    many tasks the ranges need. Ranges hold RANGE bytes of text on average.

    Quantiles of the ids bound the ranges; more ranges than bounds divide the ids between two bounds evenly. An id that fills ranges by itself,
    null among them, is divided by the hash. One pass over the texts for their size.
    """
    size = rows.agg(
        F.sum(F.octet_length("text")).alias("bytes"),
        F.count("*").alias("n"),
        F.count("doc_id").alias("ids"),
        F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"),
        F.percentile_approx("doc_id", [i / BOUNDS for i in range(1, BOUNDS)], 10 * BOUNDS).alias("bounds"),
    ).first()
    wanted, tasks = math.ceil((size["bytes"] or 0) / RANGE) or 1, math.ceil((size["bytes"] or 0) / TASK) or 1
    down = (F.lit(float(2**63)) - F.xxhash64("text").cast("double")) / float(2**64)  # 0 to 1, by descending hash
    part = lambda n: F.least(F.floor(down * n), n - 1).cast("long")
    nulls = F.lit(math.ceil(wanted * (size["n"] - size["ids"]) / max(1, size["n"])) or 1)
    if not size["ids"]:
        return part(nulls), tasks
    every = max(1, BOUNDS // wanted)  # of the bounds, as many as there are ranges
    met = [(b, len(list(same))) for b, same in itertools.groupby([size["low"], *size["bounds"]])]
    kept = [m for k, m in enumerate(met) if m[1] > 1 or k % every == 0]
    bounds, own = [b for b, _ in kept], [math.ceil(wanted * m / BOUNDS) if m > 1 else 1 for _, m in kept]
    per = math.ceil(wanted / BOUNDS)
    step = math.isqrt(len(bounds)) + 1
    of = lambda values: F.array(*[F.lit(x) for x in values])
    block = F.size(F.filter(of(bounds[::step]), lambda b: b <= F.col("doc_id"))) - 1
    i = block * step + F.size(F.filter(F.get(F.array(*[of(bounds[k : k + step]) for k in range(0, len(bounds), step)]), block), lambda b: b <= F.col("doc_id"))) - 1
    low, high, parts = (F.get(of(x), i) for x in (bounds, [*bounds[1:], size["high"] + 1], own))
    share = (F.col("doc_id") - low).cast("double") / F.greatest(high - low, F.lit(1)).cast("double")
    inside = F.when((F.col("doc_id") == low) & (parts > 1), per + part(parts)).otherwise(per - 1 - F.least(F.floor(share * per), F.lit(per - 1)))
    span = per + max(own)
    return F.when(F.col("doc_id").isNull(), len(bounds) * span + part(nulls)).otherwise((len(bounds) - 1 - i) * span + inside).cast("long"), tasks


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, text, edited, entries, edited_entries, near_edited, near_next), one a document.

    The edited text has its last third replaced by as much of the next document's beginning, by descending id; the first
    follows the last. Documents are dealt by ranges of the id of a bounded size in bytes, and the tasks grow in number with the bytes: one
    shuffle of the texts; only the first document of each range crosses over to another one.

    Null or empty text: empty, without entries. Null ids come last; rows that repeat an id go by hash and text. A single document
    is its own next. An empty table gives no rows. Other columns are dropped.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    bucket, tasks = ranges_by_bytes(rows)
    tasks = max(tasks, 2 * docs.sparkSession.sparkContext.defaultParallelism)  # small tables use all cores too
    plain = rows.withColumn("_bucket", bucket)
    rows = plain.repartition(tasks, "_bucket")
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc(), F.col("text").desc()]
    here = W.partitionBy("_bucket").orderBy(*order)
    # The first document of each range goes to the range before it.
    firsts = plain.groupBy("_bucket").agg(F.max_by("text", F.struct(F.coalesce("doc_id", F.lit(-(2**63))), F.xxhash64("text"), "text")).alias("_text"))
    firsts = cut(winnow(firsts, "_text", "_entries").select("_bucket", "_text", hashes(F.col("_entries")).alias("_hashes")))
    every = W.partitionBy().orderBy("_bucket")  # a number a range
    following = firsts.select("_bucket").withColumn("_after", F.coalesce(F.lead("_bucket").over(every), F.first("_bucket").over(every)))
    over = firsts.select(F.col("_bucket").alias("_after"), F.col("_text").alias("_over_text"), F.col("_hashes").alias("_over_hashes"))
    firsts = following.join(over, "_after").drop("_after")
    rows = rows.withColumn("_next", F.lead("text").over(here)).join(firsts, "_bucket").withColumn("_last", F.col("_next").isNull()).withColumn("_next", F.coalesce("_next", "_over_text")).drop("_over_text")
    n = F.length("text")
    rows = rows.withColumn("_q", F.floor(n / 3).cast("int")).withColumn("_p", n - F.col("_q"))
    rows = rows.withColumn("_new", F.substring(F.col("_next"), F.lit(1), F.col("_q"))).drop("_next")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("_p")), "_new"))
    rows = rows.withColumn("_e", gram_entries(F.col("text"), F.lit(_LAST))).withColumn("_m", window_minima(F.col("_e")))
    rows = rows.withColumn("entries", F.when(F.size("_m") > 0, F.array_distinct("_m")).otherwise(_short(F.col("text"), F.col("_e"))))
    # What the edit leaves alone keeps its entries (up to _same) and its minima (up to _kept).
    same = F.greatest(F.col("_p") - (GRAM - 1), F.lit(0))
    rows = rows.withColumn("_same", same).withColumn("_kept", F.greatest(F.col("_same") - (WINDOW - 1), F.lit(0)))
    tail = F.concat(F.substring(F.col("text"), F.col("_same") + 1, F.col("_p") - F.col("_same")), "_new")
    rows = rows.withColumn("_first", F.lit(_LAST) - F.col("_same").cast("long"))
    rows = rows.withColumn("_tail", F.concat(F.slice("_e", F.col("_kept") + 1, F.col("_same") - F.col("_kept")), gram_entries(tail, F.col("_first"))))
    # Chosen places never go back, so the minima that stay are the entries up to the last of them.
    low = lambda x: x.bitwiseAND(F.lit(_LAST))
    rows = rows.withColumn("_stop", F.when(F.col("_kept") > 0, low(F.get("_m", F.col("_kept") - 1)))).drop("_e", "_m")
    rows = rows.withColumn("_tm", window_minima(F.col("_tail")))
    stay = F.when(F.col("_kept") > 0, F.filter("entries", lambda x: low(x) >= F.col("_stop"))).otherwise(F.expr("cast(array() as array<bigint>)"))
    rows = rows.withColumn("_stay", stay)
    rows = rows.withColumn("edited_entries", F.when(F.size("_stay") + F.size("_tm") > 0, F.array_distinct(F.concat("_stay", "_tm"))).otherwise(_short(F.col("edited"), F.col("_tail"))))
    rows = rows.select("doc_id", "text", "edited", "entries", "edited_entries", "_bucket", "_last", "_over_hashes", hashes(F.col("entries")).alias("_h"), hashes(F.col("edited_entries")).alias("_eh"))
    rows = rows.withColumn("_nh", F.coalesce(F.lead("_h").over(here), "_over_hashes"))
    return rows.select("doc_id", "text", "edited", "entries", "edited_entries", likeness(F.col("_h"), F.col("_eh")).alias("near_edited"), likeness(F.col("_h"), F.col("_nh")).alias("near_next"))
