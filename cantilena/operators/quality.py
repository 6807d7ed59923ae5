"""Word-probability scores, confusion windows and duration histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

BAD, LEAST = 0.4, 0.1


def entry_scores(words: DataFrame, key: str = "entry", digits: int = 4) -> DataFrame:
    """Median probability of an entry's words, rounded; 0 without any."""
    return words.groupBy(key).agg(F.coalesce(F.round(F.median("prob"), digits), F.lit(0.0)).alias("quality_score"))


def segment_scores(words: DataFrame, key: str = "entry", segment: str = "seg", digits: int = 4) -> DataFrame:
    """Each segment's median probability and span; segments without words have no row."""
    return words.groupBy(key, segment).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.round(F.median("prob"), digits).alias("probability"))


def segment_confidence(words: DataFrame, key: str = "entry", segment: str = "seg", digits: int = 4) -> DataFrame:
    """Each segment's mean probability, rounded; words without one don't count, and a segment of none has null."""
    return words.groupBy(key, segment).agg(F.round(F.avg("prob"), digits).alias("confidence"))


def entry_statistics(words: DataFrame, durations: DataFrame, key: str = "entry", segment: str = "seg") -> DataFrame:
    """Counts, words a segment, mean segment duration and words a minute (0 without a duration), to four digits."""
    segments = words.groupBy(key, segment).agg(F.count("*").alias("_w"), (F.max("end") - F.min("start")).alias("_d"))
    out = segments.groupBy(key).agg(F.count("*").alias("segments_count"), F.sum("_w").alias("words_count"), F.avg("_w").alias("_wps"), F.avg("_d").alias("_asd"))
    out = out.join(durations, key, "left")
    wpm = F.when(F.coalesce("duration", F.lit(0.0)) > 0, F.round(F.col("words_count") * 60 / F.col("duration"), 4)).otherwise(0.0)
    return out.select(key, "segments_count", "words_count", F.round("_wps", 4).alias("avg_words_per_segment"), F.round("_asd", 4).alias("avg_segment_duration"), wpm.alias("avg_words_per_minute"))


def worst_segment(scores: Column) -> Column:
    """The least probability of an array of (start, end, probability); null if empty or missing."""
    return F.array_min(F.transform(scores, lambda s: s["probability"]))


def bad_duration() -> Column:
    return F.when(F.col("prob") < BAD, F.greatest(F.col("duration"), F.lit(LEAST))).otherwise(0.0)


def good_duration() -> Column:
    return F.when(F.col("prob") >= BAD, F.col("duration")).otherwise(0.0)


def bad_good_ratio(bad: Column, good: Column) -> Column:
    """Infinity without good duration."""
    return F.when(F.coalesce(good, F.lit(0.0)) == 0, F.lit(float("inf"))).otherwise(bad / F.greatest(good, F.lit(1e-300)))


def confusion_zone(words: DataFrame, key: str = "entry", *, window: float = 120.0, hop: float = 30.0, limit: float = 0.8) -> DataFrame:
    """The first window, from an entry's first word on by hops, whose bad to good ratio exceeds the limit: (key, zone_start, zone_end, ratio).

    Windows run while their end lies before the entry's; an empty one counts as bad. Words are dealt to the windows that they touch, so no
    row meets more than window / hop + 1 of them.
    """
    ends = words.groupBy(key).agg(F.min("start").alias("_s"), F.max("end").alias("_e"))
    last = F.ceil((F.col("_e") - window - F.col("_s")) / hop) - 1
    grid = ends.where(F.col("_s") + window < F.col("_e")).select(key, "_s", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("_k"))
    placed = words.join(ends, key)
    lo = F.greatest(F.floor((F.col("start") - F.col("_s") - window) / hop), F.lit(0)).cast("int")
    hi = F.greatest(F.floor((F.col("end") - F.col("_s")) / hop), F.lit(0)).cast("int")
    at = F.col("_s") + F.col("_k") * hop
    placed = placed.withColumn("_k", F.explode(F.sequence(lo, F.greatest(lo, hi)))).where((F.col("start") < at + window) & (F.col("end") > at))
    sums = placed.groupBy(key, "_k").agg(F.sum(bad_duration()).alias("_b"), F.sum(good_duration()).alias("_g"))
    judged = grid.join(sums, [key, "_k"], "left").withColumn("ratio", bad_good_ratio(F.col("_b"), F.col("_g"))).where(F.col("ratio") > limit)
    first = judged.groupBy(key).agg(F.min(F.struct("_k", "_s", "ratio")).alias("_f"))
    start = F.col("_f._s") + F.col("_f._k") * hop
    return first.select(key, start.alias("zone_start"), (start + window).alias("zone_end"), F.col("_f.ratio").alias("ratio"))


def trailing_window(words: DataFrame, key: str = "entry", *, span: float = 120.0, warm_up: float = 10.0, limit: float = 0.8) -> DataFrame:
    """words with the ratio and mean probability of the window of span seconds before each word's end, and broken: over the limit.

    Null until the words of the window last warm_up seconds.
    """
    # As SQL text: there a range of fractions of a second can be written.
    over = f"over (partition by `{key}` order by `end` range between {float(span)!r}D preceding and current row)"
    rows = words.withColumns({"_bad": bad_duration(), "_good": good_duration(), "_long": F.greatest(F.col("duration"), F.lit(LEAST))})
    out = rows.withColumns({"_b": F.expr(f"sum(_bad) {over}"), "_g": F.expr(f"sum(_good) {over}"), "_t": F.expr(f"sum(_long) {over}"), "_p": F.expr(f"avg(prob) {over}")}).drop("_bad", "_good", "_long")
    warm = F.col("_t") >= warm_up
    out = out.withColumns({"ratio": F.when(warm, bad_good_ratio(F.col("_b"), F.col("_g"))), "mean_prob": F.when(warm, F.col("_p"))})
    return out.withColumn("broken", F.coalesce(F.col("ratio") > limit, F.lit(False))).drop("_b", "_g", "_t", "_p")


def first_break(words: DataFrame, key: str = "entry", *, span: float = 120.0, warm_up: float = 10.0, limit: float = 0.8, silence: float = 60.0, until: float | None = None) -> DataFrame:
    """(key, at, reason): where an aligner that commits these words gives up: the end of the first word whose trailing window is over the
    limit ("ratio"), or silence seconds behind a word that the next one doesn't follow by then ("silence"), whichever comes first.
    until: how far the audio was heard, which counts behind the last word."""
    gap = F.coalesce(F.lead("end").over(W.partitionBy(key).orderBy("end")), F.lit(until).cast("double")) - F.col("end")
    rows = trailing_window(words, key, span=span, warm_up=warm_up, limit=limit).withColumn("_gap", gap)
    at = F.when(F.col("broken"), F.struct(F.col("end").alias("at"), F.lit("ratio").alias("reason"))).when(F.col("_gap") > silence, F.struct((F.col("end") + silence).alias("at"), F.lit("silence").alias("reason")))
    return rows.groupBy(key).agg(F.min(at).alias("_b")).where("_b is not null").select(key, "_b.at", "_b.reason")


def probable_segment_before(segments: DataFrame, times: DataFrame, key: str = "entry", *, hop: float = 30.0, hops: int = 6, least: float = 0.8) -> DataFrame:
    """For each (key, t), the earliest segment of the nearest window of hop seconds before t that has one with mean probability >= least.

    Segments are dealt to slots of hop * hops seconds, so a time meets those of two slots alone.
    """
    slot = lambda c: F.floor(F.col(c) / (hop * hops))
    asked = times.withColumn("_slot", F.explode(F.array(slot("t") - 1, slot("t"))))
    rows = asked.join(segments.where(F.col("prob") >= least).withColumn("_slot", slot("start")), [key, "_slot"]).where(F.col("start") < F.col("t"))
    rows = rows.withColumn("hop", F.floor((F.col("t") - F.col("start")) / hop)).where(F.col("hop") < hops)
    return rows.groupBy(key, "t").agg(F.min(F.struct("hop", "start", "prob")).alias("_m")).select(key, "t", "_m.hop", "_m.start", "_m.prob")


def duration_buckets(segments: DataFrame) -> DataFrame:
    """Hours by probability rounded to a tenth, highest first, with cumulative hours and share."""
    out = segments.groupBy((F.rint(F.col("prob") * 10) / 10).alias("bucket")).agg(F.sum("duration").alias("seconds"))
    w = W.partitionBy().orderBy(F.col("bucket").desc())  # eleven rows
    every = W.partitionBy()
    return out.select("bucket", "seconds", F.sum("seconds").over(w).alias("cum_seconds"), (F.sum("seconds").over(w) / F.sum("seconds").over(every)).alias("cum_share"))


def zero_length(words: DataFrame, key: str = "entry", threshold: float = 0.2) -> DataFrame:
    """Share of words without a length, and whether it is beyond the threshold."""
    share = F.count_if(F.col("end") - F.col("start") == 0) / F.count("*")
    return words.groupBy(key).agg(share.alias("zero_share")).withColumn("failed", F.col("zero_share") > threshold)


def quantised_mode(frames: DataFrame, keys: list[str], value: str = "prob") -> DataFrame:
    """The commonest value of one digit; of equally common ones the least."""
    counted = frames.groupBy(*keys, F.bround(F.col(value), 1).alias("_v")).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(F.max_by("_v", F.struct("_n", -F.col("_v"))).alias("mode"))


def max_logprob(segments: DataFrame, keys: list[str], value: str = "avg_logprob") -> DataFrame:
    """The highest log probability over the segments of each key; negative infinity if none has one."""
    return segments.groupBy(*keys).agg(F.coalesce(F.max(value).cast("double"), F.lit(float("-inf"))).alias("max_logprob"))


def lags_within(samples: DataFrame, value: str, expected: Column, buffer: float = 120.0) -> DataFrame:
    """The lag estimates within buffer seconds of the expected lag, both ends included."""
    return samples.where(F.col(value).between(expected - buffer, expected + buffer))


#: 97.5 % quantiles of Student's t by degrees of freedom: fixed values.
T_975 = {4: 2.776445, 5: 2.570582, 6: 2.446912, 7: 2.364624, 8: 2.306004, 9: 2.262157, 10: 2.228139, 11: 2.200985, 12: 2.178813, 13: 2.160369, 14: 2.144787, 15: 2.131450, 16: 2.119905, 17: 2.109816, 18: 2.100922, 19: 2.093024, 20: 2.085963, 21: 2.079614, 22: 2.073873, 23: 2.068658, 24: 2.063899, 25: 2.059539, 26: 2.055529, 27: 2.051831, 28: 2.048407, 29: 2.045230, 30: 2.042272, 31: 2.039513, 32: 2.036933, 33: 2.034515, 34: 2.032245}


def t_975(freedom: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for k, v in T_975.items() for x in (k, v)]), freedom.cast("int"))


def lag_confidence(samples: DataFrame, key: str, value: str, order: Column, *, most: int = 35, least: int = 5, width: float = 8.0) -> DataFrame:
    """Mean of the first samples of a key (at most most), its 95 % interval, and whether it is narrow enough."""
    first = samples.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("_n") <= most)
    out = first.groupBy(key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), (F.stddev_samp(value) / F.sqrt(F.count("*"))).alias("_se"))
    half = t_975(F.col("n") - 1) * F.col("_se")
    return out.withColumns({"low": F.col("mean") - half, "high": F.col("mean") + half}).withColumn("confident", (F.col("n") >= least) & ((F.col("high") - F.col("low") <= width) | (F.col("n") >= most))).drop("_se")
