"""Quality rules: thresholds adapt to each language and source by mergeable quantile sketches.

A sketch here is a histogram over logarithmic buckets: a quantile read from it is within 1 % of the true one,
histograms add up in any order, and equal inputs give equal sketches whatever the partitions. Sketches of a language
are sums of those of its sources, and serve where a source has too few documents or quartiles that are equal; the sum
of all serves where a language has, too.

A statistic is a rate with a little added above and below, so it is never 0 and a long text needs a smaller share of
symbols than a short one to be as odd. A limit is the upper quartile times the quartiles' ratio to the power of the
statistic's reach, which in buckets is a whole number: nothing of it is fixed but the reach.
"""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from .common import cut, keeps_columns, text_of

SYMBOLS = "#*$%&|<>"
GAMMA = 1.01 / 0.99
#: name: (value from the counts, reach, whether low values fail too)
STATISTICS = {
    "word_length": ("word_chars / n_words", 3, True),
    "symbols": ("(n_symbols + 1) / (word_chars + 100)", 3, False),
    "dup_lines": ("(n_dup_lines + 1) / (n_text_lines + 10)", 2, False),
    "repeats": ("(n_repeat_words + 3) / (n_words + 100)", 3, False),
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines"]
MIN_DOCS, MIN_WORDS, MAX_REPEATED = 100, 50, 50
#: The most rows (of about 300 bytes) of limits that are broadcast.
MAX_BROADCAST = 20_000


def counts_of(text: str) -> tuple[int, int, int, int, int, int]:
    """The counts of COUNTS for one whole text."""
    raw = text.encode()
    words = raw.split()  # bytes split at ASCII white space alone
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0, 0
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\f\r")
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeats = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        end = 0  # positions before it are counted
        for i, x in enumerate(windows):
            if seen[x] > 1:
                repeats += i + 3 - max(i, end)
                end = i + 3
    return n, chars, symbols, dup, repeats, len(lines)


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def _counts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([counts_of(x) for x in texts], columns=COUNTS, dtype="int64")


def text_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the columns of COUNTS and base_failed; input columns of these names are replaced."""
    docs = docs.drop(*COUNTS, "base_failed", "_counts")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return docs.withColumn("_counts", _counts(text_of(text_col))).select(*docs.columns, "_counts.*").withColumn("base_failed", base)


def bucket(value: Column) -> Column:
    """The bucket (GAMMA^(b-1), GAMMA^b] of a value above 0."""
    return F.ceil(F.round(F.ln(value) / math.log(GAMMA), 6)).cast("int")


def bucket_value(b: Column) -> Column:
    return F.pow(F.lit(GAMMA), b.cast("double")) * 2 / (GAMMA + 1)


def sketches(counted: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by..., stat, b, n): the histograms of the documents that pass the base rules."""
    values = F.array(*[F.struct(F.lit(k).alias("stat"), bucket(F.expr(v[0])).alias("b")) for k, v in STATISTICS.items()])
    return counted.where("not base_failed").select(*by, F.explode(values).alias("_s")).groupBy(*by, "_s.stat", "_s.b").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "stat", "b").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Rows (by..., stat, n, lo, hi): the documents of a group, and the buckets of its quartiles."""
    group = W.partitionBy(*by, "stat")  # as many rows as buckets
    rows = sketch.withColumns({"_cum": F.sum("n").over(group.orderBy("b")), "_all": F.sum("n").over(group)})
    at = lambda q: F.min(F.when(F.col("_cum") >= F.ceil(F.col("_all") * q), F.col("b")))
    return rows.groupBy(*by, "stat").agg(F.first("_all").alias("n"), at(0.25).alias("lo"), at(0.75).alias("hi"))


def thresholds(counted: DataFrame, *, lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows (_lang, _source, _bounds): for each statistic the lowest and the highest bucket allowed, and whose sketch says so: source, lang or all."""
    pair = cut(sketches(counted.select(F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), *COUNTS, "base_failed"), ["_lang", "_source"]))
    own = quartiles(pair, ["_lang", "_source"]).withColumnsRenamed({"n": "_n1", "lo": "_lo1", "hi": "_hi1"})
    lang = quartiles(merged(pair, ["_lang"]), ["_lang"]).select(F.col("_lang").alias("_l2"), F.col("stat").alias("_s2"), F.col("n").alias("_n2"), F.col("lo").alias("_lo2"), F.col("hi").alias("_hi2"))
    every = quartiles(merged(pair, []), []).select("stat", F.col("lo").alias("_lo3"), F.col("hi").alias("_hi3"))
    rows = own.join(lang, F.col("_lang").eqNullSafe(F.col("_l2")) & (F.col("stat") == F.col("_s2")), "left").join(F.broadcast(every), "stat")  # every: a row a statistic
    fit = lambda i: (F.col(f"_n{i}") >= min_docs) & (F.col(f"_lo{i}") < F.col(f"_hi{i}"))
    level = F.when(fit(1), "source").when(fit(2), "lang").otherwise("all")
    lo, hi = (F.when(fit(1), F.col(f"_{x}1")).when(fit(2), F.col(f"_{x}2")).otherwise(F.col(f"_{x}3")) for x in ("lo", "hi"))
    reach = F.coalesce(*[F.when(F.col("stat") == k, v[1]) for k, v in STATISTICS.items()]) * (hi - lo)
    bounds = F.struct("stat", F.struct((lo - reach).alias("low"), (hi + reach).alias("high"), level.alias("level")))
    return rows.groupBy("_lang", "_source").agg(F.map_from_entries(F.collect_list(bounds)).alias("_bounds"))  # four entries


def judged(counted: DataFrame, limits: DataFrame, *, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """counted with kept, and rule: what failed first ("base" or a statistic; null if kept)."""
    limits = cut(limits)  # a row for each language and source
    if limits.count() <= MAX_BROADCAST:  # else the rows of counted are shuffled to them
        limits = F.broadcast(limits)
    counted = counted.drop("kept", "rule")
    joined = counted.join(limits, counted[lang_col].eqNullSafe(limits["_lang"]) & counted[source_col].eqNullSafe(limits["_source"]), "left")
    rule = F.when(F.col("base_failed"), "base")
    for k, v in STATISTICS.items():
        value, bound = bucket(F.expr(v[0])), F.col("_bounds")[k]
        bad = value > bound["high"]
        rule = rule.when(bad | (value < bound["low"]) if v[2] else bad, k)
    return joined.withColumn("rule", rule).select(*counted.columns, F.col("rule").isNull().alias("kept"), "rule")


@keeps_columns
def quality_rules(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep_texts: bool = True) -> DataFrame:
    """docs with COUNTS, base_failed, kept and rule.

    A document fails by the base rules (too few words, too many repeated ones), or if a statistic lies beyond its fence, the
    quartile of its language and source times the quartiles' ratio to the power of the statistic's reach.
    keep_texts: counts run twice over the texts instead of carrying texts through a shuffle or a checkpoint; without it
    the text column goes and counts are made once.

    Null or empty text: no words, base_failed. Null lang or source: a group of its own. An empty table gives an empty
    one. Input columns with the names of the results are replaced; others pass through.
    """
    if keep_texts:
        narrow = text_counts(docs.select(text_col, lang_col, source_col), text_col)
        return judged(text_counts(docs, text_col), thresholds(narrow, lang_col=lang_col, source_col=source_col), lang_col=lang_col, source_col=source_col)
    counted = cut(text_counts(docs, text_col).drop(text_col))
    return judged(counted, thresholds(counted, lang_col=lang_col, source_col=source_col), lang_col=lang_col, source_col=source_col)
