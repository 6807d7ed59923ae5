"""Registered queries: the library's operators over the driver's tables, whole.

events stand for words (user_id the entry, value / 100 the duration and, up to 1, the probability), documents for
transcripts, conversations for captions, pages for protocols, orders for sessions, embeddings for histograms.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from functools import cache
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .functions import text as T
from .functions.hashes import xxhash64
from .operators import clusters as K
from .operators import lags as G
from .operators import matching as M
from .operators import packing as P
from .operators import quality as Q
from .operators import relational as R
from .operators import scans as X
from .operators import sequential as S
from .operators import timeline as L
from .operators.neighbours import most_alike
from .plans import corpus, recovery
from .sources import captions as C
from .sources import sinks
from .streaming import words as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
HOUR = 3600.0


def query(f):
    QUERIES[f.__name__] = f
    return f


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _words(spark: SparkSession, sf: str) -> DataFrame:
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    duration = F.col("value") / 100
    return _t(spark, sf, "events").select(F.col("user_id").alias("entry"), "event_id", "event_type", start.alias("start"), (start + duration).alias("end"), duration.alias("duration"), F.least(duration, F.lit(1.0)).alias("prob"))


def _segmented(spark: SparkSession, sf: str) -> DataFrame:
    return _words(spark, sf).withColumn("seg", F.floor(F.col("start") / 86400))


def _captions(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("text"))


@query
def quality_bucket_hours(spark, sf):
    out = Q.duration_buckets(_words(spark, sf))
    return out.select("bucket", F.round("seconds", 4).alias("seconds"), F.round("cum_seconds", 4).alias("cum_seconds"), F.round("cum_share", 6).alias("cum_share"))


@query
def entry_quality_score(spark, sf):
    return Q.entry_scores(_words(spark, sf), digits=6)


@query
def segment_quality_score(spark, sf):
    return Q.segment_scores(_segmented(spark, sf), digits=6).select("entry", "seg", "probability")


@query
def entry_statistics(spark, sf):
    words = _segmented(spark, sf)
    durations = words.groupBy("entry").agg((F.max("end") - F.min("start")).alias("duration"))
    out = Q.entry_statistics(words, durations)
    return out.select("entry", "segments_count", "words_count", *[F.round(c, 2).alias(c) for c in ("avg_words_per_segment", "avg_segment_duration", "avg_words_per_minute")])


@query
def normalized_entries(spark, sf):
    words = _segmented(spark, sf)
    durations = words.groupBy("entry").agg((F.max("end") - F.min("start")).alias("duration"))
    out = corpus.normalized_entries(words, durations)
    return out.select("entry", "segments_count", F.round("quality_score", 3).alias("quality_score"), F.round(Q.worst_segment(F.col("per_segment_quality_scores")), 3).alias("worst"))


@query
def source_stats(spark, sf):
    n = F.col("n_chars").cast("double")
    splits = F.array(F.struct(F.lit(0.0).alias("start"), (n / 2).alias("end")), F.struct((n / 2).alias("start"), n.alias("end")))
    out = R.source_statistics(_t(spark, sf, "documents").select("source", splits.alias("splits")))
    return out.select("source", "total", "episodes", "segments", "duration", "longest")


@query
def subtitle_coverage(spark, sf):
    docs = R.with_any(_t(spark, sf, "documents"), _t(spark, sf, "labels"), keys=["doc_id"])
    out = R.coverage(docs, F.col("n_chars") / HOUR, F.col("found"))
    return out.select("files", "covered_files", F.round("hours", 6).alias("hours"), F.round("covered_hours", 6).alias("covered_hours"), F.round("percent", 6).alias("percent"))


@query
def manifest(spark, sf):
    scores = Q.entry_scores(_words(spark, sf), digits=6).select(F.lit("events").alias("source_type"), F.col("entry").cast("string").alias("source_entry_id"), "quality_score")
    docs = _t(spark, sf, "documents").select(F.lit("documents").alias("source_type"), F.col("source").alias("source_id"), F.col("doc_id").cast("string").alias("source_entry_id"))
    return R.manifest([scores, docs], ["source_type", "source_id", "source_entry_id", "quality_score", "duration"])


@query
def session_join_lang(spark, sf):
    sessions = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("document_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("created_at"))
    docs = _t(spark, sf, "customer").select(F.col("c_custkey").alias("document_id"), F.col("c_mktsegment").alias("lang"), F.col("c_nationkey").alias("user_id"))
    users = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("user_id"), F.col("n_name").alias("user"))
    return R.session_rows(sessions, docs, users, ["BUILDING", "MACHINERY"], "F").select("id", "lang", "user")


@query
def pending_entries(spark, sf):
    return R.pending(_t(spark, sf, "documents"), _t(spark, sf, "labels"), ["doc_id"]).select("doc_id", "source")


@query
def largest_per_group(spark, sf):
    kind = F.when(F.col("o_orderstatus") == "F", ".mp4").otherwise(".avi")
    files = _t(spark, sf, "orders").select("o_custkey", F.concat(F.col("o_orderkey").cast("string"), kind).alias("path"), F.col("o_totalprice").alias("size"))
    return R.best_media(files, "o_custkey")


@query
def first_seen_session(spark, sf):
    return R.earliest(_t(spark, sf, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("first_us")), "user_id", "first_us")


@query
def train_test_split(spark, sf):
    docs = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id")
    rows = docs.select("doc_id", "source", (F.col("quality") == 0).alias("skipped"), F.when(F.col("toxic") == 1, F.array(F.lit("retranscribe"))).alias("attributes"))
    split = lambda s: R.curated(rows, drop_source="src0", test_sources=["src1", "src2"], split=s)
    out = R.union_splits(train=split("train"), test=split("test"))
    return out.select(R.uuid_of(F.col("source"), F.col("doc_id").cast("string")).alias("uuid"), "split")


@query
def dedup_keep_first(spark, sf):
    return R.keep_first(_t(spark, sf, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest")), ["digest"], [F.col("doc_id")])


@query
def first_match_lookup(spark, sf):
    parts = _t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_linenumber") * 100_000_000 + F.col("l_partkey")).alias("_place"), "l_partkey")
    return R.lookup_first(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), parts, "o_orderkey", "_place").select("o_orderkey", "o_custkey", "l_partkey")


@query
def complete_entries(spark, sf):
    media, index = _t(spark, sf, "customer").select("c_custkey"), _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return R.complete_entries(media, index, _t(spark, sf, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query
def sidecar_spans(spark, sf):
    offsets = L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"])
    spans = offsets.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "start_loc", "end_loc"))), lambda x: F.array(x["start_loc"].cast("double"), x["end_loc"].cast("double"))).alias("splits"))
    files = _captions(spark, sf).select("conv_id", F.col("turn").cast("int").alias("segment"))
    return R.sidecar(files, spans, "conv_id", "segment")


@query
def ordered_text(spark, sf):
    return R.ordered_concat(_captions(spark, sf), "conv_id", "turn", "text", " ").select("conv_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def work_batches(spark, sf):
    return R.batches(_t(spark, sf, "documents").select("doc_id", "source"), [F.col("doc_id")], 200, "source")


@query
def playlist_leaves(spark, sf):
    region, nation, customer = (_t(spark, sf, n) for n in ("region", "nation", "customer"))
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    items = region.select(key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("title"), F.lit(None).cast("string").alias("url"))
    items = items.unionByName(nation.select(key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent"), F.col("n_name").alias("title"), F.lit(None).cast("string").alias("url")))
    items = items.unionByName(customer.select(key("c", "c_custkey").alias("id"), key("n", "c_nationkey").alias("parent"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("url")))
    return R.descendants(items).select("root", "id", "title")


@query
def caption_offsets(spark, sf):
    return L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"]).select("conv_id", "turn", "start_loc", "end_loc")


def _hourly(spark, sf):
    words = _words(spark, sf).withColumn("ts", F.floor(F.col("start") / HOUR) * HOUR).withColumn("text", F.lit("word "))
    return L.text_offsets(words, ["entry"], ["start", "event_id"])


@query
def merge_equal_ts(spark, sf):
    return L.merge_equal_times(_hourly(spark, sf), ["entry"], ["start", "event_id"]).select("entry", "grp", F.col("ts").cast("double").alias("ts"), "start_loc", "end_loc", "n")


@query
def timed_captions(spark, sf):
    rows = _hourly(spark, sf)
    slices = L.merge_equal_times(rows, ["entry"], ["start", "event_id"]).where("grp > 1").select("entry", F.col("ts").cast("double").alias("ts"), "start_loc", "end_loc")
    text = rows.groupBy("entry").agg(F.repeat(F.lit("word "), F.count("*").cast("int")).alias("text"))
    out = L.captions(slices, ["entry"], text)
    return out.select("entry", "pos", "start", "end", F.length("text").alias("n_chars"))


@query
def silence_islands(spark, sf):
    return L.islands(_words(spark, sf), ["entry"], ["start", "event_id"], F.col("prob") < 0.4).select("entry", "first_at", "last_at", "n")


@query
def speech_complement(spark, sf):
    words = _words(spark, sf).withColumn("_at", F.row_number().over(W.partitionBy("entry").orderBy("start", "event_id")) - 1)
    quiet = L.islands(_words(spark, sf), ["entry"], ["start", "event_id"], F.col("prob") < 0.4)
    ranges = L.tightened(quiet.select("entry", F.col("first_at").cast("double").alias("start"), (F.col("last_at") + 1).cast("double").alias("end")), 0.3)
    totals = words.groupBy("entry").agg((F.max("_at") + 1).cast("double").alias("total"))
    return L.complement(ranges, totals, ["entry"]).select("entry", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"))


@query
def interval_union(spark, sf):
    ranges = _words(spark, sf).select("entry", "start", (F.col("start") + F.col("duration") * 3600).alias("end"))
    return L.union_ranges(ranges, ["entry"]).select("entry", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "n")


@query
def nearest_asof(spark, sf):
    words = _words(spark, sf)
    one = words.where("event_type = 'click'").select("entry", F.col("start").alias("ts"), "event_id")
    two = words.where("event_type = 'purchase'").select("entry", F.col("start").alias("ts"), F.col("event_id").alias("other_id"))
    out = L.nearest(one, two, ["entry"], "ts", ["other_id"])
    return out.select("entry", "event_id", "other_id", F.round("gap", 6).alias("gap"))


@query
def interval_containment(spark, sf):
    offsets = L.with_next(L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"]).withColumn("ts", F.col("turn") * 10.0), ["conv_id"], ["turn"])
    points = offsets.groupBy("conv_id").agg(F.max("end_loc").alias("_n")).select("conv_id", F.explode(F.array(*[F.floor(F.col("_n") * q) for q in (0.25, 0.5, 0.75)])).alias("at")).distinct()
    out = L.containing(points, offsets.select("conv_id", "start_loc", "end_loc", "turn", "ts", "next_ts"), ["conv_id"], "at", "start_loc", "end_loc")
    time = L.interpolated_time(F.col("at"), F.col("start_loc"), F.col("end_loc"), F.col("ts"), F.col("next_ts"))
    return out.select("conv_id", "at", "turn", F.round(time, 4).alias("time"))


@query
def interval_overlap(spark, sf):
    words = _words(spark, sf)
    span = lambda k: words.where(f"event_type = '{k}'").select("entry", "event_id", "start", (F.col("start") + F.col("duration") * 600).alias("end"))
    return L.overlapping(span("click"), span("purchase"), ["entry"], 3600.0).select("entry", "event_id", "other_event_id")


@query
def slice_text(spark, sf):
    index = L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"]).select("conv_id", (F.col("turn") * 10.0).alias("ts"), "start_loc", "end_loc")
    text = R.ordered_concat(_captions(spark, sf), "conv_id", "turn", "text")
    ranges = index.groupBy("conv_id").agg((F.max("ts") / 2).alias("end")).select("conv_id", (F.col("end") / 2).alias("start"), "end")
    ranges = ranges.join(text.where("length(text) > 0").select("conv_id"), "conv_id")
    return L.slice_text(index, ranges, text, ["conv_id"], 1.0).select("conv_id", F.md5(F.col("slice").cast("binary")).alias("digest"))


@query
def monotone_times(spark, sf):
    rows = _words(spark, sf).select("entry", "event_id", F.floor(F.col("start") / 60 % 1440).cast("double").alias("ts"))
    return L.monotone(rows, ["entry"], ["event_id"])


@query
def confusion_zone(spark, sf):
    out = Q.confusion_zone(_words(spark, sf), window=48 * HOUR, hop=12 * HOUR, limit=0.05)
    return out.select("entry", F.round("zone_start", 3).alias("zone_start"), F.round("zone_end", 3).alias("zone_end"), F.round("ratio", 6).alias("ratio"))


@query
def trailing_word_window(spark, sf):
    out = Q.trailing_window(_words(spark, sf), span=48 * HOUR, warm_up=5.0, limit=0.05)
    return out.select("entry", "event_id", F.round("ratio", 6).alias("ratio"), F.round("mean_prob", 6).alias("mean_prob"), "broken")


@query
def probable_segment_before(spark, sf):
    words = _words(spark, sf)
    times = words.groupBy("entry").agg(F.max("start").alias("t"))
    out = Q.probable_segment_before(words, times, hop=6 * HOUR)
    return out.select("entry", "hop", F.round("start", 3).alias("start"), F.round("prob", 6).alias("prob"))


@query
def zero_length_words(spark, sf):
    words = _words(spark, sf).withColumn("end", F.when(F.col("prob") < 0.2, F.col("start")).otherwise(F.col("end")))
    return Q.zero_length(words).select("entry", F.round("zero_share", 6).alias("zero_share"), "failed")


@query
def quantised_mode(spark, sf):
    return Q.quantised_mode(_words(spark, sf), ["entry"])


@query
def lag_ci(spark, sf):
    out = Q.lag_confidence(_words(spark, sf), "entry", "duration", F.col("event_id"))
    return out.select("entry", "n", *[F.round(c, 5).alias(c) for c in ("mean", "low", "high")], "confident")


@query
def ema_word_duration(spark, sf):
    rows = _words(spark, sf).groupBy("entry").agg(F.transform(F.array_sort(F.collect_list(F.struct("start", "event_id", "duration"))), lambda x: x["duration"]).alias("d"))
    return rows.select("entry", F.round(F.aggregate("d", F.lit(0.42), lambda a, x: 0.98 * a + 0.02 * x), 8).alias("ema"))


@query
def greedy_packing(spark, sf):
    rows = L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"])
    cues = rows.select("conv_id", F.col("turn").alias("pos"), (F.col("start_loc") / 20).alias("start"), (F.col("end_loc") / 20).alias("end"), "text")
    return P.pack_captions(cues, ["conv_id"]).select("conv_id", "grp", "first_pos", "last_pos", "start", "end")


def _pointers(spark, sf):
    rows = _words(spark, sf)
    idx = F.row_number().over(W.partitionBy("entry").orderBy("event_id")) - 1
    return rows.select("entry", idx.alias("idx"), F.greatest(F.floor((F.col("start") - 1704067200) / 60) + F.col("event_id") % 97 - 48, F.lit(0)).cast("long").alias("sec"))


@query
def time_index_repair_a(spark, sf):
    return S.repaired_times(_pointers(spark, sf), ["entry"])


@query
def time_index_repair_b(spark, sf):
    return X.repaired_by_scan(_pointers(spark, sf), ["entry"])


@query
def speech_ranges(spark, sf):
    at = (F.row_number().over(W.partitionBy("entry").orderBy("event_id")) - 1) * 100  # a word is a hundred frames
    frames = _words(spark, sf).select("entry", at.alias("frame_idx"), F.lit(100).alias("times"), F.when(F.col("prob") < 0.4, F.lit(0.02)).otherwise(F.lit(0.98)).alias("prob"))
    out = X.speech_by_stretches(frames, ["entry"], S.VadSettings(least=1.0), times="times")
    return out.select("entry", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"))


@query
def timed_segments(spark, sf):
    rows = L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"]).withColumn("ts", F.col("turn") * 7.0)
    whole = R.ordered_concat(_captions(spark, sf), "conv_id", "turn", "text").withColumnRenamed("text", "whole")
    out = S.segments(rows.select("conv_id", "start_loc", "end_loc", "ts").join(whole, "conv_id"), ["conv_id"])
    return out.select("conv_id", F.round("start", 4).alias("start"), F.round("end", 4).alias("end"), "text")


@query
def kmeans_2(spark, sf):
    return K.two_means(_words(spark, sf).select("entry", "event_id", "prob"), ["entry"], "prob").select("entry", "event_id", "cls")


@query
def segment_confidence(spark, sf):
    return Q.segment_confidence(_segmented(spark, sf), digits=8)


@query
def first_break(spark, sf):
    out = Q.first_break(_words(spark, sf), span=48 * HOUR, warm_up=5.0, limit=0.05, silence=12 * HOUR)
    return out.select("entry", F.round("at", 3).alias("at"), "reason")


@query
def lag_stopping(spark, sf):
    draw = F.row_number().over(W.partitionBy("entry").orderBy("event_id")) - 1
    samples = _words(spark, sf).select("entry", draw.alias("draw"), F.when(F.col("event_id") % 10 != 0, F.col("duration") * 4).alias("lag"))
    expected = samples.select("entry").distinct().withColumn("expected", F.lit(10.0))
    out = G.sequential_lags(samples, lambda drawn: drawn, expected, ["entry"], G.LagSettings(buffer=8.0))
    return out.select("entry", "draws", "n", *[F.round(c, 5).alias(c) for c in ("lag", "low", "high")], "stopped")


@query
def audio_lag(spark, sf):
    """Turns as samples, said at twenty characters a second and seven seconds before the transcript has them."""
    offsets = L.text_offsets(_captions(spark, sf).withColumn("text", F.concat("text", F.lit(" "))), ["conv_id"], ["turn"])
    texts = R.ordered_concat(_captions(spark, sf), "conv_id", "turn", "text", " ")
    index = offsets.select("conv_id", "start_loc", "end_loc", (F.col("start_loc") / 20).alias("ts"))
    samples = offsets.where("end_loc - start_loc > 25").withColumn("draw", F.row_number().over(W.partitionBy("conv_id").orderBy(F.xxhash64("conv_id", "turn"))) - 1)
    samples = samples.select("conv_id", "draw", F.col("draw").alias("query"), F.col("text").alias("query_text"), (F.col("start_loc") / 20 - 7).alias("begins"))

    def estimate(drawn):
        found = M.fine_search(texts, drawn.select("conv_id", "query", "query_text"), key="conv_id")
        return G.lags_of_places(found, index, drawn, ["conv_id"]).withColumnRenamed("query", "draw")

    expected = index.groupBy("conv_id").agg(F.lit(7.0).alias("expected"))
    out = G.sequential_lags(samples, estimate, expected, ["conv_id"])
    return out.select("conv_id", "draws", "n", *[F.round(c, 4).alias(c) for c in ("lag", "low", "high")], "stopped")


def _steady_voice(conv_id):
    """Stands for a model: four words a second; what it says of a word hangs on the word and the time, and some stretches of time are unclear unless their end is known."""
    unclear = cache(lambda tenth: xxhash64(int(conv_id), tenth) % 3 == 0)
    sure = cache(lambda word: 0.75 + xxhash64(word) % 2 / 8)

    def align(start, stop, text):
        words = (m[0] for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text))
        n = 0
        while part := list(islice(words, 8)):
            times = [start + (n + i) / 4.0 for i in range(len(part) + 1)]
            said = [(w, a, b, 0.125 if stop is None and unclear(math.floor(a / 10)) else sure(w)) for w, a, b in zip(part, times, times[1:], strict=False)]
            yield {"start": times[0], "end": times[-1], "text": " ".join(part), "words": said}
            n += 8

    return align


@query
def align_recovery(spark, sf):
    """Turns as a rough transcript, five words a second, aligned by a stand-in for a model."""
    turns = _captions(spark, sf).withColumn("text", F.trim(F.regexp_replace("text", "\\s+", " "))).where("text != ''")
    long = F.size(F.split("text", " ")) / 5.0
    order = W.partitionBy("conv_id").orderBy("turn")
    rows = turns.withColumns({"id": F.row_number().over(order) - 1, "_end": F.sum(long).over(order.rowsBetween(W.unboundedPreceding, 0))})
    original = rows.select("conv_id", "id", (F.col("_end") - long).alias("start"), F.col("_end").alias("end"), "text")
    out = recovery.recovered_by_entry(original, _steady_voice, "conv_id", recovery.ControlSettings(window=8.0, hop=2.0, least_skip=3.0, most_skip=24.0, back=6.0, radius=54.0, probe=18))
    return out.select("conv_id", "piece", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.size("words").alias("n_words"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query
def char_rarity_weights(spark, sf):
    docs = _t(spark, sf, "documents").select("lang", F.coalesce("text", F.lit("")).alias("text"))
    return M.character_weights(docs, ["lang"]).select("lang", "char", "n", F.round("weight", 8).alias("weight"))


@query
def window_hist_search(spark, sf):
    turns = _captions(spark, sf)
    texts = R.ordered_concat(turns, "conv_id", "turn", "text", " ").withColumnRenamed("conv_id", "doc_id")
    last = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("query_text")).where("length(query_text) > 0")
    return M.window_search(texts, last.select(F.col("conv_id").alias("doc_id"), F.col("conv_id").alias("query"), "query_text"), best=3).select("doc_id", "query", "at", F.round("similarity", 6).alias("similarity"))


@query
def window_fine_search(spark, sf):
    turns = _captions(spark, sf)
    texts = R.ordered_concat(turns, "conv_id", "turn", "text", " ").withColumnRenamed("conv_id", "doc_id")
    last = turns.groupBy("conv_id").agg(F.max_by("text", "turn").alias("query_text")).where("length(query_text) > 0")
    found = M.fine_search(texts, last.select(F.col("conv_id").alias("doc_id"), F.col("conv_id").alias("query"), "query_text"))
    return found.select("doc_id", "query", "at", F.round("similarity", 6).alias("similarity"))


@query
def dtw_align(spark, sf):
    whole = R.ordered_concat(_captions(spark, sf), "conv_id", "turn", "text", " ").withColumnRenamed("text", "reference")
    splits = _captions(spark, sf).select("conv_id", F.col("turn").cast("int").alias("split_idx"), F.col("text").alias("base"))
    return M.align_splits(splits.join(whole, "conv_id"), ["conv_id"])


@query
def locate_prefix(spark, sf):
    rows = L.text_offsets(_captions(spark, sf), ["conv_id"], ["turn"]).join(R.ordered_concat(_captions(spark, sf), "conv_id", "turn", "text").withColumnRenamed("text", "whole"), "conv_id")
    start = F.substring(F.col("text"), F.lit(1), F.lit(90))
    return rows.where("length(text) > 0").select("conv_id", "turn", M.locate_text(F.col("whole"), start, [270, 405, 608], F.col("start_loc").cast("int")).alias("at"))


@query
def cosine_topk(spark, sf):
    rows = _t(spark, sf, "embeddings").select("vec_id", "embedding")
    # The stated query set, every row whose id is divisible by 100, against all rows.
    return most_alike(rows.where("vec_id % 100 = 0"), rows, "vec_id", "embedding", 5).select("query", "vec_id", "rank", F.round("similarity", 5).alias("similarity"))


def _marked(spark, sf):
    text = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit(", "), F.lit("; ")), F.lit(". "), F.lit(" – "))
    return _t(spark, sf, "documents").select("doc_id", text.alias("text"))


@query
def text_normalize(spark, sf):
    return _marked(spark, sf).select("doc_id", F.md5(T.normalize_for_audio(F.col("text")).cast("binary")).alias("digest"))


@query
def bracket_unwrap(spark, sf):
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"([a-z]+), ", "( $1 ) ")
    return _t(spark, sf, "documents").select("doc_id", F.md5(T.unwrap_brackets(text).cast("binary")).alias("digest"))


@query
def word_counts(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", T.word_count(F.coalesce("text", F.lit(""))).alias("n_words"))


@query
def sentence_marks(spark, sf):
    text = F.coalesce("text", F.lit(""))
    return _t(spark, sf, "documents").select("doc_id", F.size(T.split_points(text)).alias("n_points"), T.ends_sentence(text).alias("ends_sentence"), T.starts_with_word(text).alias("word_first"), T.ends_with_word(text).alias("word_last"))


@query
def filename_sanitize(spark, sf):
    return _t(spark, sf, "pages").select("page_id", T.safe_file_name(F.coalesce("url", F.lit(""))).alias("name"))


@query
def url_parts(spark, sf):
    return _t(spark, sf, "pages").select("page_id", T.query_param(F.col("url"), "page").alias("page"), T.is_host(F.col("url"), "example.com").alias("at_example"))


@query
def html_tagged(spark, sf):
    inside = T.tagged(F.coalesce("html", F.lit("")), "li")
    return _t(spark, sf, "pages").select("page_id", F.size(inside).alias("n_items"), F.md5(F.array_join(inside, "|").cast("binary")).alias("digest"))


@query
def clock_texts(spark, sf):
    day = F.col("start") % 86400
    words = _words(spark, sf)
    return words.select("event_id", T.seconds_clock(day).alias("clock"), T.seconds_clock_whole(day).alias("whole"), F.round(T.clock_seconds(T.seconds_clock(day)), 3).alias("seconds"), T.seconds_to_frame(F.col("duration")).alias("frame"))


@query
def feed_dates(spark, sf):
    text = F.concat(F.lit("Mon, "), F.date_format(F.col("ts").cast("timestamp"), "d MMM yyyy HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, " GMT").otherwise(" +0000"))
    return _t(spark, sf, "events").select("event_id", T.feed_date(text).alias("day"))


@query
def vtt_round_trip(spark, sf):
    cues = _captions(spark, sf).where("trim(text) != ''").select("conv_id", (F.col("turn") * 10.0).alias("start"), (F.col("turn") * 10.0 + 9.5).alias("end"), F.regexp_replace("text", "\\s+", " ").alias("text"))
    files = sinks.vtt_text(cues, ["conv_id"]).select(F.col("conv_id").cast("string").alias("path"), "content")
    return C.vtt_segments(files).select(F.col("path").cast("long").alias("conv_id"), F.col("id").cast("long").alias("id"), "start", "end")


@query
def hourly_counts(spark, sf):
    events = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ST.tumbling(events, "ts", "1 hour", F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_seconds("window_start").alias("window_start"), "n", "total")


@query
def sliding_counts(spark, sf):
    events = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ST.sliding(events, ["user_id"], "ts", "2 hours", "30 minutes", F.count("*").alias("n")).select("user_id", F.unix_seconds("window_start").alias("window_start"), "n")


@query
def session_counts(spark, sf):
    events = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return ST.sessions(events, ["user_id"], "ts", "30 minutes", F.count("*").alias("n")).select("user_id", F.unix_micros("session_start").alias("session_start"), "n")
