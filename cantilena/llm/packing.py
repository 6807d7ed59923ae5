"""Best-fit packing of tokenised documents into sequences, bulk-synchronously.

Pieces are placed from long to short in bands of lengths. A superstep sorts the pieces of a band and the gaps of all sequences along one axis,
the length, and sweeps it from above: a gap puts its slots on a stack, a piece takes the slot on top, which is the smallest that holds it, its
successor. Nobody walks the stack: how high it is at each length follows from the counts of each length, and the rank of a piece among those of its
length tells which height it takes its slot from, the rank of a slot at which height it lies. Slots and pieces of one height meet in a shuffle,
and there each piece's slot is the last one above it, so ranks resolve all conflicts. Then the gaps are updated. A band is swept again until next to nothing moves;
what is left opens new sequences, as many to one as the longest piece left allows; in the last band, which nothing fills up after, only as
many sequences as the ids left need at the least, and the sweeps go on.

Only tables of a row a length (at most the capacity) are in one task; pieces and gaps are shuffled by rank and height, so a length that a third of all
pieces have is no hot spot.
"""

from __future__ import annotations

import functools
import os
import sys
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut, release_memory, text_of

CAPACITY, CACHED_WORDS = 2048, 140_000
#: Rows of a task where little is known of each, and how many of the pieces that wait must move for another sweep: one of so many.
ROWS, WORTH, LATER = 100_000, 12, 2**62
#: The longest piece of each band is the capacity divided by these.
BANDS = (1, 2, 3, 4, 6, 9, 16, 64)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level models write for bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer(dict):
    """The ids of each word seen, for tokenizers whose tokens never reach across white space: each word is encoded once. If probes of
    several words show that a model isn't like that, whole texts are encoded.

    A word of Latin letters is one unit of a lower-casing byte-level model, and the marks behind it are another: the
    model's merges are asked for the letters directly. All other words go through the whole tokenizer. Probes at the start
    decide whether the model at hand allows the short way.
    """

    MARKS = b"!#$%&)*+,-./:;=>?@]^_|}~"

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        super().__init__()
        self.model, self.old, self.marks, self.letters = Tokenizer.from_str(model), {}, {b"": b""}, _byte_letters()
        self.merges = self.model.model
        words = ["the", "The", "éèçœ", "Ñandú", "straße", "ÀÉÎÕÜ", "Ǆon", "Łódź", "zyzzyvas"]
        probes = [x.encode() + m for x in words for m in (b"", b".", b",%%%", b"!!", b")", b"-;")]
        self.short = [self._short(w) for w in probes] == [self._whole(w) for w in probes]
        texts = ["the end of it", "Two words", "a  b", "one\ntwo\tthree ", " 1 000, no.\r\n", "of the and of the", "é à\x0bç"]
        self.whole = any(b"".join(map(self._whole, t.encode().split())) != self._whole(t.encode()) for t in texts)

    def _packed(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, dtype="<u4").tobytes()

    def _whole(self, word: bytes) -> bytes:
        return self._packed(self.model.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _mark(self, mark: bytes) -> bytes:
        ids = self.marks.get(mark)
        if ids is None:
            if len(self.marks) > 10_000:
                self.marks = {b"": b""}
            ids = self.marks[mark] = self._whole(mark)
        return ids

    def _short(self, word: bytes) -> bytes | None:
        """None if the word isn't made of Latin letters with marks behind."""
        core = word.rstrip(self.MARKS)
        if core.isalpha():  # of bytes: ASCII letters
            low = core.lower()
            if low != word and (ids := self.get(low) or self.old.get(low)):
                return ids + self._mark(word[len(core) :])
            text = low.decode()
        else:
            text = core.decode("utf-8", "replace")
            if not text.isalpha() or max(text) >= "\u0250":
                return None
            text = text.lower()
            if not text.isalpha():
                return None
            text = "".join(map(self.letters.__getitem__, text.encode()))
        return self._packed([t.id for t in self.merges.tokenize(text)]) + self._mark(word[len(core) :])

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHED_WORDS:  # words in use come back from the old ones
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            ids = self._short(word) if self.short else None
            if ids is None:
                ids = self._whole(word)
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.whole:
            return self._packed(self.model.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.encode("utf-8", "surrogatepass").split()))  # at ASCII white space alone


def _tokenizer(model: str) -> WordTokenizer:
    """One a Python worker, which serves many tasks; its words are bounded by CACHED_WORDS and a batch."""
    name = f"_cantilena_words_{zlib.crc32(model.encode())}"
    if not hasattr(sys, name):
        setattr(sys, name, WordTokenizer(model))
    return getattr(sys, name)


def tokenized(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and end_id, cut at the capacity."""
    model = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))  # a file of a fixed size
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_memory()
        words = _tokenizer(model.value)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                ids = words.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)) + ((np.frombuffer(part, "<u4").astype("int64"),) if keep_ids else ()))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
        words.old = {}
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInPandas(run, PIECES + ", ids array<long>" * keep_ids)


def _ranked(events: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """events (kind, v, w, id) with _before, the sum of w over the events of the same kind and length that come first; and rows (kind, v,
    _n), sums of w. Ranks are counted in parts of a length, by id."""
    events = events.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    counts = events.groupBy("kind", "v", "_part").agg(F.sum("w").alias("_n"))
    earlier = counts.withColumn("_base", F.sum("_n").over(W.partitionBy("kind", "v").orderBy("_part")) - F.col("_n"))
    own = F.sum("w").over(W.partitionBy("kind", "v", "_part").orderBy("id").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("w")
    ranked = events.withColumn("_own", own).join(earlier.drop("_n"), ["kind", "v", "_part"]).withColumn("_before", F.col("_base") + F.col("_own"))
    return ranked.drop("_part", "_own", "_base"), counts


def heights(counts: DataFrame) -> DataFrame:
    """For rows (kind, v, _n): by length v, swept from above, how high the stack of slots is before its slots come (_low) and
    before its pieces go (_high), how low it ever gets from there on (_least), and how many longer pieces found it empty (_missed)."""
    by = counts.groupBy("v").agg(F.sum(F.when(F.col("kind") == 0, F.col("_n")).otherwise(0)).alias("_slots"), F.sum(F.when(F.col("kind") == 1, F.col("_n")).otherwise(0)).alias("_pieces"))
    down = W.partitionBy().orderBy(F.col("v").desc())  # a row a length
    sofar, on = down.rowsBetween(W.unboundedPreceding, W.currentRow), down.rowsBetween(W.currentRow, W.unboundedFollowing)
    rows = by.withColumn("_c", F.sum(F.col("_slots") - F.col("_pieces")).over(sofar))
    rows = rows.withColumn("_h", F.col("_c") - F.least(F.lit(0), F.min("_c").over(sofar)))
    rows = rows.withColumn("_low", F.lag("_h", 1, 0).over(down)).withColumn("_high", F.col("_low") + F.col("_slots"))
    rows = rows.withColumns({"_least": F.min("_h").over(on), "_none": F.greatest(F.lit(0), F.col("_pieces") - F.col("_high"))})
    return rows.select("v", "_low", "_high", "_least", (F.sum("_none").over(sofar) - F.col("_none")).alias("_missed"))


def sweep(pieces: DataFrame, gaps: DataFrame, top: int) -> DataFrame:
    """pieces (id, length), none longer than top, with the sequence whose gap each takes, or null and the rank among those that get none.

    gaps: (sequence, gap). A gap offers as many slots as pieces of top fit, or one if it is smaller than that: each holds every piece
    that can take it.
    """
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = F.greatest(F.floor(F.col("gap") / top), F.lit(1)).cast("long")
    events = gaps.select(F.lit(0).alias("kind"), F.col("gap").alias("v"), slots.alias("w"), F.col("sequence").alias("id")).unionByName(pieces.select(F.lit(1).alias("kind"), F.col("length").alias("v"), F.lit(1).cast("long").alias("w"), "id"))
    ranked, counts = _ranked(events, parts)
    ranked = ranked.join(F.broadcast(heights(counts)), "v")  # a row a length
    # A slot above the least height to come is taken; the others aren't listed.
    first = F.greatest(F.col("_low") + F.col("_before"), F.col("_least")) + 1
    taken = ranked.where("kind = 0").withColumn("_first", first).where(F.col("_first") <= F.col("_low") + F.col("_before") + F.col("w"))
    taken = taken.select("kind", "v", "id", F.explode(F.sequence("_first", F.col("_low") + F.col("_before") + F.col("w"))).alias("_height"), F.lit(None).cast("long").alias("_rank"))
    asking = ranked.where("kind = 1").withColumn("_height", F.col("_high") - F.col("_before"))
    none = F.when(F.col("_height") < 1, F.col("_missed") - F.col("_height"))
    # Those who get none meet nobody, so they are spread by their rank.
    asking = asking.select("kind", "v", "id", F.coalesce(-none - 1, F.col("_height")).alias("_height"), none.alias("_rank"))
    slot = F.lag(F.when(F.col("kind") == 0, F.col("id"))).over(W.partitionBy("_height").orderBy(F.col("v").desc(), "kind"))
    met = taken.unionByName(asking).withColumn("_slot", slot).where("kind = 1")
    return met.select("id", F.col("v").alias("length"), F.when(F.col("_rank").isNull(), F.col("_slot")).alias("sequence"), F.col("_rank").alias("rank"))


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset: sequences of at most capacity ids, gapless from 0.

    pieces needs length (1 to capacity); it should be a written or checkpointed table, as it is read several times. Rows that are equal are
    pieces of their own. An empty table gives an empty one.
    """
    columns = pieces.columns
    if not pieces.where(~F.col("length").between(1, capacity)).isEmpty():
        raise ValueError("a piece is empty or longer than a sequence")
    pieces = cut(pieces.withColumn("_id", F.monotonically_increasing_id()))
    few = lambda rows, n: rows.coalesce(n // ROWS + 1)  # as a sweep has many stages
    n = pieces.count()
    narrow = cut(few(pieces.select(F.col("_id").alias("id"), F.col("length").cast("long").alias("length")), n))
    tops = sorted({capacity // k for k in BANDS if k <= capacity}, reverse=True)
    band = F.coalesce(*[F.when(F.col("length") > low, i) for i, low in enumerate(tops[1:])], F.lit(len(tops) - 1))
    some = {r[0]: r[1:] for r in narrow.where(2 * F.col("length") <= capacity).groupBy(band.alias("b")).agg(F.min("length"), F.max("length")).collect()}  # a row a band
    # Of pieces longer than half of a sequence no two fit together: each opens one, numbered as itself; others are numbered from LATER on.
    alone = narrow.where(2 * F.col("length") > capacity).withColumn("sequence", F.col("id"))
    narrow = narrow.where(2 * F.col("length") <= capacity)
    placed, opened, gaps = [alone.select("id", "sequence")], LATER, cut(alone.select("sequence", (capacity - F.col("length")).alias("gap")).where("gap > 0"))
    used = lambda rows: rows.groupBy("sequence").agg(F.sum("length").alias("_used"))
    for i in sorted(some):
        least, longest, left = min(n for b, (n, _) in some.items() if b >= i), some[i][1], narrow.where(band == i)
        while True:
            found, waits = cut(few(sweep(left, gaps.where(F.col("gap") >= least), longest), n)), F.when(F.col("rank").isNotNull(), F.col("length"))
            moved, over, shortest, longest, ids = found.agg(F.count("sequence"), F.count("rank"), F.min(waits), F.max(waits), F.sum(waits)).first()
            if moved:
                went = found.where("rank is null")
                placed.append(went.select("id", "sequence"))
                gaps = cut(few(gaps.join(used(went), "sequence", "left").select("sequence", (F.col("gap") - F.coalesce("_used", F.lit(0))).alias("gap")).where("gap > 0"), n))
            if not over:
                break
            left = found.where("rank is not null")
            stuck = WORTH * moved < over or (gaps.agg(F.max("gap")).first()[0] or 0) < shortest  # nothing moves any more
            if stuck and i == max(some) and over > capacity // longest:
                fresh = -(-ids // capacity)
                gaps = gaps.unionByName(narrow.sparkSession.range(opened, opened + fresh).select(F.col("id").alias("sequence"), F.lit(capacity).cast("long").alias("gap")))
                opened += fresh
            elif stuck:
                each = capacity // longest
                went = left.select("id", "length", (F.floor(F.col("rank") / each) + opened).alias("sequence"))
                placed.append(went.select("id", "sequence"))
                opened -= -over // each
                gaps = cut(few(gaps.unionByName(used(went).select("sequence", (F.lit(capacity) - F.col("_used")).alias("gap")).where("gap > 0")), n))
                break
            left = left.select("id", "length")
    where = functools.reduce(DataFrame.unionByName, placed)
    rows = pieces.join(where.select(F.col("id").alias("_id"), F.col("sequence").alias("sequence_id")), "_id")
    offset = F.sum("length").over(W.partitionBy("sequence_id").orderBy(F.col("length").desc(), "_id").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("length")
    return rows.withColumn("offset", offset.cast("long")).select(*columns, "sequence_id", "offset")


def best_fit_pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, keep_ids: bool = False, **columns) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset), one a piece.

    Null or empty text: the end id alone. Null or repeated doc_id: each row is a document of its own. Documents longer than
    the capacity are cut, no others. Other columns are dropped.
    """
    return pack(cut(tokenized(docs, tokenizer_path, capacity=capacity, keep_ids=keep_ids, **columns)), capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids) of what best_fit_pack(keep_ids=True) returns; a sequence holds at most the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
