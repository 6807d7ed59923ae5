"""Alignment of the tokens that two tokenizers make of one text.

A transducer reads both token sequences at once. Its state is what one side has said beyond the other: which side leads, and its bytes that are
unmatched, the dangling suffix. The side behind gives the next token; the state that follows hangs on the residual and that token alone, so transitions are
remembered. Whenever the residual is empty a group closes: the least runs of tokens of both sides that say the same bytes. A token that doesn't fit the residual
means that the sides don't say the same.

Which tokens stand for which is counted over the corpus. Rows of a task are taken in chunks; a chunk asks for the count of each pair that it holds once, however many
of its documents hold it, so what is shuffled beside the documents' own pairs is a row a chunk and pair.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, keeps_columns, release_memory

#: A pair of ids is one number of PAIR_BITS bits at most: the first times WIDE plus the second. Remembered states, texts encoded at once (characters), rows and characters of a chunk.
WIDE, PAIR_BITS, REMEMBERED, TOGETHER = 2**24, 48, 200_000, 1_000_000
CHUNK_ROWS, CHUNK_CHARS = 500, 1_000_000
#: Groups of more links than this are counted by their distinct ids.
LARGE = 64


def byte_level_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """The first side: a byte-level model; texts get a space before them.

    If ids follow the order of merges and words are cut by the usual pattern, a rank encoder gives the same ids sooner; it takes texts of Latin letters and
    common marks, about which both pattern engines agree. All others go through the model itself.
    """

    #: Fixed value: how byte-level models of this kind cut words.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-\u024f\u2010-\u2027]")

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are parallel already
        from tokenizers import Tokenizer

        self.model, letters = Tokenizer.from_str(model.decode()), byte_level_letters()
        self.model.encode_special_tokens = True
        self.said = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.model.get_vocab().items()}
        self.ranked = self._ranked(json.loads(model))

    def _ranked(self, plan: dict):
        """The rank encoder, or None if this model can't be read as one."""
        vocab, cut = plan["model"]["vocab"], plan.get("pre_tokenizer") or {}
        made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in plan["model"]["merges"]]
        if made != sorted(made) or -1 in made or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) or plan.get("normalizer"):
            return None
        import tiktoken

        added = {t["id"] for t in plan.get("added_tokens", ())}
        return tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks={self.said[i]: i for i in vocab.values() if i not in added}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int] | None]:
        """The ids of each text; None if their bytes aren't the text's. The rank encoder keeps all bytes by its making: its pattern leaves nothing out, and merges join what is there."""
        out = []
        for text in texts:
            text = f" {text}"
            if self.ranked and not self.OTHER.search(text):
                out.append(self.ranked.encode_ordinary(text))
            else:
                ids = self.model.encode(text, add_special_tokens=False).ids
                out.append(ids if b"".join([self.said[i] for i in ids]) == text.encode() else None)
        return out


class Pieces:
    """The second side: a model of pieces, which puts a space before texts itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.said = {i: bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class State(dict):
    """What one side has said beyond the other, and the states that follow after each token of the side behind, as far as they were asked for."""

    __slots__ = ("first_speaks", "residual", "walk")

    def __init__(self, walk: Transducer, first_speaks: bool, residual: bytes):
        super().__init__()
        self.walk, self.first_speaks, self.residual = walk, first_speaks, residual

    def __missing__(self, token: int) -> State:
        word = self.walk.said[0 if self.first_speaks else 1].get(token, b"")
        if word.startswith(self.residual):
            to = self.walk.state(not self.first_speaks, word[len(self.residual) :])
        elif self.residual.startswith(word):
            to = self.walk.state(self.first_speaks, self.residual[len(word) :])
        else:
            raise ValueError("the sides don't say the same")
        self[token] = to
        return to


class Transducer:
    """Walks two token sequences. At an empty residual the first side speaks."""

    def __init__(self, first: dict[int, bytes], second: dict[int, bytes]):
        self.said = (first, second)
        self.forget()

    def forget(self) -> None:
        self.empty = State(self, True, b"")
        self.states: dict[tuple[bool, bytes], State] = {}

    def state(self, first_speaks: bool, residual: bytes) -> State:
        if not residual:
            return self.empty
        found = self.states.get((first_speaks, residual))
        if found is None:
            found = self.states[(first_speaks, residual)] = State(self, first_speaks, residual)
        return found

    def groups(self, first: list[int], second: list[int], ends_a: array, ends_b: array) -> bool:
        """Adds where groups end, in tokens of each side; False, with nothing added, if the sides don't say the same."""
        if len(self.states) > REMEMBERED:
            self.forget()
        i, j, empty, n = 0, 0, self.empty, len(ends_a)
        say_a, say_b = iter(first), iter(second)
        try:
            for token in say_a:
                s = empty[token]
                i += 1
                while s is not empty:
                    if s.first_speaks:
                        s = s[next(say_a)]
                        i += 1
                    else:
                        s = s[next(say_b)]
                        j += 1
                ends_a.append(i)
                ends_b.append(j)
        except (StopIteration, ValueError):
            j = -1
        if j != len(second):
            del ends_a[n:], ends_b[n:]
        return j == len(second)


@dataclass
class Aligned:
    """Some texts' tokens in a row: ids of both sides, and where groups end in them; which text each group belongs to."""

    first: np.ndarray
    second: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    text: np.ndarray

    def __post_init__(self):
        self.na, self.nb = np.diff(self.ends_a, prepend=0), np.diff(self.ends_b, prepend=0)

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct pairs of ids of tokens that share a group of a text, in order: (text, pair, links)."""
        n = self.na * self.nb
        one, some = n == 1, np.flatnonzero((n > 1) & (n <= LARGE))
        keys = [self.first[self.ends_a[one] - 1] * WIDE + self.second[self.ends_b[one] - 1]]
        texts = [self.text[one]]
        # All links of the other groups at once: link k of a group joins token k // nb of one side with token k % nb of the other.
        group = np.repeat(some, n[some])
        k = np.arange(len(group)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        i, nb = k // self.nb[group], self.nb[group]
        keys.append(self.first[(self.ends_a - self.na)[group] + i] * WIDE + self.second[(self.ends_b - self.nb)[group] + k - i * nb])
        texts.append(self.text[group])
        times = None
        if len(large := np.flatnonzero(n > LARGE)):  # by their distinct ids
            times = [np.ones(sum(map(len, keys)), dtype=np.int64)]
            for g in large:
                ua, ca = np.unique(self.first[self.ends_a[g] - self.na[g] : self.ends_a[g]], return_counts=True)
                ub, cb = np.unique(self.second[self.ends_b[g] - self.nb[g] : self.ends_b[g]], return_counts=True)
                keys.append((ua[:, None] * WIDE + ub).ravel())
                texts.append(np.full(len(keys[-1]), self.text[g]))
                times.append((ca[:, None] * cb).ravel())
        key = (np.concatenate(texts) << PAIR_BITS) + np.concatenate(keys)
        if times is None:
            key.sort()
            begins = np.flatnonzero(np.diff(key, prepend=-1))
            links = np.diff(begins, append=len(key))
        else:
            order = np.argsort(key)
            key, begins = key[order], np.flatnonzero(np.diff(key[order], prepend=-1))
            links = np.add.reduceat(np.concatenate(times)[order], begins)
        found = key[begins]
        return found >> PAIR_BITS, found & (2**PAIR_BITS - 1), links


class GroupTexts:
    """Writes groups: rows of digits with the mark that stands behind an id are looked up, put in their places, and read off without their empty ends."""

    def __init__(self, most_a: int, most_b: int):
        most = max(most_a, most_b)
        self.width = len(str(most)) + 1
        written = [str(i).encode() for i in range(most)]
        self.digits = np.frombuffer(b"".join(w.ljust(self.width) for w in written), dtype=np.uint8).reshape(most, self.width)
        self.length = np.array([len(w) for w in written], dtype=np.int64)

    def write(self, x: Aligned, texts: int) -> tuple[bytes, np.ndarray]:
        """The groups of all texts, one behind the other, and the length of each text's."""
        n = len(x.first) + len(x.second)
        ids, mark = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
        ids[np.arange(len(x.first)) + np.repeat(x.ends_b - x.nb, x.na)] = x.first
        ids[np.arange(len(x.second)) + np.repeat(x.ends_a, x.nb)] = x.second
        ends = x.ends_a + x.ends_b
        mark[ends - x.nb - 1], mark[ends - 1] = ord("|"), ord(";")
        rows, length = self.digits[ids], self.length[ids]
        rows[np.arange(n), length] = mark
        length += 1
        last = ends[np.flatnonzero(np.diff(x.text, append=-1))] - 1  # no mark behind a text's last group
        length[last] -= 1
        total = np.concatenate([[0], np.cumsum(length)])
        sizes = np.bincount(x.text, weights=total[ends] - total[ends - x.na - x.nb], minlength=texts).astype(np.int64)
        return rows[np.arange(self.width) < length[:, None]].tobytes(), sizes


COUNTS = T.StructType([*[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups", T.StringType()), T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType())), T.StructField("chunk", T.LongType())])


@keeps_columns
def token_groups(docs: DataFrame, byte_level: str, pieces: str, text: str = "text") -> DataFrame:
    """docs without text, with n_a, n_b, n_groups, n_links, groups ("a1,a2|b1;a3|b2,b3"), pairs, times and chunk.

    byte_level, pieces: paths of the two models; docs' text is read by the first with a space before it, by the second as it is. pairs: the distinct pairs of ids that
    are linked (first * WIDE + second), times: their links. A text that is null or empty, or that either side doesn't say byte by byte, has no tokens: zeros, '' and no pairs. Repeated
    rows and ties are rows like others, an empty table gives no rows, and columns of these names are replaced. Whole texts are read; memory grows with the longest one alone.
    """
    spark = docs.sparkSession
    models = spark.sparkContext.broadcast((Path(byte_level).read_bytes(), Path(pieces).read_bytes()))
    rows = docs.drop(*[c for c in COUNTS.names if c != text]).withColumnRenamed(text, "_text")
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != "_text"], *COUNTS.fields])

    def aligned(values: list[str], sides: tuple, walk: Transducer, written: GroupTexts) -> list[pa.Array]:
        """The columns of COUNTS but the last, for some texts."""
        first, second, ends_a, ends_b = (array("q") for _ in range(4))
        counts = np.zeros((len(values), 3), dtype=np.int64)
        for k, (value, a, b) in enumerate(zip(values, sides[0].encode(values), sides[1].encode(values), strict=True)):
            before = len(ends_a)
            if value and a is not None and walk.groups(a, b, ends_a, ends_b):
                first.extend(a)
                second.extend(b)
                counts[k] = len(a), len(b), len(ends_a) - before
        base = np.cumsum(counts, axis=0) - counts
        text = np.repeat(np.arange(len(values)), counts[:, 2])
        x = Aligned(*(np.frombuffer(v, dtype=np.int64) for v in (first, second)), np.frombuffer(ends_a, dtype=np.int64) + base[text, 0], np.frombuffer(ends_b, dtype=np.int64) + base[text, 1], text)
        of, pairs, times = x.linked()
        links = np.bincount(of, weights=times, minlength=len(values)).astype(np.int64)
        offsets = pa.array(np.searchsorted(of, np.arange(len(values) + 1)).astype(np.int32))
        said, sizes = written.write(x, len(values))
        strings = pa.LargeStringArray.from_buffers(len(values), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(said)).cast(pa.string())
        return [*(pa.array(c) for c in counts.T), pa.array(links), strings, pa.ListArray.from_arrays(offsets, pa.array(pairs)), pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = (ByteLevel(models.value[0]), Pieces(models.value[1]))
        walk, written = Transducer(sides[0].said, sides[1].said), GroupTexts(*(max(s.said) + 1 for s in sides))
        chunk, n_rows, n_chars = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            values, at = [t or "" for t in batch.column("_text").to_pylist()], 0
            kept = batch.select([i for i, name in enumerate(batch.schema.names) if name != "_text"])
            while at < len(values):  # some at once, by their length
                end, size = at + 1, len(values[at])
                while end < len(values) and size + len(values[end]) <= TOGETHER:
                    size, end = size + len(values[end]), end + 1
                chunks = []
                for value in values[at:end]:
                    if n_rows and (n_rows >= CHUNK_ROWS or n_chars + len(value) > CHUNK_CHARS):
                        chunk, n_rows, n_chars = chunk + 1, 0, 0
                    n_rows, n_chars = n_rows + 1, n_chars + len(value)
                    chunks.append(chunk)
                made = [*aligned(values[at:end], sides, walk, written), pa.array(chunks, pa.int64())]
                yield pa.RecordBatch.from_arrays([*(kept.slice(at, end - at).columns), *made], names=[*kept.schema.names, *COUNTS.names])
                at = end
        release_memory()

    return rows.mapInArrow(run, schema)


def with_link_counts(aligned: DataFrame) -> DataFrame:
    """Rows of token_groups, without pairs, times and chunk, but with n_best and count_sum.

    A pair's count is how many rows hold it linked. n_best: the links whose count is the highest that their first id has with any; count_sum: the sum of the counts over all links.
    """
    kept = cut(aligned)
    counts = kept.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = cut(counts)
    first = F.floor(F.col("pair") / WIDE).alias("first")
    top = counts.groupBy(first).agg(F.max("n").alias("top"))
    judged = counts.withColumn("first", first).join(top, "first").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    asked = kept.select("chunk", F.explode("pairs").alias("pair")).distinct()  # chunks lie in one task, so this is nearly all done before the shuffle
    known = asked.join(judged, "pair").select("chunk", "pair", "n", "best")
    held = [c for c in kept.columns if c not in ("pairs", "times", "chunk")]
    schema = T.StructType([*[kept.schema[c] for c in held], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(docs: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("pair")
        pairs, n, best = table["pair"].to_numpy(), table["n"].to_numpy(), table["best"].to_numpy(dtype=bool)
        sums, bests = array("q"), array("q")
        for mine, times in zip(docs["pairs"], docs["times"], strict=True):
            at = np.searchsorted(pairs, mine)
            sums.append(int((n[at] * times).sum()) if len(at) else 0)
            bests.append(int(times[best[at]].sum()) if len(at) else 0)
        return docs[held].assign(n_best=list(bests), count_sum=list(sums))

    return kept.groupBy("chunk").cogroup(known.withColumnRenamed("chunk", "in_chunk").groupBy("in_chunk")).applyInPandas(run, schema)


def align_corpus(docs: DataFrame, byte_level: str, pieces: str, made: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """docs with all that token_groups and with_link_counts give. made: what becomes of the rows before they are written, so that groups needn't be kept as texts."""
    return with_link_counts(made(token_groups(docs, byte_level, pieces)))
