"""PII: bootstrapped contextual extraction.

Exact detectors find seed entities: the four base kinds, secrets of published formats, and codes, words of at least CODE letters and digits
that no language has. A code is a candidate, not a secret: what its contexts induce must hold codes or accepted instances in most of its
slots. Names of secrets, such as password, are seed patterns beside them (names=(): none). Patterns are lexical: the word before, the two words before, the words either side, a label glued to the front (as in
mail:x), and the shape of a code of letters and digits (its alphabet and length). Patterns and what stands in their slots, whatever its
characters, are a bipartite graph. Spark scores it round by round until no instance is new: a pattern's confidence is the share of all
its slots in the corpus that hold an accepted instance (for a name of a secret: that hold a code); an instance's is what its confident
patterns leave no doubt of, if enough of its own occurrences stand in them. Accepted instances are seeds of the next round, wherever they
stand. What stands in the slots of confident patterns gives new spans.

The first pass finds the seeds and all codes; a round counts the slots of new patterns, finds what stands in the confident ones, and where
else accepted instances stand. Patterns of one word that ends a pattern of two go along, so that the next round rarely needs a pass.

A slot is up to MOST words between two words; behind a word or label it is one word, or as many as go together: groups of digits, and
words tied by one in brackets. Passes over the corpus look only for what is new in a round, through filters of fixed size; a document
without a wanted word costs its splitting alone. What looks like a base kind and fails its check (a card number's last digit, say) is no
code and has no shape, so it is only found by its words.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release_memory, text_of

KINDS = ("email", "ip", "card", "phone")
#: What discovery adds beside the kinds of the detectors.
SECRET = "secret"
#: What a code's own contexts are counted as until it is accepted.
CODED = "code"
# Published formats of keys and tokens by how they begin, and words that name a secret before = or :.
FORMATS = {
    "AKIA": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ASIA": r"(?<![A-Za-z0-9])ASIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "ghp_": r"(?<![A-Za-z0-9])ghp_[A-Za-z0-9]{36,}",
    "xox": r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}",
    "sk_live_": r"(?<![A-Za-z0-9])sk_live_[A-Za-z0-9]{16,}",
    "eyJ": r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+",
}
NAMES = "password passwd passphrase pwd secret token apikey api_key api-key access_key access-key auth_token credential credentials".split()
MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE = 3, 0.5, 0.8
#: The least share of an instance's occurrences that stands in confident patterns (words of any text have next to none), and the most words of a slot.
MIN_SHARE, MOST = 0.1, 5
CODE = 16
#: Up to EXACT strings are looked for themselves, more through a filter of FILTER_BITS; KNOWN words are remembered by a worker.
EXACT, FILTER_BITS, KNOWN = 50_000, 2**20, 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_OPENING = "\"'([{<"
_TRAILING = ".,;:!?\"')]}>#$%&*|"
_WORD = re.compile(r"\S+")
_DIGITS = re.compile(r"[+(]{0,2}[0-9][0-9().-]*")
_TIE = re.compile(r"\[[^\s\[\]]{1,8}\]|\([^\W\d]{1,8}\)|\{[^\s{}]{1,8}\}")
_LABEL = re.compile(r"[^\s:=]+[:=]")
_HEX, _DIGIT = re.compile("[0-9a-f]+"), re.compile("[0-9]")
_SECRETS = {k: re.compile(v) for k, v in FORMATS.items()}


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the run of local characters before each @, and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum(map(str.isdigit, m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def seed_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of secrets of published formats, by start, that overlap none of the base spans."""
    begun = [k for k in FORMATS if k in text]
    if not begun:
        return []
    apart, out = _apart(base_spans(text)), []
    for a, b in sorted(m.span() for k in begun for m in _SECRETS[k].finditer(text)):
        if apart(a, b) and not (out and a < out[-1][2]):
            out.append((SECRET, a, b))
    return out


def _coded(word: str) -> bool:
    """Whether a word looks made up by a machine: at least eight ASCII characters with digits and letters among them."""
    return len(word) >= 8 and word.isascii() and any(map(str.isdigit, word)) and any(map(str.isalpha, word))


def shape(code: str) -> str:
    """The pattern of a code's alphabet and length; empty if it is no code of at least CODE letters and digits, both among them."""
    if len(code) < CODE or not code.isascii() or not code.isalnum() or code.isalpha() or code.isdigit():
        return ""
    return f"S {'x' if _HEX.fullmatch(code.lower()) else 'a'}{len(code)}"


def contexts(text: str, places: list[tuple[int, int]], start: int, end: int) -> list[str]:
    """The patterns in which the span stands; places: those of the text's words."""
    found = shape(text[start:end])
    return _around_span(text, places, start, end) + ([found] if found else [])


def _around_span(text: str, places: list[tuple[int, int]], start: int, end: int) -> list[str]:
    i, j = bisect.bisect_right(places, (start, len(text))) - 1, bisect.bisect_left(places, (end, 0)) - 1
    word = lambda k: text[slice(*places[k])].lower()
    if prefix := text[places[i][0] : start].rstrip(_OPENING):
        return [f"G {prefix.lower()}"] if _LABEL.fullmatch(prefix) else []
    out = [f"L {word(i - 1)}"] if i else []
    if i > 1:
        out.append(f"B {word(i - 2)} {word(i - 1)}")
    if i and j + 1 < len(places) and places[j][1] == end:
        out.append(f"A {word(i - 1)} {word(j + 1)}")
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without what opens or closes around it."""
    while end > start and text[end - 1] in _TRAILING:
        end -= 1
    while start < end and text[start] in _OPENING and not (text[start] == "(" and ")" in text[start:end]):
        start += 1
    return start, end


def last_of(text: str, places: list[tuple[int, int]], i: int, start: int) -> int:
    """The last of the words that go together with word i, which counts from start on."""
    j, now = i, text[start : places[i][1]]
    while j + 1 < len(places) and j - i < MOST - 1:
        after = text[slice(*places[j + 1])]
        digits = _DIGITS.fullmatch(now) and _DIGITS.match(after) and not after.strip("+()0123456789.-,;:!?\"'")
        if not (digits or _TIE.fullmatch(after) or (j > i and _TIE.fullmatch(now))):
            break
        j, now = j + 1, after
    return j


def norm(text: str) -> str:
    return " ".join(text.lower().split())


_SPANS = "array<struct<kind:string,start:long,end:long>>"
_EDGES = "array<struct<pattern:string,instance:string,kind:string,low:long>>"
_CODES = "array<struct<pattern:string,instance:string,start:long,end:long,free:boolean>>"


def _before(words: list[str]) -> Counter:
    """How many slots the pattern L has for each word of a text, at the least."""
    return Counter(words[:-1])


def _edges(text: str, found: list[tuple[str, int, int]], codes: list[tuple[int, int]]) -> Iterator[tuple[str, str, str, int]]:
    """(pattern, instance, kind, slots): slots, told once a pattern, is how many slots it has in this text, at the least.

    A code has no edge to its own shape, or codes of any shape would confirm themselves: its shape counts once it is accepted.
    """
    if found or codes:
        places, counted = [m.span() for m in _WORD.finditer(text)], _before(text.lower().split())
        told = set()
        for k, a, b in found + [(CODED, *x) for x in codes]:
            for p in _around_span(text, places, a, b) if k == CODED else contexts(text, places, a, b):
                yield p, norm(text[a:b]), k, 0 if p in told else counted[p[2:]] if p[0] == "L" else 0
                told.add(p)


def codes_in(text: str, found: list[tuple[str, int, int]]) -> Iterator[tuple[str, str, int, int, bool]]:
    """(pattern, instance, start, end, free) of the words whose core has a shape; free: it overlaps none of the spans found."""
    if not _DIGIT.search(text) or not any(len(w) >= CODE for w in text.split()):
        return
    apart = _apart(found)
    for m in _WORD.finditer(text):
        if m.end() - m.start() >= CODE:
            a, b = (m.start() + x for x in core(m[0]))
            if p := shape(text[a:b]):
                yield p, norm(text[a:b]), a, b, apart(a, b)


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        spans, more, graph, codes = [], [], [], []
        for text in pdf.pop("text"):
            found, secrets = base_spans(text), seed_spans(text)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
            more.append([{"kind": k, "start": a, "end": b} for k, a, b in secrets])
            coded = list(codes_in(text, found + secrets))
            graph.append([{"pattern": p, "instance": x, "kind": k, "low": n} for p, x, k, n in _edges(text, found + secrets, [(a, b) for _, _, a, b, free in coded if free])])
            codes.append([{"pattern": p, "instance": x, "start": a, "end": b, "free": f} for p, x, a, b, f in coded])
        pdf["base"], pdf["more"], pdf["edges"], pdf["codes"] = spans, more, graph, codes
        yield pdf
    release_memory()


class Filter:
    """Which strings may be wanted: the strings themselves, or a bit for each hash."""

    def __init__(self, held: frozenset | bytes):
        self.held, self.exact = held, isinstance(held, frozenset)

    def __contains__(self, x: str) -> bool:
        if self.exact:
            return x in self.held
        h = zlib.crc32(x.encode("utf-8", "surrogatepass")) % FILTER_BITS
        return bool(self.held[h >> 3] >> (h & 7) & 1)


class Known(dict):
    """work(word) of the words that were met last."""

    def __init__(self, work):
        super().__init__()
        self.work = work

    def __missing__(self, word: str):
        if len(self) >= KNOWN:
            self.clear()
        out = self[word] = self.work(word)
        return out


def _wanted(keys: DataFrame, exact: int | None = None) -> Broadcast:
    """What Filter holds, for rows of one string column: at most EXACT strings, or FILTER_BITS bits."""
    name, most = keys.columns[0], EXACT if exact is None else exact
    keys = cut(keys.distinct())
    if keys.count() <= most:
        held = frozenset(r[0] for r in keys.collect())
    else:
        bits = bytearray(FILTER_BITS // 8)
        for r in keys.select((F.crc32(F.col(name).cast("binary")) % FILTER_BITS).cast("int").alias("h")).distinct().toLocalIterator():  # at most FILTER_BITS numbers
            bits[r["h"] >> 3] |= 1 << (r["h"] & 7)
        held = bytes(bits)
    return keys.sparkSession.sparkContext.broadcast(held)


def _wanted_patterns(patterns: DataFrame) -> Broadcast:
    """Patterns, and the words by which a pass knows where to look for them: w any word of one, b and a before a slot, r behind one."""
    p, word, key = F.col("pattern"), lambda i: F.split("pattern", " ")[i], lambda kind, x: F.concat(F.lit(f"{kind} "), x)
    keys = (
        F.when(p.startswith("L "), F.array(p, key("w", word(1))))
        .when(p.startswith("B "), F.array(p, key("w", word(2)), key("b", word(2))))
        .when(p.startswith("A "), F.array(p, key("w", word(1)), key("a", word(1)), key("w", word(2)), key("r", word(2))))
        .otherwise(F.array(p))
    )
    return _wanted(patterns.select(F.explode(keys).alias("key")))


def label_of(word: str) -> str:
    """The label that is glued to the front of a word, if something is behind it."""
    return m[0] if (m := _LABEL.match(word)) and m.end() < len(word) else ""


def core(word: str) -> tuple[int, int]:
    """Where what a word holds begins and ends, behind its label and inside what opens and closes."""
    return trimmed(word, len(label_of(word)), len(word))


def _flags(wanted: Filter):
    """What a lower-case word can be a part of: 1 L, 2 the second of B, 4 the first of A, 8 the last of A, 16 G."""

    def work(w: str) -> int:
        found = 0
        if f"w {w}" in wanted:
            found = (f"L {w}" in wanted) + 2 * (f"b {w}" in wanted) + 4 * (f"a {w}" in wanted) + 8 * (f"r {w}" in wanted)
        if ("=" in w or ":" in w) and (g := label_of(w)) and f"G {g}" in wanted:
            found |= 16
        return found

    return work


def slots(words: list[str], wanted: Filter, known: Known) -> Iterator[tuple[str, int, int | None]]:
    """(pattern, first word, last word) of the slots of wanted patterns in lower-case words; the last is None if it isn't fixed by the pattern."""
    if not any(map(known.__getitem__, set(words))):
        return
    n = len(words)
    flags = list(map(known.__getitem__, words))
    for i, f in enumerate(flags):
        if not f:
            continue
        if f & 16:
            yield f"G {label_of(words[i])}", i, None
        if i + 1 == n:
            break
        if f & 1:
            yield f"L {words[i]}", i + 1, None
        if f & 2 and i and (p := f"B {words[i - 1]} {words[i]}") in wanted:
            yield p, i + 1, None
        if f & 4:
            met = set()
            for j in range(i + 2, min(i + 2 + MOST, n)):
                if flags[j] & 8 and words[j] not in met and (p := f"A {words[i]} {words[j]}") in wanted:
                    met.add(words[j])
                    yield p, i + 1, j - 1


def _occurrences(held: Broadcast, names: tuple[str, ...] | list[str] = NAMES):
    """Counts, a batch at a time, the slots of the wanted patterns, and those of names of secrets that hold a code."""
    named = frozenset(seed_patterns(names))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Filter(held.value)
        known = Known(_flags(wanted))
        for pdf in batches:
            seen, codes = Counter(), Counter()
            for text in pdf["text"]:
                words = text.lower().split()
                for p, i, _ in slots(words, wanted, known):
                    seen[p] += 1
                    if p in named:
                        codes[p] += _coded(words[i][slice(*core(words[i]))] if p[0] == "G" else words[i][slice(*trimmed(words[i], 0, len(words[i])))])
            yield _counted(seen, "pattern").assign(coded=[codes[p] for p in seen]).astype({"coded": "int64"})
        release_memory()

    return run


def _counted(seen: Counter, name: str) -> pd.DataFrame:
    return pd.DataFrame({name: list(seen), "n": list(seen.values())}).astype({name: "object", "n": "int64"})


def _totals(texts: DataFrame, patterns: DataFrame, names: tuple[str, ...] | list[str] = NAMES) -> DataFrame:
    """Rows (pattern, n, coded): how many slots each pattern has in the corpus, whatever stands in them, and how many of a name's hold a code."""
    found = texts.select("text").mapInPandas(_occurrences(_wanted_patterns(patterns), names), "pattern string, n long, coded long").groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("coded").alias("coded"))
    return patterns.select("pattern").join(found, "pattern", "left").select("pattern", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("coded", F.lit(0)).alias("coded"))


def _apart(spans: list[tuple[str, int, int]]):
    """Whether a place overlaps none of the spans."""
    base = sorted((a, b) for _, a, b in spans)
    ends = list(itertools.accumulate((b for _, b in base), max))
    return lambda a, b: not ((i := bisect.bisect_left(base, (b, 0))) and ends[i - 1] > a)


_PLACED = "doc_id long, _row long, pattern string, instance string, start long, end long"


def _rows(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "_row", "pattern", "instance", "start", "end"]).astype({"doc_id": "Int64", "_row": "int64", "pattern": "object", "instance": "object", "start": "int64", "end": "int64"})


def placed_in(text: str, wanted: Filter, known: Known) -> Iterator[tuple[str, str, int, int]]:
    """(pattern, instance, start, end) of what stands in the slots of wanted patterns and overlaps no span of a detector."""
    if not (found := list(slots(text.lower().split(), wanted, known))):
        return
    places, apart = [m.span() for m in _WORD.finditer(text)], _apart(base_spans(text) + seed_spans(text))
    for p, i, j in found:
        start, word = places[i][0], text[slice(*places[i])]
        start += len(label_of(word)) if p[0] == "G" else 0
        a, b = trimmed(text, start, places[last_of(text, places, i, start) if j is None else j][1])
        if a < b and (p[0] != "A" or b == places[j][1]) and apart(a, b):
            yield p, norm(text[a:b]), a, b


def _stand_in(held: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Filter(held.value)
        known = Known(_flags(wanted))
        for pdf in batches:
            yield _rows([(None if pd.isna(doc) else int(doc), row, *x) for doc, row, text in zip(pdf["doc_id"], pdf["_row"], pdf["text"], strict=True) for x in placed_in(text, wanted, known)])
        release_memory()

    return run


def _starts(wanted: Filter):
    """Where in a word a wanted instance may begin: at its begin, or behind its label."""

    def work(word: str) -> list[int]:
        if word.isalpha():
            return [0] if f"1 {word.lower()}" in wanted else []
        if not any(c in word for c in "(=:"):
            low = word.lower()
            opened = low.lstrip(_OPENING)
            return [0] if any(y and f"1 {y}" in wanted for y in {low, opened, low.rstrip(_TRAILING).lstrip(_OPENING)}) else []
        out = [0, m] if (m := len(label_of(word))) else [0]
        return [x for x in out if any(y and f"1 {y}" in wanted for y in (norm(word[slice(*trimmed(word, x, len(word)))]), norm(word[x:].lstrip(_OPENING)), norm(word[x:])))]

    return work


def _instances(text: str, wanted: Filter, known: Known) -> Iterator[tuple[str, int, int]]:
    """(instance, start, end): where wanted instances may stand, behind white space, an opening mark or a label."""
    words = text.split()
    if not any(map(known.__getitem__, set(words))):
        return
    places = [m.span() for m in _WORD.finditer(text)]
    for i, w in enumerate(words):
        for x in known[w]:
            met = set()
            for j in range(i, min(i + MOST, len(words))):
                a, b = trimmed(text, places[i][0] + x, places[j][1])
                if a < b and (a, b) not in met and (k := norm(text[a:b])) in wanted:
                    met.add((a, b))
                    yield k, a, b


def _wanted_instances(instances: DataFrame) -> Broadcast:
    """Instances, and their first words by which a pass knows where to look for them."""
    return _wanted(instances.select(F.explode(F.array("instance", F.concat(F.lit("1 "), F.split("instance", " ")[0]))).alias("key")))


_AROUND = "pattern string, instance string, n long, low long"


def _around(held: Broadcast):
    """How often wanted instances stand anywhere (pattern null), and in which patterns where they overlap no span of a detector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Filter(held.value)
        known = Known(_starts(wanted))
        for pdf in batches:
            seen, low = Counter(), Counter()
            for text in pdf["text"]:
                if found := list(_instances(text, wanted, known)):
                    apart = _apart(base_spans(text) + seed_spans(text))
                    seen.update((None, x) for x, _, _ in found)
                    places, counted, told = [m.span() for m in _WORD.finditer(text)], _before(text.lower().split()), set()
                    for x, a, b in found:
                        for p in contexts(text, places, a, b) if apart(a, b) else ():
                            seen[p, x] += 1
                            if p[0] == "L" and p not in told:
                                low[p, x] += counted[p[2:]]
                                told.add(p)
            yield pd.DataFrame([(*k, n, low[k]) for k, n in seen.items()], columns=["pattern", "instance", "n", "low"]).astype({"pattern": "object", "instance": "object", "n": "int64", "low": "int64"})
        release_memory()

    return run


def seed_patterns(names: tuple[str, ...] | list[str] = NAMES) -> list[str]:
    """Where a secret stands behind its name: glued to it, after its sign, or after a sign that stands alone."""
    return [p for x in names for c in "=:" for p in (f"G {x}{c}", f"L {x}{c}", f"B {x} {c}")]


def discover(graph: DataFrame, codes: DataFrame, texts: DataFrame, *, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, min_score: float = MIN_SCORE, min_share: float = MIN_SHARE, names: tuple[str, ...] | list[str] = NAMES) -> DataFrame | None:
    """Rows (doc_id, _row, kind, start, end): what stands in confident patterns; None if there is nothing.

    graph: rows (pattern, instance, kind, low) of the detectors' spans and of codes; codes: rows (doc_id, _row, pattern, instance, start, end, free) of
    all codes; texts: rows (doc_id, _row, text). A pattern needs
    min_seeds different instances, or a name of a secret, and at least min_confidence. A pattern that has too many slots already in the
    documents of its instances (low) isn't counted in the others. Rounds go on until no instance is new.
    """
    spark = texts.sparkSession
    named = spark.createDataFrame([(p,) for p in seed_patterns(names)], "pattern string")
    pairs = cut(graph.groupBy("pattern", "instance", "kind").agg(F.count("*").alias("n"), F.sum("low").alias("low")))
    placed, sought = cut(codes.where("free").drop("free").select(*[c.split()[0] for c in _PLACED.split(", ")])), None
    totals = cut(codes.groupBy("pattern").agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("coded")))
    accepted = met = done = None

    last_word = F.concat(F.lit("L "), F.split("pattern", " ")[2]).alias("pattern")

    def beside(old: DataFrame | None, new: DataFrame) -> DataFrame:
        return cut(new) if old is None else cut(old.unionByName(new))

    while True:
        support = pairs.groupBy("pattern").agg(F.count_distinct("instance").alias("seeds"), F.sum("n").alias("hits"), F.greatest(F.sum("low"), F.sum("n")).alias("low"), F.mode(F.when(F.col("kind") == CODED, SECRET).otherwise(F.col("kind")), True).alias("kind"))
        support = support.join(named.withColumn("named", F.lit(True)), "pattern", "full").withColumns({"named": F.coalesce("named", F.lit(False)), "kind": F.coalesce("kind", F.lit(SECRET)), "hits": F.coalesce("hits", F.lit(0))})
        fit = cut(support.where("named").unionByName(support.where(~F.col("named") & (F.col("seeds") >= min_seeds) & (F.col("hits") >= min_confidence * F.col("low")))))
        common = support.where(~F.col("named") & (F.col("hits") < min_confidence * F.col("low"))).select("pattern")
        asked = fit.select("pattern").unionByName(fit.where("pattern like 'B %'").select(last_word).join(common, "pattern", "left_anti")).distinct()
        fresh = cut(asked.join(totals, "pattern", "left_anti"))
        if not fresh.isEmpty():
            totals = beside(totals, _totals(texts, fresh, names))
        share = F.greatest(F.col("hits") / F.greatest("n", "hits"), F.when(F.col("named"), F.col("coded") / F.col("n")).otherwise(0.0))
        sure = cut(fit.join(totals, "pattern").where("n > 0 or hits > 0").withColumn("confidence", F.least(share, F.lit(0.999))).where(F.col("confidence") >= min_confidence).select("pattern", "kind", "confidence"))
        ends = sure.where("pattern like 'B %'").join(totals, "pattern").groupBy(last_word).agg(F.sum("n").alias("_n")).join(totals, "pattern").where(F.col("_n") >= min_confidence * F.col("n"))
        asked = sure.where("pattern not like 'S %'").select("pattern").unionByName(ends.select("pattern")).distinct()
        fresh = cut(asked if sought is None else asked.join(sought, "pattern", "left_anti"))
        if not fresh.isEmpty():
            sought = beside(sought, fresh)
            placed = beside(placed, texts.mapInPandas(_stand_in(_wanted_patterns(fresh)), _PLACED).join(fresh, "pattern").select(placed.columns))
        now = placed.join(sure, "pattern")
        doubt = F.exp(F.sum(F.ln(1 - F.col("confidence"))))
        scored = now.select("pattern", "instance", "kind", "confidence").distinct().groupBy("instance").agg((1 - doubt).alias("score"), F.mode("kind", True).alias("kind")).where(F.col("score") >= min_score)
        likely = cut(scored.join(now.groupBy("instance").agg(F.count_distinct("doc_id", "_row", "start", "end").alias("inside")), "instance"))
        fresh = likely.select("instance") if met is None else cut(likely.select("instance").join(met.where("pattern is null"), "instance", "left_anti"))
        if not fresh.isEmpty():
            around = texts.select("text").mapInPandas(_around(_wanted_instances(fresh)), _AROUND).groupBy("pattern", "instance").agg(F.sum("n").alias("n"), F.sum("low").alias("low"))
            met = beside(met, around.join(fresh, "instance", "left_semi"))
        if met is None:
            return done
        every = met.where("pattern is null").select("instance", "n")
        got = cut(likely.join(every, "instance", "left").where(F.col("inside") >= min_share * F.coalesce("n", F.lit(0))).select("instance", "kind"))
        done = cut(now.drop("confidence").join(got.select("instance"), "instance", "left_semi").select("doc_id", "_row", "kind", "start", "end").distinct())
        new = got if accepted is None else cut(got.join(accepted, "instance", "left_anti"))
        if new.isEmpty():
            return done
        accepted = beside(accepted, new.select("instance"))
        waiting = pairs.join(new.select("instance", F.lit(CODED).alias("kind")), ["instance", "kind"], "left_anti").select(pairs.columns)
        pairs = beside(waiting, met.where("pattern is not null").join(new, "instance").select(pairs.columns))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows (doc_id, base, spans): arrays of (kind, start, end) by start, then kind; code points, end exclusive.

    base: what the detectors of KINDS find. spans: base, secrets of published formats that overlap none of it, and the discovered spans
    that overlap neither; of discovered spans that overlap each other the first, and of those that begin together the longest.

    Null or empty text: no spans. Null or repeated ids: each row is answered for itself. An empty table gives no
    rows. Other columns are dropped.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    named = texts.select("doc_id", F.xxhash64("text").alias("_row"), "text")
    found = cut(named.mapInPandas(_find, f"doc_id long, _row long, base {_SPANS}, more {_SPANS}, edges {_EDGES}, codes {_CODES}"))
    new = discover(found.select(F.explode("edges").alias("e")).select("e.*"), found.select("doc_id", "_row", F.explode("codes").alias("c")).select("doc_id", "_row", "c.*"), named, **how)
    if new is None:
        return found.select("doc_id", "base", in_order(F.concat("base", "more")).alias("spans"))
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    spans = new.groupBy(key.alias("_id"), "_row").agg(F.collect_set(F.struct("start", (-F.col("end")).alias("back"), "kind")).alias("_new"))
    apart = F.aggregate(
        F.array_sort("_new"),
        F.expr(f"cast(array() as {_SPANS})"),
        lambda out, s: F.when((F.size(out) == 0) | (F.try_element_at(out, F.lit(-1))["end"] <= s["start"]), F.concat(out, F.array(F.struct(s["kind"].alias("kind"), s["start"].alias("start"), (-s["back"]).alias("end"))))).otherwise(out),
    )
    both = found.select("doc_id", "_row", "base", "more").withColumn("_id", key).join(spans.select("_id", "_row", apart.alias("_new")), ["_id", "_row"], "left")
    return both.select("doc_id", "base", in_order(F.concat("base", "more", F.coalesce("_new", F.expr(f"cast(array() as {_SPANS})")))).alias("spans"))


def in_order(spans: Column) -> Column:
    rank = lambda k: F.array_position(F.array(*map(F.lit, (*KINDS, SECRET))), k)
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.transform(keyed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
