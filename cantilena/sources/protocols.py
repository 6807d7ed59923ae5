"""Parliament protocols: XML fields, HTML fragments with time marks, DOCX with bookmarks."""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators.sequential import merge_near_ranges, repair_by_jumps

# First classes of elements that hold no speech.
SKIPPED = frozenset("SUBJECT SPEAKER SPEAKER_INTERRUPTION SPEAKER_CONTINUE YOR VOTING_TOP VOTING_MID VOTING_BOTTOM".split())
_MARK = re.compile(r"txt_(\d+)$")
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def xml_title(content: Column) -> Column:
    return F.xpath_string(content, F.lit("//sTitle"))


def time_pointers(files: DataFrame, key: str = "id") -> DataFrame:
    """(key, idx, sec): a dense array from bk[i]=n; lines, zero where there is none, the last of several."""
    js = F.xpath_string(F.col("content"), F.lit("//sJSArrays"))
    pattern = r"bk\[(\d+)\]=(\d+);"
    pairs = F.arrays_zip(F.regexp_extract_all(js, F.lit(pattern), F.lit(1)).alias("i"), F.regexp_extract_all(js, F.lit(pattern), F.lit(2)).alias("n"))
    rows = files.select(key, F.posexplode(pairs).alias("_at", "_p")).select(key, "_at", F.col("_p.i").cast("long").alias("idx"), F.col("_p.n").cast("long").alias("sec"))
    last = rows.groupBy(key, "idx").agg(F.max_by("sec", "_at").alias("sec"))
    dense = rows.groupBy(key).agg(F.max("idx").alias("_m")).select(key, F.explode(F.sequence(F.lit(0).cast("long"), "_m")).alias("idx"))
    return dense.join(last, [key, "idx"], "left").select(key, "idx", F.coalesce("sec", F.lit(0)).alias("sec"))


def gathered_html(files: DataFrame) -> DataFrame:
    """(id, html) from files protocol_<id>_<from>_<to>_<from time>_<to time>_bulk.html, in order of their from time; negative ones go."""
    p = F.split(F.element_at(F.split("path", "/"), -1), "_")
    order = F.when(F.size(p) < 5, 0).otherwise(F.coalesce(F.get(p, F.lit(4)).try_cast("long"), F.lit(0)))
    rows = files.select(F.get(p, F.lit(1)).alias("id"), order.alias("_o"), "path", "content").where("_o >= 0")
    parts = F.array_sort(F.collect_list(F.struct("_o", "path", "content")))
    return rows.groupBy("id").agg(F.concat(F.lit("<div>"), F.array_join(F.transform(parts, lambda x: x["content"]), ""), F.lit("</div>")).alias("html"))


class _Walk(HTMLParser):
    """Text parts and marks of a fragment in order."""

    def __init__(self, known: frozenset | None = None):
        super().__init__(convert_charrefs=True)
        self.known = known
        self.out: list[tuple[str, str]] = []
        self.open: list[tuple[str, bool, str | None]] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if self.known is not None and tag not in self.known:
            raise ValueError(f"unknown element {tag}")
        if tag == "br":
            self.out.append(("text", "\n"))
            return
        mark = _MARK.match(a.get("id") or "")
        skip = bool(self.open and self.open[-1][1]) or next(iter((a.get("class") or "").split()), None) in SKIPPED
        self.open.append((tag, skip, mark[1] if mark else None))
        if mark and not skip:
            self.out.append(("start", mark[1]))

    def handle_endtag(self, tag):
        while self.open:
            name, skip, mark = self.open.pop()
            if mark is not None and not skip:
                self.out.append(("end", mark))
            if name == tag:
                break

    def handle_data(self, data):
        if not (self.open and self.open[-1][1]):
            self.out.append(("text", data.replace("\n", " ")))


def html_parts(html: str, known: frozenset | None = None) -> list[tuple[str, str]]:
    """("text", part) and ("start" or "end", index) in order; spans of skipped classes go with what is in them. known: the elements that may occur, others
    raise an error; None: any."""
    walk = _Walk(known)
    walk.feed(html or "")
    walk.close()
    return walk.out


#: The elements of a protocol's fragments.
ELEMENTS = frozenset({"span", "font", "div", "br"})


def transcript_parts(pages: DataFrame, key: str = "id", known: frozenset | None = None) -> DataFrame:
    """(key, at, kind, value) of (key, html); known as in html_parts, ELEMENTS for instance."""
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, i, *p) for k, h in zip(pdf[key], pdf["html"], strict=True) for i, p in enumerate(html_parts(h, known))]
            yield pd.DataFrame(rows, columns=[key, "at", "kind", "value"])

    return pages.select(key, "html").mapInPandas(run, f"`{key}` {kind}, at long, kind string, value string")


def timed_transcript(parts: DataFrame, pointers: DataFrame, key: str = "id", lead_in: float = 3.0) -> tuple[DataFrame, DataFrame]:
    """(key, text), and slices (key, ts, start_loc, end_loc). Text before the first accepted mark goes; marks count only if their time lies
    beyond all before; marks of time zero before any other stand lead_in seconds before the first time of the pointers; spaces but line ends
    are squeezed."""
    w = W.partitionBy(key).orderBy("at")
    known = pointers.select(key, F.col("idx").cast("string").alias("value"), F.lit("start").alias("kind"), F.col("sec").alias("_sec"))
    first = pointers.where("sec > 0").groupBy(key).agg(F.min_by("sec", "idx").alias("_first"))
    rows = parts.join(known, [key, "kind", "value"], "left").join(first, key, "left")
    seen = F.max("_sec").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)) > 0
    rows = rows.withColumn("_at", F.when(F.col("_sec").isNotNull(), F.when(seen, F.col("_sec")).otherwise(F.col("_first") - lead_in)).cast("double"))
    best = F.max("_at").over(w.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_ts", F.when(F.col("_at") > F.greatest(best, F.lit(0.0)), F.col("_at")))
    rows = rows.withColumn("ts", F.last("_ts", True).over(w.rowsBetween(W.unboundedPreceding, 0))).where("kind = 'text' and ts is not null")
    rows = rows.withColumn("_t", F.regexp_replace("value", r"(?U)[^\S\n]+", " "))
    end = F.sum(F.length("_t")).over(w.rowsBetween(W.unboundedPreceding, 0))
    slices = rows.withColumns({"_e": end, "_s": end - F.length("_t")}).groupBy(key, "ts").agg(F.min("_s").alias("start_loc"), F.max("_e").alias("end_loc"))
    text = rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "_t"))), lambda x: x["_t"]), "").alias("text"))
    return text, slices


# Bookmarks of times and of what isn't speech, and text that stands for a missing one of the latter.
_TIME, _OTHER, _ASIDE = "_ETM_Q1_", "ET_", re.compile(r"<< \S+ >>")


def docx_parts(content: bytes) -> list[tuple[float | None, str]]:
    """(seconds, text) by time bookmark; None before the first. Runs under other bookmarks, and those from one with << x >> up to the next
    such one, are left out; neither lasts beyond its paragraph. A paragraph with speech ends in a line end."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    out: list[tuple[float | None, list[str]]] = [(None, [])]
    for paragraph in root.iter(f"{_W}p"):
        other, aside, spoke = None, False, False
        for el in paragraph:
            if el.tag == f"{_W}bookmarkStart":
                name = el.get(f"{_W}name") or ""
                if name.startswith(_TIME):
                    out.append((int(name.split(_TIME)[1]) / 1000, []))
                elif name.startswith(_OTHER):
                    other = el.get(f"{_W}id")
            elif el.tag == f"{_W}bookmarkEnd" and el.get(f"{_W}id") == other:
                other = None
            elif el.tag == f"{_W}r":
                text = "".join(t.text or "" if t.tag == f"{_W}t" else {"tab": "\t", "br": "\n", "cr": "\n"}.get(t.tag.removeprefix(_W), "") for t in el)
                marked = _ASIDE.search(text) is not None
                if other is None and marked:
                    aside = not aside
                if other is None and not marked and not aside:
                    out[-1][1].append(text)
                    spoke = True
        if spoke:
            out[-1][1].append("\n")
    return [(at, "".join(text)) for at, text in out if at is not None or text]


def docx_index(content: bytes) -> tuple[str, list[tuple[int, int, float]]]:
    """The text, and its slices (start_loc, end_loc, seconds): short and blank ones are merged with the one before, times are repaired."""
    parts = docx_parts(content)
    head = parts[0][1] if parts and parts[0][0] is None else ""
    timed = merge_near_ranges([p for p in parts if p[0] is not None])
    ends = list(itertools.accumulate((len(t) for _, t in timed), initial=len(head)))
    slices = [(a, b, s) for a, b, s in zip(ends, ends[1:], repair_by_jumps([s for s, _ in timed]), strict=False)]
    return head + "".join(t for _, t in timed), sorted(slices, key=lambda x: x[2])


def docx_transcripts(files: DataFrame, key: str = "path") -> tuple[DataFrame, DataFrame]:
    """(key, text), and slices (key, ts, start_loc, end_loc) of files (key, content), content being the bytes of a DOCX."""
    kind = dict(files.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, content in zip(pdf[key], pdf["content"], strict=True):
                text, slices = docx_index(content)
                rows.append((k, text, [{"start_loc": a, "end_loc": b, "ts": t} for a, b, t in slices]))
            yield pd.DataFrame(rows, columns=[key, "text", "slices"])

    read = files.select(key, "content").mapInPandas(run, f"`{key}` {kind}, text string, slices array<struct<start_loc:long,end_loc:long,ts:double>>")
    return read.select(key, "text"), read.select(key, F.explode("slices").alias("_s")).select(key, "_s.ts", "_s.start_loc", "_s.end_loc")
