"""Column functions over transcript text. Word and space classes are Unicode-aware, as Hebrew text needs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The invisible direction, joining and isolating marks that transcripts are cleaned of.
CONTROLS = "؜​‌‍‎‏‪‫‬‭‮⁦⁧⁨⁩﻿"
# Vowel points; punctuation that looks like them stays.
NIQQUD = "[֑-ׇֽֿׁׂׅׄ]"
# Characters that file systems refuse.
FORBIDDEN = r"[\\/*?:\"<>|]"
# Media types of feeds, audio containers of media containers, and of codecs.
MIME_EXT = {"audio/mpeg": "mp3", "audio/x-m4a": "m4a", "video/mp4": "m4a", "soundcloud": "soundcloud"}
CONTAINER_EXT = {"mp4": "m4a", "mkv": "mka", "webm": "webm", "avi": "wav", "mov": "m4a", "flv": "mp3"}
CODEC_EXT = {"aac": "aac", "opus": "opus", "mp3": "mp3", "flac": "flac", "wav": "wav", "pcm_s16le": "wav"}
#: Word characters as the rules below mean them: letters, numbers and the underscore of any script, but no combining marks.
WORD = r"[\p{L}\p{N}_]"


def remove_bracketed(text: Column) -> Column:
    """Brackets of any kind and what is in them on a line, with the space before."""
    return F.regexp_replace(text, r"(?Ud)\s*[\(\[\{<].*?[\)\]\}>]", "")


def unwrap_brackets(text: Column) -> Column:
    """Brackets go and their trimmed inside stays; what is no word character around them stays too, or else a space comes there."""
    other = WORD.replace("[", "[^", 1)
    out = F.regexp_replace(text, rf"(?Ud)({other}*)[\(\[\{{<](.*?)[\)\]\}}>]({other}*)", "$1\u0001$2\u0002$3")
    out = F.regexp_replace(out, rf"(?U)(^|{WORD})\u0001\s*", "$1 ")
    out = F.regexp_replace(out, r"(?U)\u0001\s*", "")
    out = F.regexp_replace(out, rf"(?U)\s*\u0002(?=$|{WORD})", " ")
    return F.regexp_replace(out, r"(?U)\s*\u0002", "")


def remove_niqqud(text: Column) -> Column:
    return F.regexp_replace(text, NIQQUD, "")


def remove_controls(text: Column) -> Column:
    return F.translate(text, CONTROLS, "")


def clean_for_alignment(text: Column) -> Column:
    return F.translate(remove_controls(remove_niqqud(unwrap_brackets(text))), ":", "")


def normalize_for_audio(text: Column) -> Column:
    """Square brackets go with their inside; a long dash behind a word and a space, and a semicolon behind a word, become commas; other long
    dashes spaces; white space is squeezed."""
    out = F.regexp_replace(text, r"(?d)\[.*?\]", "")
    out = F.regexp_replace(out, rf"(?U)({WORD})\s[–—]", "$1,")
    out = F.regexp_replace(out, f"({WORD});", "$1,")
    return F.regexp_replace(F.translate(out, "–—", "  "), r"(?U)\s+", " ")


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def squeeze_marks(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)[\s,.?]+", " ")


def squeeze_inline(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)[^\S\n]+", " ")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def split_points(text: Column) -> Column:
    """Offsets where the text may be cut: 0, and those of spaces and marks."""
    marks = F.filter(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike(r"(?U)^[\s.,;!?()\[\]{}]$"), i)), lambda i: i.isNotNull())
    return F.array_distinct(F.concat(F.array(F.lit(0)), marks))


def ends_sentence(text: Column) -> Column:
    return F.rtrim(F.right(text, F.lit(10))).rlike(r"[,.!?:]$")


def starts_with_word(text: Column) -> Column:
    return text.rlike(f"^{WORD}")


def ends_with_word(text: Column) -> Column:
    return text.rlike(f"{WORD}$")


def tagged(text: Column, tag: str) -> Column:
    """The insides of all <tag>...</tag>."""
    return F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def safe_file_name(text: Column, max_bytes: int = 240) -> Column:
    """Without forbidden characters, long dashes short, cut to max_bytes of UTF-8 at a character."""
    out = F.translate(F.regexp_replace(text, FORBIDDEN, ""), "–—", "--")
    whole = F.aggregate(
        F.split(out, ""),
        F.struct(F.lit("").alias("s"), F.lit(False).alias("full")),
        lambda a, c: F.struct(F.when(a["full"] | (F.octet_length(a["s"]) + F.octet_length(c) > max_bytes), a["s"]).otherwise(F.concat(a["s"], c)).alias("s"), (a["full"] | (F.octet_length(a["s"]) + F.octet_length(c) > max_bytes)).alias("full")),
        lambda a: a["s"],
    )
    return F.when(F.octet_length(out) <= max_bytes, out).otherwise(whole)


def clock_seconds(text: Column) -> Column:
    """HH:MM:SS.mmm as seconds."""
    p = F.split(text, ":")
    return F.get(p, F.lit(0)).cast("double") * 3600 + F.get(p, F.lit(1)).cast("double") * 60 + F.get(p, F.lit(2)).cast("double")


def frame_clock_seconds(text: Column, fps: int = 25) -> Column:
    """HH:MM:SS:FF as seconds."""
    p = F.split(text, ":")
    return F.get(p, F.lit(0)).cast("double") * 3600 + F.get(p, F.lit(1)).cast("double") * 60 + F.get(p, F.lit(2)).cast("double") + F.get(p, F.lit(3)).cast("double") / fps


def seconds_clock(seconds: Column) -> Column:
    """Seconds as HH:MM:SS.mmm."""
    ms = F.round(seconds * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def seconds_clock_whole(seconds: Column) -> Column:
    """Seconds as HH:MM:SS.000: fractions go, days wrap."""
    s = F.floor(seconds).cast("long") % 86400
    return F.format_string("%02d:%02d:%02d.000", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def feed_date(text: Column) -> Column:
    """An RFC 822 date, with a zone's name or offset, as yyyy.MM.dd."""
    bare = F.regexp_replace(text, r"^\s*[A-Za-z]{3},\s*", "")
    when = F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")))
    return F.date_format(when, "yyyy.MM.dd")


def compact_date(text: Column) -> Column:
    """yyyyMMdd as a timestamp; now, if it is none."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyyMMdd")), F.current_timestamp())


def file_date(name: Column) -> Column:
    """The ISO date of a name that begins with YYYY_MM_DD_; else null."""
    return F.replace(F.nullif(F.regexp_extract(name, r"^(\d{4}_\d{2}_\d{2})_", 1), F.lit("")), F.lit("_"), F.lit("-"))


def number_after(text: Column, prefix: str) -> Column:
    """The whole number behind a prefix; null without one."""
    return F.nullif(F.regexp_extract(text, f"{prefix}(\\d+)", 1), F.lit("")).try_cast("long")


def query_param(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def clip_list(ranges: Column) -> Column:
    """start,end,start,end,... with two decimals; "0" for no ranges."""
    text = F.array_join(F.transform(ranges, lambda r: F.concat(F.format_string("%.2f", r["start"]), F.lit(","), F.format_string("%.2f", r["end"]))), ",")
    return F.when(F.size(ranges) > 0, text).otherwise("0")


def seconds_to_frame(seconds: Column, frame: float = 0.02) -> Column:
    """The frame that holds the time: truncated."""
    return (seconds / frame).cast("long")


def seconds_to_frames_nearest(seconds: Column, frame: float = 0.02) -> Column:
    return F.rint(seconds / frame).cast("long")


def clamp_range(start: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """A word's times inside [low, high], with start <= end; a null bound doesn't bound."""
    first = F.least(F.greatest(start, low), high)
    return first, F.greatest(first, F.least(F.greatest(end, low), high))


def _mapped(value: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in names.items():
        out = F.when(value == k, v).otherwise(out)
    return out


def extension_of(mime: Column) -> Column:
    """The file type of a feed's enclosure; unknown ones raise an error."""
    known = _mapped(mime, MIME_EXT)
    return F.when(known.isNotNull(), known).otherwise(F.raise_error(F.concat(F.lit("unknown media type "), F.coalesce(mime, F.lit("null")))).cast("string"))


def audio_extension(container: Column, codec: Column) -> Column:
    """The audio-only file type of a container, else of a codec, else mp3."""
    return F.coalesce(_mapped(container, CONTAINER_EXT), _mapped(codec, CODEC_EXT), F.lit("mp3"))


def is_youtube(url: Column) -> Column:
    return F.coalesce(url.startswith("https://www.youtube.com"), F.lit(False))


def is_soundcloud(url: Column) -> Column:
    return F.coalesce(url.startswith("https://soundcloud.com"), F.lit(False))


def is_host(url: Column, host: str) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("HOST")).rlike(f"(^|\\.){host.replace('.', '[.]')}$"), F.lit(False))


def is_mono(channels: Column) -> Column:
    return F.coalesce(channels == 1, F.lit(False))


def path_parts(path: Column) -> tuple[Column, Column]:
    """(source, episode): the directory of a file, and its name without the extension."""
    p = F.split(path, "/")
    return F.try_element_at(p, F.lit(-2)), F.regexp_replace(F.element_at(p, -1), r"\.[^.]*$", "")
