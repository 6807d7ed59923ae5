"""Chat formatting: a declarative template, a finite-state machine over roles, and segments with loss flags.

All of it is DataFrame functions. Turns become pieces before they are shuffled; a conversation, which is one output
row, gathers its own pieces only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """open_with + role + open_end + text + close for each turn; loss: the roles whose texts are learned.

    moves: (state, role) -> state of the machine; start and accept name its states. Control strings (open_with, close and
    extra ones) can't stand in a text: a backslash goes after their first character, and backslashes double. The first character of a
    control string must not occur later in any of them, so none can form across the border of a text.
    """

    open_with: str = "<turn role="
    open_end: str = ">\n"
    close: str = "\n</turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    control: tuple[str, ...] = ("<turn role=", "</turn>")
    start: str = "start"
    accept: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )

    def __post_init__(self):
        heads = {c[:1] for c in self.control}
        if any(len(c) < 2 or "\\" in c for c in self.control) or any(h in c[1:] for h in heads for c in self.control):
            raise ValueError("a control string is too short, holds a backslash, or repeats a first character")
        if not any(c in self.open_with for c in self.control) or not any(c in self.close for c in self.control):
            raise ValueError("open_with and close must hold a control string")


DEFAULT = Template()


def escape(text: Column, template: Template = DEFAULT) -> Column:
    rest = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in template.control)
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"({rest})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """No > and no line end is left in it."""
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    mark = F.lit("\\\x00")
    out = F.replace(role, F.lit("\\\\"), mark)
    return F.replace(F.replace(F.replace(out, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n")), mark, F.lit("\\"))


def format_chats(turns: DataFrame, template: Template = DEFAULT, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, segments, formatted, roles, valid, error_at.

    segments: array of (text, loss) whose texts, joined, are formatted: three a turn, head, escaped text and close, of which
    the text alone can be under the loss mask. valid: the machine accepts the roles; error_at: the first turn
    (from 0) without a move, the number of turns if the conversation ends in a state that doesn't accept, else null.
    Invalid conversations are formatted too.

    Turns sort by turn, then role, then text as it stands in turns, nulls first; repeated rows are turns of their own. Null role or text: empty.
    Null conv_id: one conversation. Other columns are dropped. An empty table gives no rows.
    """
    role, raw = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    text = escape(raw, template)
    head = F.concat(F.lit(template.open_with), escape_role(role), F.lit(template.open_end))
    pieces = turns.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), role.alias("role"), raw.alias("raw"), F.when(text != raw, text).alias("escaped"), head.alias("head")).alias("_p"))
    got = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list("_p")).alias("_p"))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)
    segments = F.flatten(F.transform("_p", lambda p: F.array(part(p["head"], no), part(F.coalesce(p["escaped"], p["raw"]), p["role"].isin(list(template.loss))), part(F.lit(template.close), no))))
    got = got.select("conv_id", segments.alias("segments"), F.col("_p.role").alias("roles"))
    moves = F.create_map(*[F.lit(x) for (state, name), to in template.moves.items() for x in (f"{state}\n{name}", to)])
    step = lambda s, r: F.when(s["err"].isNotNull(), s).otherwise(
        F.struct(F.coalesce(moves[F.concat_ws("\n", s["state"], r)], F.lit("")).alias("state"), (s["at"] + 1).alias("at"), F.when(moves[F.concat_ws("\n", s["state"], r)].isNull(), s["at"]).alias("err"))
    )
    end = F.aggregate(F.col("roles"), F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("err")), step)
    error = F.coalesce(F.col("_end.err"), F.when(~F.col("_end.state").isin(list(template.accept)), F.col("_end.at")))
    out = got.withColumns({"formatted": F.array_join("segments.text", ""), "_end": end})
    return out.select("conv_id", "segments", "formatted", "roles", error.isNull().alias("valid"), error.alias("error_at"))


def read_turns(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns (role, text) read back from a formatted text alone."""
    parts = F.filter(F.split(formatted, re.escape(template.close)), lambda p: p != "")
    start, end = re.escape(template.open_with), re.escape(template.open_end)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.regexp_extract(p, f"(?s)^{start}([^>]*?){end}", 1)).alias("role"),
            unescape(F.regexp_replace(p, f"(?s)^{start}[^>]*?{end}", "")).alias("text"),
        ),
    )


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
