"""Chat formatting: a role automaton, a declarative template and per-segment loss flags.

Turns of a conversation become text segments (head, body, end) that carry a loss
flag; control strings inside texts are escaped reversibly, so `read_turns` and
`read_loss` recover the turns from the output alone.  Only DataFrame functions.

Defined cases: a null text is empty, a null role is the empty role; rows with the same
turn number are ordered by role, then text, and all are kept; a null turn number comes
first; null conversation ids form one conversation; an empty table gives no rows;
columns other than the four needed are ignored.  A conversation is one output row, so
it must fit in memory; conversations are independent of each other.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

START, BAD = "start", "bad"


@dataclass(frozen=True)
class Template:
    """What marks a turn, what is trained on, and which role may follow which.

    `escapes` are applied in order to texts and roles; the first must be the backslash,
    the others map a control string to a backslash and one letter.
    """

    head: str = "### "
    colon: str = ": "
    end: str = "</turn>\n"
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\\\"), ("###", "\\h"), ("</turn>", "\\t"))
    role_escapes: tuple[tuple[str, str], ...] = ((":", "\\c"),)
    loss_roles: tuple[str, ...] = ("assistant",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    accepts: tuple[str, ...] = ("user", "assistant")


def escape(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for plain, marked in pairs:
        text = F.replace(text, F.lit(plain), F.lit(marked))
    return text


def unescape(text: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    """Undo `escape`: a run of backslashes always begins at a mark, so pairs split from the left are escaped backslashes."""

    def marks(part: Column) -> Column:
        for plain, marked in pairs[1:]:
            part = F.replace(part, F.lit(marked), F.lit(plain))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), marks), "\\")


def role_states(roles: Column, template: Template) -> Column:
    """Run the automaton over an array of roles: final state and the position of the first wrong turn."""
    moves = [F.lit(x) for state, nexts in template.follows.items() for role in nexts for x in (f"{state}|{role}", role)]
    table = F.create_map(*moves)
    begin = F.struct(F.lit(START).alias("state"), F.lit(0).alias("seen"), F.lit(None).cast("int").alias("wrong"))

    def move(acc: Column, role: Column) -> Column:
        to = F.coalesce(F.try_element_at(table, F.concat_ws("|", acc["state"], role)), F.lit(BAD))
        return F.struct(
            to.alias("state"),
            (acc["seen"] + 1).alias("seen"),
            F.coalesce(acc["wrong"], F.when(to == BAD, acc["seen"])).alias("wrong"),
        )

    return F.aggregate(roles, begin, move)


def format_chats(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """conv_id, n_turns, valid, wrong_turn, segments array<struct<text, loss>>, formatted: one row per conversation."""
    t = template or Template()
    in_role = t.escapes + t.role_escapes
    turns = conversations.select(
        "conv_id",
        F.struct(
            "turn",
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        ).alias("turn"),
    )
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))

    def parts(turn: Column) -> Column:
        head = F.concat(F.lit(t.head), escape(turn["role"], in_role), F.lit(t.colon))
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(
            piece(head, F.lit(False)),
            piece(escape(turn["text"], t.escapes), turn["role"].isin(*t.loss_roles)),
            piece(F.lit(t.end), F.lit(False)),
        )

    ran = role_states(F.transform("turns", lambda x: x["role"]), t)
    return (
        grouped.withColumn("ran", ran)
        .withColumn("segments", F.flatten(F.transform("turns", parts)))
        .select(
            "conv_id",
            F.size("turns").cast("bigint").alias("n_turns"),
            F.col("ran.state").isin(*t.accepts).alias("valid"),
            F.col("ran.wrong").alias("wrong_turn"),
            "segments",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        )
    )


def read_turns(formatted: Column, template: Template | None = None) -> Column:
    """array<struct<role, text>> read back from formatted text."""
    t = template or Template()
    in_role = t.escapes + t.role_escapes
    parts = F.split(formatted, re.escape(t.end))
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    head, colon = re.escape(t.head), re.escape(t.colon)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, f"(?s)^{head}(.*?){colon}", 1), in_role).alias("role"),
            unescape(F.regexp_extract(p, f"(?s)^{head}.*?{colon}(.*)$", 1), t.escapes).alias("text"),
        ),
    )


def read_loss(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    t = template or Template()
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"], t.escapes)), "")
