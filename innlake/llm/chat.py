"""Conversations as training text: roles checked by a finite-state machine, segments with loss flags from a template.

A template declares the states a role may be read in, the strings around a turn, and which roles are learnt.
Control strings inside texts are escaped reversibly: the escape character is doubled and the first two characters
of a marker become the escape character and a letter, so no marker can appear inside a text.
Reading back cuts the formatted text at its markers and takes the escapes out again.

Only built-in functions are used. Turns of a conversation are gathered by one aggregation; a conversation is one
result row whatever the engine, and its turns never leave it.

Defined results: null texts are empty; a null or unknown role makes the conversation invalid and is written
as it is (null as empty); ties in the turn number are ordered by role and text; repeated rows are turns of their own; null turn numbers
come first; a null conversation id is a conversation. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class ChatTemplate:
    """Marker strings, learnt roles, and the machine: state, role -> next state."""

    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_turn: str = "\n"
    learnt: tuple[str, ...] = ("assistant",)
    begin: str = "begin"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("begin", "system"): "told", ("begin", "user"): "asked", ("told", "user"): "asked",
        ("asked", "assistant"): "answered", ("answered", "user"): "asked",
    })
    final: tuple[str, ...] = ("answered", "asked")


def _marks(template: ChatTemplate) -> dict[str, str]:
    """What is escaped, and by which letter after the escape character."""
    return {template.start[:2]: "l", template.end[:2]: "l" if template.end[:2] == template.start[:2] else "r", template.after_role: "n"}


def _escaped(text: Column, template: ChatTemplate, role: bool = False) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + ESCAPE))
    for mark, letter in _marks(template).items():
        if role or letter != "n":
            text = F.replace(text, F.lit(mark), F.lit(ESCAPE + letter))
    return text


def _unescaped(text: Column, template: ChatTemplate) -> Column:
    """Undo the escapes: doubled escape characters part the text, the pieces between are read each for itself."""
    parts = F.split(text, r"\\\\", -1)
    for mark, letter in _marks(template).items():
        whole, plain = F.lit(ESCAPE + letter), F.lit(mark)
        parts = F.transform(parts, lambda p: F.replace(p, whole, plain))  # noqa: B023  built at once
    return F.array_join(parts, ESCAPE)


def _machine(roles: Column, template: ChatTemplate) -> Column:
    """The state after all roles; a missing move ends in ``invalid`` for good."""
    moves = F.create_map(*(F.lit(x) for (state, role), then in template.moves.items() for x in (f"{state}\n{role}", then)))
    return F.aggregate(roles, F.lit(template.begin), lambda state, role: F.coalesce(
        F.try_element_at(moves, F.concat(state, F.lit("\n"), F.coalesce(role, F.lit("")))), F.lit("invalid")))


def format_chats(turns: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """(conv_id, valid, segments): text segments in order, each with its loss flag; joined they are the training text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text")).alias("row"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    learnt = lambda r: r["role"].isin(*template.learnt)
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("rows", lambda r: F.array(
        segment(F.concat(F.lit(template.start), _escaped(r["role"], template, role=True), F.lit(template.after_role)), F.lit(False)),
        segment(_escaped(r["text"], template), learnt(r)),
        segment(F.lit(template.end + template.after_turn), F.lit(False)),
    )))
    state = _machine(F.transform("rows", lambda r: r["role"]), template)
    return chats.select("conv_id", state.isin(*template.final).alias("valid"), segments.alias("segments"))


def read_chats(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """(conv_id, turns) from (conv_id, formatted): the roles and texts that stand in the formatted text."""
    mark = F.lit(template.end + template.after_turn)
    cut = F.split(F.col("formatted"), F.concat(F.lit(r"\Q"), mark, F.lit(r"\E")), -1)
    chunks = F.slice(cut, F.lit(1), F.size(cut) - 1)
    skip = F.lit(len(template.start) + 1)
    turns = F.transform(chunks, lambda c: F.transform(
        F.array(F.substring_index(c, template.after_role, 1)), lambda head: F.struct(
            _unescaped(F.substring(head, skip, F.length(head)), template).alias("role"),
            _unescaped(F.substring(c, F.length(head) + 1 + len(template.after_role), F.length(c)), template).alias("text"),
        ))[0])
    return formatted.select("*", turns.alias("turns"))


def formatted_texts(chats: DataFrame) -> DataFrame:
    """The chats with ``formatted``, the joined segments."""
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.withColumn("formatted", joined)


def learnt_text(template: ChatTemplate = ChatTemplate()) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: _unescaped(s["text"], template)), "")
