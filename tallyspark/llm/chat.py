"""Conversations as training text with a loss mask, all in column functions.

A template is plain data: a begin and an end mark, the marks' common opening,
the roles, the turn order as a finite-state machine and the roles whose text
carries loss.  ``format_chat`` renders each conversation as segments
``(role, text, loss)`` and one string; ``read_chat`` parses that string back.

Escaping: inside a text the opening ``<|`` may not occur, so every ``<``, n
backslashes, ``|`` gets one backslash more; reading takes one away.  In a role
``\\`` becomes ``\\\\`` and a line feed ``\\n`` before that.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``order`` maps a state to {role: next state}; ``accept`` are the states
    a conversation may end in."""

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    order: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "instructed", "user": "asked"},
        "instructed": {"user": "asked"},
        "asked": {"assistant": "answered"},
        "answered": {"user": "asked"},
    })
    accept: tuple[str, ...] = ("asked", "answered")

    def __post_init__(self):
        if not (self.begin.startswith("<|") and self.end.startswith("<|")):
            raise ValueError("both marks must open with <|")
        if self.begin.startswith(self.end) or self.end.startswith(self.begin):
            raise ValueError("one mark may not begin the other")


CHAT = ChatTemplate()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    halves = F.split(unescape(role), r"\\\\", -1)  # a backslash pair is one backslash
    return F.array_join(F.transform(halves, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def turn_order(roles: Column, template: ChatTemplate = CHAT) -> Column:
    """The machine's state after the roles; ``error`` once no rule fits."""
    steps = F.create_map(*[F.lit(x) for state, rules in template.order.items()
                           for role, to in rules.items() for x in (f"{state}\x00{role}", to)])
    return F.aggregate(
        roles, F.lit(template.start),
        lambda state, role: F.coalesce(F.try_element_at(steps, F.concat(state, F.lit("\x00"), role)), F.lit("error")))


def format_chat(turns: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """One row per ``conv_id``: ``segments array<(text, loss)>``, ``formatted``,
    ``valid`` (the machine accepts the turn order) and ``final_state``.

    Turns go in order of (turn, role, text), nulls first; a null text or role
    is empty; repeated rows are repeated turns; null conv_ids form one
    conversation; other columns are not read; no rows give no rows.  An
    invalid order is reported, not dropped.
    """
    said = turns.select(
        "conv_id", F.struct(
            F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("said"))
    grouped = said.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    marked = F.array(*[F.lit(r) for r in template.loss_roles])
    segments = F.flatten(F.transform("said", lambda t: F.array(
        F.struct(F.concat(F.lit(template.begin), escape_role(t["role"]), F.lit("\n")).alias("text"),
                 F.lit(False).alias("loss")),
        F.struct(escape(t["text"]).alias("text"), F.array_contains(marked, t["role"]).alias("loss")),
        F.struct(F.lit(template.end).alias("text"), F.lit(False).alias("loss")))))
    state = turn_order(F.transform("said", lambda t: t["role"]), template)
    return (grouped.select("conv_id", segments.alias("segments"), state.alias("final_state"))
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
            .withColumn("valid", F.col("final_state").isin(*template.accept)))


def read_chat(formatted: DataFrame, template: ChatTemplate = CHAT) -> DataFrame:
    """Adds ``turns array<(role, text)>`` parsed from ``formatted`` alone, and
    ``loss_text``: the unescaped text of the segments under the mask."""
    parts = F.split(F.col("formatted"), "(?:" + _quoted(template.end) + ")", -1)
    bodies = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
                         lambda p: F.substr(p, F.lit(len(template.begin) + 1)))
    turns = F.transform(bodies, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substr(p, F.length(F.substring_index(p, "\n", 1)) + 2)).alias("text")))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return formatted.withColumn("turns", turns).withColumn("loss_text", F.array_join(loss, ""))


def _quoted(mark: str) -> str:
    return "".join(("\\" + c) if not c.isalnum() and c not in "_\n" else c for c in mark)
