"""Chat formatting: turns to marked-up text with loss flags, from a declarative template, and back."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.llm.common import let

START, INVALID = "start", "invalid"


@dataclass(frozen=True)
class Template:
    """Marks around each turn, strings that must not appear unescaped in a text, roles to learn, and legal role orders.

    Marks and control strings begin with ``<`` or ``[``, hold these two characters nowhere else, and no backslash.
    """

    open: str = "<|turn|>"
    body: str = "<|text|>"
    close: str = "<|end|>"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
    learned: tuple[str, ...] = ("assistant",)
    order: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            START: ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    final: tuple[str, ...] = ("user", "assistant")

    @property
    def reserved(self) -> tuple[str, ...]:
        return (self.open, self.body, self.close, *self.control)

    def escape(self, text: Column) -> Column:
        """A backslash before each backslash and behind the first character of each reserved string."""
        places = [r"(?=\\)", *(f"(?<={re.escape(s[0])})(?={re.escape(s[1:])})" for s in self.reserved)]
        return F.regexp_replace(text, "|".join(places), r"\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def state(self, roles: Column) -> Column:
        """The state after all roles; roles are states, and a role that may not follow leads to ``invalid`` for good."""
        arcs = {f"{state} {role}": role for state, roles_ in self.order.items() for role in roles_}
        table = F.create_map(*map(F.lit, chain.from_iterable(arcs.items())))
        return F.aggregate(
            roles,
            F.lit(START),
            lambda state, role: F.coalesce(F.try_element_at(table, F.concat(state, F.lit(" "), role)), F.lit(INVALID)),
        )

    def segments(self, turns: Column) -> Column:
        """Text segments in order, each with its loss flag, of an array of (role, text)."""

        def of(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        def turn(entry: Column) -> Column:
            head = F.concat(F.lit(self.open), self.escape(entry["role"]), F.lit(self.body))
            return F.array(
                of(head, F.lit(False)),
                of(self.escape(entry["text"]), entry["role"].isin(list(self.learned))),
                of(F.lit(self.close), F.lit(False)),
            )

        return F.flatten(F.transform(turns, turn))

    def read_turns(self, formatted: Column) -> Column:
        """The (role, text) turns that a formatted text holds."""

        def turn(piece: Column) -> Column:
            return let(
                F.split(piece, re.escape(self.body), -1),
                lambda parts: F.struct(
                    self.unescape(F.substr(parts[0], F.lit(len(self.open) + 1))).alias("role"),
                    self.unescape(parts[1]).alias("text"),
                ),
            )

        pieces = F.split(formatted, re.escape(self.close), -1)
        return let(pieces, lambda found: F.transform(F.slice(found, F.lit(1), F.size(found) - 1), turn))

    def read_learned(self, segments: Column) -> Column:
        """All text under the loss mask, unescaped."""
        learned = F.filter(segments, lambda segment: segment["loss"])
        return F.array_join(F.transform(learned, lambda segment: self.unescape(segment["text"])), "")


def format_conversations(
    rows: DataFrame,
    template: Template = Template(),
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: ``conversation``, ``n_turns``, ``valid``, ``segments`` and ``formatted``.

    A conversation is one training example and one output value, so its rows meet in one task.  Turns are ordered by turn
    number, then role, then text, nulls first, so equal numbers and repeated rows have a defined place; all are kept.
    Null roles and texts read as empty; rows without a conversation id form one conversation.  ``valid`` tells whether the
    automaton over roles ends in a final state; invalid conversations are formatted all the same.  An empty table has no
    conversations.  Other columns are ignored.
    """
    entry = F.struct(
        rows[turn].alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit("")).alias("text"),
    )
    grouped = (
        rows.select(rows[conversation].alias("conversation"), entry.alias("entry"))
        .groupBy("conversation")
        .agg(F.array_sort(F.collect_list("entry")).alias("turns"))
    )
    segmented = grouped.select(
        "conversation",
        F.size("turns").cast("long").alias("n_turns"),
        template.state(F.col("turns.role")).isin(list(template.final)).alias("valid"),
        template.segments(F.col("turns")).alias("segments"),
    )
    return segmented.withColumn("formatted", F.array_join(F.col("segments.text"), ""))
