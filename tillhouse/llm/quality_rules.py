"""Quality rules: a threshold table compiled into one projection of counts over each text.

All measures are integers; a rule bounds one of them by a share of another, in integer arithmetic, so that engines agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.llm.common import let, words

# Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it was on are as with be by at this from or an not have a "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch in "
    "de la le et les des en un du une que est pour qui dans par sur au il elle pas avec "
    "el los se del las por con para como y o su una al lo es no"
).split()

SYMBOLS = r"[#*$%&|<>]+"
MARKS = r"[!]+"
CAPITALS = r"[A-Z]+"


@dataclass(frozen=True)
class Rule:
    """``low * base <= 100 * measure <= high * base``; without a base the measure itself is bounded."""

    name: str
    measure: str
    base: str | None = None
    low: int | None = None
    high: int | None = None

    def holds(self, measures: dict[str, Column]) -> Column:
        value = measures[self.measure] if self.base is None else measures[self.measure] * 100
        unit = F.lit(1) if self.base is None else measures[self.base]
        bounds = [value >= unit * self.low] if self.low is not None else []
        bounds += [value <= unit * self.high] if self.high is not None else []
        return reduce(and_, bounds, F.lit(True))


RULES = (
    Rule("words", "n_words", low=50),
    Rule("word length", "word_chars", "n_words", low=250, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("exclamation marks", "n_marks", "n_words", high=20),
    Rule("capitals", "n_capitals", "word_chars", high=40),
    Rule("stop words", "n_stop_words", "n_words", low=6),
    Rule("repeated lines", "n_dup_lines", "n_lines", high=50),
    Rule("repeated words", "n_repeat_words", "n_words", high=50),
)


def _count_chars(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(tokens: Column) -> Column:
    """Words inside a three-word window that occurs again in the text."""

    def starts(windows: Column) -> Column:
        numbered = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("w"), at.alias("at"))))

        def again(found: Column) -> Column:
            def same(entry: Column, other: Column) -> Column:
                return F.coalesce(entry["w"] == F.get(found, other)["w"], F.lit(False))

            return F.filter(found, lambda entry, k: same(entry, k - 1) | same(entry, k + 1))

        return let(numbered, again)

    def covered(windows: Column) -> Column:
        near = F.transform(starts(windows), lambda entry: F.array(entry["at"], entry["at"] + 1, entry["at"] + 2))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            F.size(F.array_distinct(F.flatten(near)))
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 3),
        lambda at: F.concat_ws(" ", F.get(tokens, at), F.get(tokens, at + 1), F.get(tokens, at + 2)),
    )
    return F.when(F.size(tokens) < 3, 0).otherwise(let(windows, covered))


def measures(text: Column) -> Column:
    """A struct of the counts that rules refer to; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def counts(tokens: Column) -> Column:
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            F.size(F.filter(tokens, lambda word: F.lower(word).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeat_words(tokens).cast("long").alias("n_repeat_words"),
        )

    def line_counts(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("long").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
        )

    return F.struct(
        let(words(text), counts).alias("words"),
        let(lines, line_counts).alias("lines"),
        _count_chars(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count_chars(text, MARKS).cast("long").alias("n_marks"),
        _count_chars(text, CAPITALS).cast("long").alias("n_capitals"),
    )


def verdict(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """A struct of the measures, ``base_failed``, the names of the rules that the text breaks, and ``kept``.

    One expression that names the measures once: a filter on it, which Spark moves into the scan, computes them once.
    """

    def judge(m: Column) -> Column:
        flat = {
            name: m[name] if inner is None else m[inner][name]
            for inner, names in (
                ("words", ("n_words", "word_chars", "n_stop_words", "n_repeat_words")),
                ("lines", ("n_lines", "n_dup_lines")),
                (None, ("n_symbols", "n_marks", "n_capitals")),
            )
            for name in names
        }
        base_failed = (flat["n_words"] < 50) | (flat["n_repeat_words"] * 100 > flat["n_words"] * 50)
        broken = F.filter(
            F.array(*(F.when(~rule.holds(flat), F.lit(rule.name)) for rule in rules)).cast("array<string>"),
            lambda name: name.isNotNull(),
        )
        kept = reduce(and_, (rule.holds(flat) for rule in rules), ~base_failed)
        return F.struct(
            *(column.alias(name) for name, column in flat.items()),
            base_failed.alias("base_failed"),
            broken.alias("broken_rules"),
            kept.alias("kept"),
        )

    return let(measures(text), judge)


def apply_rules(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Each row as ``row``, with the fields of ``verdict``.

    One projection without shuffle, join or user function.  Rows are judged alone: repeated rows get repeated results, an
    empty table an empty one.  Null and empty texts have no words and fail the rule on their number.  Columns of ``docs``
    stay inside ``row``, so their names cannot clash with the measures.
    """
    row = F.struct(*(docs[name] for name in docs.columns)).alias("row")
    return docs.select(row, verdict(docs[text], rules).alias("verdict")).select("row", "verdict.*")


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, unchanged."""
    return docs.where(verdict(docs[text], rules)["kept"])
