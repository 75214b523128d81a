"""Business-rule flags: references to other tables, value domains, past dates and positive numbers.

Rules never remove rows; each adds one boolean, and their conjunction tells whether a row is sound.  A null value
breaks every rule.
"""

from __future__ import annotations

import datetime
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.functions.concurrency import run_together
from tillhouse.functions.keys import MAX_BROADCAST_KEYS, KeyFilter, KeySet

log = logging.getLogger(__name__)

# The rule vocabulary and the names of the flags.
REFERENCE_PREFIX = "df_"
IN_ENUM, IS_PAST, IS_POSITIVE = "in_enum", "is_past", "is_positive"
REFERENCE_FLAG = "df_{parent}_ref"
VALUE_FLAG = "correct_{column}"
OVERALL_FLAG = "business_overall_correct"

FILTER_BITS = 256  # of a filter, for each value that the parent lacks


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    parent: str | None = None

    @property
    def flag(self) -> str:
        if self.parent is not None:
            return REFERENCE_FLAG.format(parent=self.parent)
        return VALUE_FLAG.format(column=self.column)


def parse_rule(column: str, text: str) -> Rule | None:
    """The rule written as ``df_<table>``, ``in_enum``, ``is_past`` or ``is_positive``; None for anything else."""
    if text.startswith(REFERENCE_PREFIX) and text != REFERENCE_PREFIX:
        return Rule(column, REFERENCE_PREFIX, text.removeprefix(REFERENCE_PREFIX))
    return Rule(column, text) if text in (IN_ENUM, IS_PAST, IS_POSITIVE) else None


def _sound(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def in_domain(column: str, values: Sequence, ignore_case: bool = False) -> Column:
    if ignore_case:
        return _sound(F.lower(column).isin([v.lower() for v in values]))
    return _sound(F.col(column).isin(list(values)))


def in_past(column: str, as_of: datetime.datetime | None = None) -> Column:
    now = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    return _sound(F.col(column).cast("timestamp") < now)


def positive(column: str) -> Column:
    return _sound(F.col(column) > 0)


def key_set(parent: DataFrame, column: str) -> KeySet:
    return KeySet.of(parent.select(column).where(F.col(column).isNotNull()).distinct())


def flag_reference(
    df: DataFrame,
    parent: DataFrame | KeySet,
    column: str,
    flag: str,
    values: DataFrame | None = None,
    max_broadcast: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """Add ``flag``: whether the value of ``column`` occurs in the parent's column of that name.

    Rows are not shuffled as long as one of two things is small.  If the parent has few keys, they are broadcast.
    Otherwise the values that the parent lacks, usually few, are looked for among the distinct values, and broadcast.
    When there are many of these as well, a filter of them is broadcast, with the few known values that pass it.  Only
    when these, too, are many are rows and keys joined by a shuffle; there a value that many rows share is split by
    adaptive execution.

    ``values`` is a table that has all values of the column and is cheaper to compute than ``df``.
    """
    known = parent if isinstance(parent, KeySet) else key_set(parent, column)
    if known.fits(max_broadcast):
        return _flag_members(df, F.broadcast(known.keys), column, flag, F.col("_member").isNotNull())

    referred = (df if values is None else values).select(column).where(F.col(column).isNotNull()).distinct()
    unknown = KeySet.of(referred.join(known.keys, column, "left_anti"))
    if unknown.fits(max_broadcast):
        found = F.col("_member").isNull() & F.col(column).isNotNull()
        return _flag_members(df, F.broadcast(unknown.keys), column, flag, found)

    lacking = unknown.filter(FILTER_BITS, max_broadcast)
    if lacking is not None and lacking.suits(df, [column]) and lacking.suits(referred, [column]):
        mistaken = _mistaken(lacking, known, referred, unknown, column, max_broadcast)
        if mistaken.fits(max_broadcast):
            asked = lacking.mark(df, [column], "_passed")
            members = F.broadcast(mistaken.keys.withColumn("_member", F.lit(True)))
            found = F.col(column).isNotNull() & (~F.col("_passed") | F.col("_member").isNotNull())
            return asked.join(members, column, "left").select(*df.columns, found.alias(flag))

    return _flag_members(df, known.keys, column, flag, F.col("_member").isNotNull())


def _mistaken(
    lacking: KeyFilter, known: KeySet, referred: DataFrame, unknown: KeySet, column: str, max_broadcast: int
) -> KeySet:
    """The known values that pass a filter of the unknown ones.

    The parent's keys are stored, so finding them there takes a scan and no shuffle.  Only when these are too many, or of
    another type, the values that are referred to are gathered once more.
    """
    if lacking.suits(known.keys, [column]):
        passed = KeySet.of(lacking.mark(known.keys, [column], "_passed").where("_passed").select(column))
        if passed.fits(max_broadcast):
            return passed
    passing = lacking.mark(referred, [column], "_passed").where("_passed").select(column)
    return KeySet.of(passing.join(unknown.keys, column, "left_anti").distinct())


def _flag_members(df: DataFrame, keys: DataFrame, column: str, flag: str, found: Column) -> DataFrame:
    members = keys.withColumn("_member", F.lit(True))
    return df.join(members, column, "left").select(*df.columns, found.alias(flag))


def _parsed_rules(
    table: str, df: DataFrame, rules: Mapping[str, str], parents: Mapping[str, DataFrame], enums: Mapping[str, Sequence]
) -> list[Rule]:
    """The table's rules, after checking that each of them can be applied."""
    if not rules:
        raise ValueError(f"{table} has no rules to be judged by")
    parsed: list[Rule] = []
    for column, text in rules.items():
        if column not in df.columns:
            raise ValueError(f"a rule names a column that is not there: {table} has no column {column}")
        rule = parse_rule(column, text)
        if rule is None:
            raise ValueError(f"{text!r}, given for {table}.{column}, is not a rule")
        if rule.parent is not None and (rule.parent not in parents or column not in parents[rule.parent].columns):
            raise ValueError(f"{table}.{column} refers to {rule.parent}, which does not have that column")
        if rule.kind == IN_ENUM and column not in enums:
            raise ValueError(f"{table}.{column} has no list of values to be one of")
        if any(rule.flag == other.flag for other in parsed):
            raise ValueError(f"two rules of {table} would both write {rule.flag}; the second is that of {column}")
        parsed.append(rule)
    return parsed


def _flag_parsed(
    df: DataFrame,
    parsed: Sequence[Rule],
    key_sets: Mapping[tuple[str, str], KeySet],
    enums: Mapping[str, Sequence],
    values: DataFrame,
    as_of: datetime.datetime | None,
    ignore_case: bool,
) -> DataFrame:
    """The table with one flag per rule, in rule order, and the overall flag, in a projection over the lookups."""
    joined = df
    for rule in parsed:
        if rule.parent is not None:
            joined = flag_reference(joined, key_sets[rule.parent, rule.column], rule.column, rule.flag, values)

    def flag(rule: Rule) -> Column:
        if rule.parent is not None:
            return F.col(rule.flag)
        if rule.kind == IN_ENUM:
            return in_domain(rule.column, enums[rule.column], ignore_case)
        return in_past(rule.column, as_of) if rule.kind == IS_PAST else positive(rule.column)

    overall = reduce(and_, [flag(rule) for rule in parsed])
    return joined.select(*df.columns, *[flag(rule).alias(rule.flag) for rule in parsed], overall.alias(OVERALL_FLAG))


def flag_tables(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Mapping[str, str]],
    enums: Mapping[str, Sequence],
    parents: Mapping[str, DataFrame] | None = None,
    values: Mapping[str, DataFrame] | None = None,
    as_of: datetime.datetime | None = None,
    ignore_case: bool = False,
) -> dict[str, DataFrame]:
    """Flag every table; every table needs rules.  Without any rules or enums there is no result.

    ``parents`` are the tables that references point to and ``values`` the tables that referring values are collected
    from (see :func:`flag_reference`), by default the flagged tables themselves.  Each parent's keys are computed once
    for all tables that refer to them.
    """
    if not rules or not enums:
        log.error("no business rules or no enums are configured")
        return {}
    targets = tables if parents is None else parents
    parsed = {name: _parsed_rules(name, df, rules.get(name, {}), targets, enums) for name, df in tables.items()}
    lookups = {(rule.parent, rule.column) for each in parsed.values() for rule in each if rule.parent is not None}
    key_sets = _compute_together(
        tables, {lookup: partial(key_set, targets[lookup[0]], lookup[1]) for lookup in sorted(lookups)}
    )
    return _compute_together(
        tables,
        {
            name: partial(
                _flag_parsed, df, parsed[name], key_sets, enums, (values or tables)[name], as_of, ignore_case
            )
            for name, df in tables.items()
        },
    )


def _compute_together(tables: Mapping[str, DataFrame], actions: Mapping) -> dict:
    return run_together(next(iter(tables.values())).sparkSession, actions) if actions else {}
