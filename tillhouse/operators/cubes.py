"""Grouping sets, rollups and cubes by re-aggregation: each set from the smallest finer result, not from the rows.

Spark's own grouping sets copy every row once for each set before the first shuffle.  Here rows are aggregated once, by
all keys and combined on the map side; every other set is made from what is already there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.functions.materialize import stored
from tillhouse.functions.money import SCALE, mean_cents, money, total_units


@dataclass(frozen=True)
class Measure:
    """An aggregate in three steps: partial states of rows, a merge of each state, and the result of the states."""

    states: dict[str, tuple[Column, Callable[[Column], Column]]]
    result: Callable[[dict[str, Column]], Column]


def row_count() -> Measure:
    return Measure({"n": (F.count(F.lit(1)), F.sum)}, lambda s: F.coalesce(s["n"], F.lit(0)))


def value_count(value: Column) -> Measure:
    return Measure({"n": (F.count(value), F.sum)}, lambda s: F.coalesce(s["n"], F.lit(0)))


def total(value: Column) -> Measure:
    """Sum of integers; null without any value."""
    return Measure({"sum": (F.sum(value.cast("long")), F.sum)}, lambda s: s["sum"])


def money_total(amount: Column, scale: int = SCALE) -> Measure:
    """Exact sum of amounts, rounded to cents once; null without any amount."""
    return Measure({"sum": (total_units(amount, scale), F.sum)}, lambda s: money(s["sum"], scale))


def money_mean(amount: Column, scale: int = SCALE) -> Measure:
    """Mean of the amounts that are not null, rounded to cents once."""
    states = {"sum": (total_units(amount, scale), F.sum), "n": (F.count(amount), F.sum)}
    return Measure(states, lambda s: mean_cents(s["sum"], s["n"], scale).cast("double") / F.lit(100.0))


def smallest(value: Column) -> Measure:
    return Measure({"min": (F.min(value), F.min)}, lambda s: s["min"])


def largest(value: Column) -> Measure:
    return Measure({"max": (F.max(value), F.max)}, lambda s: s["max"])


def cube_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    return [chosen for n in range(len(keys), -1, -1) for chosen in combinations(keys, n)]


def rollup_sets(keys: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(keys[:n]) for n in range(len(keys), -1, -1)]


def _states(measures: dict[str, Measure]) -> dict[str, tuple[Column, Callable[[Column], Column]]]:
    return {f"{name}:{state}": how for name, measure in measures.items() for state, how in measure.states.items()}


def _parent(chosen: tuple[str, ...], done: dict[tuple[str, ...], tuple[DataFrame, int]]) -> tuple[str, ...]:
    """The keys of the stored result with the fewest rows among those that have all keys of a set."""
    return min((size, len(keys), keys) for keys, (_, size) in done.items() if set(chosen) <= set(keys))[2]


def grouping_sets(
    df: DataFrame, keys: Sequence[str], sets: Iterable[Sequence[str]], measures: dict[str, Measure]
) -> DataFrame:
    """The measures by each of some sets of ``keys``, with null for the keys that a set lacks.

    ``grouping_id`` has a bit for each key, the first key's the highest, which is 1 where the set lacks the key; it tells
    such a null from one in the table, which is a group like others.  The empty set gives one row, also for an empty
    table, where other sets give none.  Each set may be named once; columns besides keys and those in measures are
    ignored.  Results that others are made from are stored.
    """
    named = [set(own) for own in sets]
    chosen = [tuple(key for key in keys if key in own) for own in named]
    if not chosen or len(set(chosen)) < len(chosen) or len(set(keys)) < len(keys):
        raise ValueError("keys and sets must be named once, and at least one set")
    if unknown := set().union(*named) - set(keys):
        raise ValueError(f"not among the keys: {sorted(unknown)}")
    if "grouping_id" in (*keys, *measures) or set(keys) & set(measures):
        raise ValueError("names of keys, measures and grouping_id clash")
    states = _states(measures)
    finest = stored(df.groupBy(*keys).agg(*[first.alias(name) for name, (first, _) in states.items()]), "cube")
    done = {tuple(keys): (finest, finest.count())}
    results = []
    for own in sorted(chosen, key=len, reverse=True):
        if own not in done:
            parent = done[_parent(own, done)][0]
            merged = parent.groupBy(*own).agg(*[merge(F.col(f"`{name}`")).alias(name) for name, (_, merge) in states.items()])
            if any(set(other) < set(own) for other in chosen):
                merged = stored(merged, "cube")
                done[own] = merged, merged.count()
        else:
            merged = done[own][0]
        results.append(_finished(merged, keys, own, measures, finest))
    return reduce(DataFrame.unionByName, results)


def _finished(
    merged: DataFrame, keys: Sequence[str], own: tuple[str, ...], measures: dict[str, Measure], finest: DataFrame
) -> DataFrame:
    absent = sum(1 << (len(keys) - 1 - k) for k, key in enumerate(keys) if key not in own)
    return merged.select(
        *[F.col(key) if key in own else F.lit(None).cast(finest.schema[key].dataType).alias(key) for key in keys],
        F.lit(absent).cast("long").alias("grouping_id"),
        *[
            measure.result({state: F.col(f"`{name}:{state}`") for state in measure.states}).alias(name)
            for name, measure in measures.items()
        ],
    )


def cube(df: DataFrame, keys: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
    """``grouping_sets`` by all sets of the keys."""
    return grouping_sets(df, keys, cube_sets(keys), measures)


def rollup(df: DataFrame, keys: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
    """``grouping_sets`` by all keys, all but the last, and so on to none."""
    return grouping_sets(df, keys, rollup_sets(keys), measures)
