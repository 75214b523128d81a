"""Filter interaction audit: what each of several document filters removes, alone, after others, and in every order.

Filters that judge a text by itself are bits of one projection.  The last one looks at the table: a document fails it if a
document of smaller id has the same text.  That is an existential self-join, a left-semi join on the text's hash, the exact
text and the smaller id.  The rows that it marks are united with the failures of the other filters as counts of bit
combinations, at most 32 for each part, and every figure of every order is a sum over those.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from itertools import permutations
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.functions.materialize import stored
from tillhouse.llm.common import let, words

NAMES = "ABCDE"
COPY = 1 << NAMES.index("E")
MARKED = r"[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTED = ("n", "good", "toxic")


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def bits(tokens: Column) -> Column:
        few = F.size(tokens) < 100
        repetitive = F.size(F.array_distinct(tokens)).cast("long") * 100 < F.size(tokens).cast("long") * 80
        return F.when(few, 1).otherwise(0) + F.when(repetitive, 2).otherwise(0)

    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    loud = capitals.cast("long") * 100 > F.length(text).cast("long") * 10
    return let(words(text), bits) + F.when(loud, 4).otherwise(0) + F.when(text.rlike(MARKED), 8).otherwise(0)


def later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text a row with a smaller key has as well.

    Only rows whose hash occurs again carry their text through a shuffle, and of those each text's smallest key is found with
    partial aggregation, so that a text held by a third of all rows meets one row.  Rows without a key have no place in
    the order: none is smaller, and none is removed.  Rows that repeat with their key are no copies of each other.
    """
    whole = F.struct(*(docs[name] for name in docs.columns)).alias("row")
    own = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(whole, docs[key].alias("key"), own.alias("own"), F.xxhash64(own).alias("hash")).where("key IS NOT NULL")
    repeated = rows.groupBy("hash").agg(F.min("key").alias("least"), F.max("key").alias("most")).where("least < most")
    repeated = stored(repeated.select("hash"), "repeated-hashes")
    copies = rows.join(repeated, "hash", "left_semi")
    first = copies.groupBy(F.col("hash").alias("h"), F.col("own").alias("t")).agg(F.min("key").alias("least"))
    first = stored(first, "first-copies")  # a join of two exchanges, which adaptive execution splits where one text is hot
    earlier = (F.col("hash") == F.col("h")) & (F.col("own") == F.col("t")) & (F.col("least") < F.col("key"))
    return copies.join(first, earlier, "left_semi").select("row.*")


def combinations(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Per part and combination of failed filters: ``n`` documents, ``good`` and ``toxic`` ones among them.

    A document is good or toxic if any of its labels says so.  Rows without a part form the part of the empty string.
    """
    says = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )

    def counts(rows: DataFrame, copy: bool) -> DataFrame:
        own = rows.select(
            rows[key].alias("id"),
            F.coalesce(rows[part].cast("string"), F.lit("")).alias("part"),
            text_failures(rows[text]).alias("failed"),
        )
        # counted by id before the labels join, so that rows repeated under one id are one row
        by_id = own.groupBy("id", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
        judged = by_id.join(says, "id", "left")
        sums = [
            F.sum("n").alias("n"),
            *(F.sum(F.col("n") * F.coalesce(F.col(name), F.lit(0))).alias(name) for name in COUNTED[1:]),
        ]
        return judged.groupBy("part", "failed").agg(*sums).withColumn("copy", F.lit(copy))

    chosen = docs.select(key, text, part)
    both = counts(chosen, False).unionByName(counts(later_copies(chosen, key, text), True))
    # a copy is counted with its bit and taken from those without it
    placed = both.select(
        "part",
        F.explode(
            F.when(
                F.col("copy"),
                F.array(
                    F.struct((F.col("failed") + COPY).alias("failed"), F.lit(1).alias("sign")),
                    F.struct(F.col("failed").alias("failed"), F.lit(-1).alias("sign")),
                ),
            ).otherwise(F.array(F.struct(F.col("failed").alias("failed"), F.lit(1).alias("sign"))))
        ).alias("at"),
        *COUNTED,
    )
    return placed.groupBy("part", F.col("at.failed").alias("failed")).agg(
        *(F.sum(F.col(name) * F.col("at.sign")).alias(name) for name in COUNTED)
    )


def _steps() -> list[dict]:
    """For all orders and steps: the step's filter with its bit, and the bits of the filters before it."""
    out = []
    for order in map("".join, permutations(NAMES)):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << NAMES.index(name)
            out.append({"filter_order": order, "step": step, "filter": name, "before": before, "bit": bit})
            before |= bit
    return out


def audit(counted: DataFrame) -> DataFrame:
    """From ``combinations``: a row per part, order of the filters and step, zeros included.

    Of the documents with a combination of k failed filters, each of the k removes all in 120 / k of the 120 orders: those
    in which it comes first among them.
    """
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("failed", *COUNTED)).alias("counts"))  # 32 at most
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order:string,step:int,filter:string,before:int,bit:int>>")
    rows = parts.select("part", "counts", F.explode(steps).alias("s"))
    bit, before = F.col("s.bit"), F.col("s.before")

    def total(wanted: Callable[[Column], Column], amount: Callable[[Column], Column]) -> Column:
        chosen = F.transform(F.filter("counts", lambda c: wanted(c["failed"])), amount)
        return F.aggregate(chosen, F.lit(0).cast("long"), add)

    def has(failed: Column, bits: Column) -> Column:
        return failed.bitwiseAND(bits) != 0

    def removed(name: str) -> Column:
        return total(lambda failed: has(failed, bit) & ~has(failed, before), lambda c: c[name])

    def shares(c: Column) -> Column:
        return c["n"] * F.get(F.array(*(F.lit(120 // k) for k in range(1, len(NAMES) + 1))), F.bit_count(c["failed"]) - 1)

    return rows.select(
        "part",
        "s.filter_order",
        "s.step",
        "s.filter",
        total(lambda failed: ~has(failed, before.bitwiseOR(bit)), lambda c: c["n"]).alias("kept"),
        removed("n").alias("removed"),
        total(lambda failed: has(failed, bit) & has(failed, before), lambda c: c["n"]).alias("redundant"),
        total(lambda failed: failed == bit, lambda c: c["n"]).alias("unique_fails"),
        removed("good").alias("good_lost"),
        removed("toxic").alias("toxic_lost"),
        total(lambda failed: has(failed, bit), shares).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The audit of the five filters over ``docs``, a row per part, order and step.

    Null and empty texts are equal texts without words.  Rows without key, and rows repeated with their key, count each
    time.  Other columns are ignored, whatever their names.  An empty table has no parts and gives no rows.
    """
    return audit(stored(combinations(docs, labels, key, text, part), "filter-combinations"))
