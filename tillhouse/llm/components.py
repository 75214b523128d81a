"""Connected components of a graph given by its edges, by turns of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillhouse.functions.materialize import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.union(edges.select("b", "a")).toDF("node", "near")
    least = both.groupBy("node").agg(F.min("near").alias("least"))
    return (
        both.where("near > node")
        .join(least, "node")
        .select(F.least("least", "node").alias("a"), F.col("near").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    rest = edges.join(least, "b").where("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return rest.union(least.select(F.col("least").alias("a"), "b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``root``) for each node that has an edge and is not the smallest of its component, which is the root.

    Each turn is written to shared storage.  The number of turns grows with the logarithm of a component's size, squared at
    worst.  Minima are combined before the shuffle; a node with very many neighbours is a skewed key of a join with one row
    per node, which adaptive execution splits.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    now = stored(pairs.distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
