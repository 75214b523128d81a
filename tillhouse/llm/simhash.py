"""SimHash near-duplicates: meet-in-the-middle ball hashing.

A text's fingerprint has the bits that most hashes of its shingles have.  Two fingerprints that differ in at most 2r bits
have a common variant within r bits of both, so every distinct fingerprint emits all variants within r bits, and those that
share a variant meet.  All that meet differ in at most 2r bits, and are at most as many as there are variants of one
fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillhouse.functions.materialize import stored
from tillhouse.llm.common import free_name
from tillhouse.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SLICE = 1 << 16  # hashes whose bits are held at a time


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text, as a signed 64-bit number; 0 without words."""
    words = raw.lower().split()  # A-Z, and the six ASCII spaces
    if not words:
        return 0
    count = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, SLICE):
        own = words[at : at + SLICE + shingle - 1]
        rows = zip(*(own[k:] for k in range(shingle))) if len(own) >= shingle else [own]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, rows), repeat(SEED)), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64) if len(bits) < 256 else _column_sums(bits)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def _column_sums(bits: np.ndarray) -> np.ndarray:
    """Sums of columns of 0 and 1, eight columns to a machine word and 255 rows at a time."""
    lanes = bits.view(np.uint64)
    full = len(lanes) // 255 * 255
    blocks = lanes[:full].reshape(-1, 255, 8).sum(axis=1)
    rest = lanes[full:].sum(axis=0, keepdims=True)
    return np.concatenate([blocks, rest]).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def add_fingerprints(docs: DataFrame, text: str, keep: list[str], name: str, shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of each row and its fingerprint ``name``; whole texts, null as empty."""
    kept = [F.struct(*(docs[column] for column in keep)).alias("row")]
    chosen = docs.select(*kept, docs[text].cast("string").alias("text"))
    out = chosen.select("row", F.lit(0).cast("long").alias("fp"))
    schema = to_arrow_schema(out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value.as_py() or b"", shingle) for value in batch["text"].cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(found, pa.int64())], schema=schema)

    return chosen.mapInArrow(run, out.schema).select("row.*", F.col("fp").alias(name))


def links(fingerprints: DataFrame, name: str, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (``a``, ``b``) of distinct fingerprints within ``max_bits`` (an even number) that connect all such pairs.

    Those that share a variant are in one another's reach already, so each is linked to the next one in order.
    """
    if max_bits < 0 or max_bits % 2:
        raise ValueError("the distance must be even: its half is the radius of the balls")
    masks = [sum(1 << k for k in places) for n in range(max_bits // 2 + 1) for places in combinations(range(64), n)]
    flips = F.array(*(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long") for mask in masks))
    variants = fingerprints.select(
        F.col(name).alias("b"),
        F.explode(F.transform(flips, lambda flip: F.col(name).bitwiseXOR(flip))).alias("variant"),
    )
    met = variants.withColumn("a", F.lag("b").over(Window.partitionBy("variant").orderBy("b")))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return met.where(F.col("a").isNotNull() & near).select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Per row: the key, ``fingerprint`` (long), ``root`` and ``component_id``.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; ``root`` is the smallest fingerprint that can be
    reached by links, ``component_id`` the smallest key of the rows there (null if none has a key).  Rows with equal
    fingerprints, such as copies and all texts without words, are linked through their fingerprint, never pairwise.  An empty
    table gives no rows.  Columns besides key and text are ignored.
    """
    name = free_name("fingerprint", [key])
    marked = stored(add_fingerprints(docs, text, [key], name, shingle), "fingerprints")
    distinct = stored(marked.groupBy(name).agg(F.min(key).alias("least")), "distinct-fingerprints")
    roots = connected_components(links(distinct, name, max_bits))
    rooted = distinct.join(roots, F.col(name) == F.col("node"), "left").select(
        F.col(name).alias("fp"), F.coalesce("root", F.col(name)).alias("root"), "least"
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(rooted.select("fp", "root").join(least, "root"), "classes")
    return marked.join(classes, F.col(name) == F.col("fp")).select(key, name, "root", "component_id")


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each group of linked rows, unchanged: that with the smallest key (null last), of repeated ones any.

    Rows are grouped by fingerprint and key, so a group of copies is spread over tasks, and repeated rows are dropped before
    the shuffle.
    """
    rows = docs.select(F.struct(*(docs[name] for name in docs.columns)).alias("all"), docs[key].alias("key"), docs[text].alias("text"))
    marked = stored(add_fingerprints(rows, "text", ["all", "key"], "fp", shingle), "marked")
    distinct = stored(marked.groupBy("fp").agg(F.min("key").alias("least")), "distinct-fingerprints")
    roots = connected_components(links(distinct, "fp", max_bits))
    first = F.min(F.struct(F.col("least").isNull(), F.col("least"), F.col("fp")))
    chosen = (
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(first.alias("first"))
        .select(F.struct(F.col("first.fp").alias("fp"), F.col("first.least").alias("key")).alias("id"))
    )
    named = marked.select("all", F.struct("fp", "key").alias("id"))
    one = Window.partitionBy("id").orderBy(F.xxhash64("all"))
    single = named.withColumn("n", F.row_number().over(one)).where("n = 1")
    return single.join(chosen, "id", "left_semi").select("all.*")
