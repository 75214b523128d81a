"""Sets of keys: those small enough to broadcast, filters of larger ones, and keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.functions.materialize import materialize

MAX_BROADCAST_KEYS = 500_000  # tens of megabytes of hash table
MAX_BROADCAST_BYTES = 32 << 20  # of the keys as text

FILTER_BYTES_PER_KEY = MAX_BROADCAST_BYTES // MAX_BROADCAST_KEYS  # of a filter, for each key that may be broadcast
SEGMENT_WORDS = 64  # numbers of 64 bits in a row of a filter
MIN_FILTER_BITS = 2  # a filter with fewer bits per key would let nearly all rows pass

HOT_KEY_LIMIT = 100_000  # at most this many keys can each hold more than 1/100,000 of all rows
MIN_HOT_ROWS = 1_000_000  # a group below this size is never worth splitting


@dataclass(frozen=True)
class KeySet:
    """A table of distinct keys, computed once, how many there are, and their size as text."""

    keys: DataFrame
    count: int
    size: int = 0

    @classmethod
    def of(cls, keys: DataFrame) -> KeySet:
        return cls.measured(materialize(keys))

    @classmethod
    def measured(cls, keys: DataFrame, **fields) -> KeySet:
        """The set of keys that are stored already."""
        size = F.sum(F.octet_length(F.concat_ws("", *[F.col(name).cast("string") for name in keys.columns])))
        return cls(keys, *keys.agg(F.count("*"), F.coalesce(size, F.lit(0))).first(), **fields)

    def fits(self, max_keys: int = MAX_BROADCAST_KEYS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
        """Whether the keys may be broadcast."""
        return self.count <= max_keys and self.size <= max_bytes

    def filter(self, bits_per_key: int, max_keys: int = MAX_BROADCAST_KEYS) -> KeyFilter | None:
        """A filter no larger than ``max_keys`` broadcast keys, or None where it would be of no use."""
        segment_bits = SEGMENT_WORDS * 64
        most = max_keys * FILTER_BYTES_PER_KEY * 8 // segment_bits
        segments = min(-(-self.count * bits_per_key // segment_bits), most)
        collated = any("collate" in dtype for _, dtype in self.keys.dtypes)  # there, different texts may be equal
        if collated or segments * segment_bits < max(self.count, 1) * MIN_FILTER_BITS:
            return None
        return KeyFilter.of(self.keys, segments)


@dataclass(frozen=True)
class KeyFilter:
    """Which keys may be in a set: three bits per key, in one of the words of one of the ``segments``.

    All keys of the set pass, and a few others do.  Equal keys must be of the same types on both sides.
    """

    table: DataFrame  # (_segment, _words)
    segments: int
    dtypes: tuple[str, ...]

    @classmethod
    def of(cls, keys: DataFrame, segments: int) -> KeyFilter:
        place, bits = _place(keys.columns, segments)
        own = keys.select(place.alias("word"), bits.alias("bits"))
        every = keys.sparkSession.range(segments * SEGMENT_WORDS).select("id", F.lit(0).cast("bigint"))
        words = own.union(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))["bits"]
        rows = words.groupBy(_segment(F.col("word")).alias("_segment")).agg(ordered.alias("_words"))
        return cls(materialize(rows), segments, tuple(dtype for _, dtype in keys.dtypes))

    def suits(self, df: DataFrame, columns: Sequence[str]) -> bool:
        dtypes = dict(df.dtypes)
        return tuple(dtypes[column] for column in columns) == self.dtypes

    def mark(self, df: DataFrame, columns: Sequence[str], flag: str) -> DataFrame:
        """Add ``flag``: whether the row's key, nulls included, may be in the set.  No row is shuffled."""
        place, bits = _place(columns, self.segments)
        placed = df.select("*", place.alias("_place"), bits.alias("_bits"))
        found = placed.join(F.broadcast(self.table), _segment(F.col("_place")) == F.col("_segment"))
        word = F.get("_words", F.pmod("_place", F.lit(SEGMENT_WORDS)).cast("int"))
        return found.select(*df.columns, (word.bitwiseAND(F.col("_bits")) == F.col("_bits")).alias(flag))


def _segment(place: Column) -> Column:
    return F.floor(place / SEGMENT_WORDS)


def _place(columns: Sequence[str], segments: int) -> tuple[Column, Column]:
    """The number of the word that a key's bits are in, and these bits."""
    key_hash = F.xxhash64(*columns)

    def bit(by: int) -> Column:
        at = F.shiftrightunsigned(key_hash, by).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), at)

    place = F.pmod(F.shiftrightunsigned(key_hash, 18), F.lit(segments * SEGMENT_WORDS))
    return place, bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12))


def hot_keys(sizes: DataFrame, key: str, rows: str, min_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Keys to be handled apart, given one row per key with its row count: the null key and the oversized ones.

    A key is oversized when it holds more than ``1/HOT_KEY_LIMIT`` of all rows, so the result has at most
    ``HOT_KEY_LIMIT`` rows (and the null key) for any input and may be broadcast.
    """
    total = sizes.agg(F.sum(rows)).scalar()
    oversized = (F.col(rows) > F.lit(min_rows)) & (F.col(rows) * F.lit(HOT_KEY_LIMIT) > total)
    return sizes.where(F.col(key).isNull() | oversized)
