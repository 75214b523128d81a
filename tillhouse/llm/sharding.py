"""Sharding: contiguous shards of ordered atomic groups whose largest size is the smallest possible.

Groups are equal texts, in the order of their SHA-256, each as large as its rows together.  The order is cut into shards.
For a capacity the greedy rule, each shard taking groups while they fit, needs the fewest shards; the smallest capacity
that needs no more than asked for is found by binary search, and the cuts are those of the greedy rule.

Neither groups nor their number are bounded, so the search never sees them all.  It starts with sums over digest prefixes
and looks closer only where a cut can fall: a prefix is taken once as something that can be cut anywhere, which gives a
lower bound of the capacity, and once as something that can't be cut, which gives an upper bound; prefixes that a cut
reaches at any capacity in between are replaced by longer ones, until only single groups are left there.

Heavy groups are few; each is known by itself from the beginning, between the remainders of its prefix, so both bounds
take it as what can't be cut.  Where a cut may fall before or after a heavy group, all cuts behind it are uncertain by as
much.  If that makes too many prefixes unclear, those of one capacity between the bounds are looked at first, from the
first cut on, until it is clear whether that capacity will do.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.materialize import stored

FIRST_DIGITS = 3  # 4,096 prefixes to begin with
MORE_DIGITS = 2  # each prefix that is looked at closer becomes up to 256
HEAVY = 64  # a group is heavy from this part of a shard's share on: fewer than so many for each shard
MOST_SPANS = 1 << 17  # asked for at a time
LEAST_COST = 32  # spans that a prefix counts for at least, which bounds the prefixes asked for at a time
SLOT_BUCKETS = 1024  # tasks that number the rows of a shard


@dataclass(frozen=True)
class Span:
    """The groups whose digest starts with ``prefix`` and isn't below ``after``, up to the next span."""

    prefix: str
    size: int
    groups: int
    after: str = ""

    @property
    def begin(self) -> str:
        return max(self.prefix, self.after)

    @property
    def cost(self) -> int:
        """Spans that looking closer gives, at most."""
        return min(max(self.groups, LEAST_COST), 16**MORE_DIGITS)


class Spans:
    """Spans in order, and what the greedy rule makes of them."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans, key=lambda span: span.begin)
        self.ends = list(accumulate(span.size for span in self.spans))
        self.total = self.ends[-1] if self.ends else 0

    def cuts(self, capacity: int, shards: int, divisible: bool) -> list[int]:
        """Ends of the first ``shards`` shards; fewer if a span that can't be divided exceeds the capacity."""
        ends: list[int] = []
        at = 0
        while at < self.total and len(ends) < shards:
            reach = min(at + capacity, self.total)
            whole = bisect_right(self.ends, reach)
            end = self.ends[whole - 1] if whole else 0
            if divisible and end < reach and self.spans[whole].groups > 1:
                end = reach
            if end <= at:
                break
            ends.append(end)
            at = end
        return ends

    def fits(self, capacity: int, shards: int, divisible: bool) -> bool:
        ends = self.cuts(capacity, shards, divisible)
        return self.total == 0 or bool(ends) and ends[-1] == self.total

    def smallest(self, shards: int, divisible: bool) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.fits(middle, shards, divisible) else (middle + 1, high)
        return low

    def within_reach(self, low: int, high: int, shards: int) -> list[list[Span]]:
        """For each cut the spans of several groups where it can fall at some capacity from ``low`` to ``high``."""
        first, last = self.cuts(low, shards, False), self.cuts(high, shards, True)
        first += [first[-1] if first else 0] * (shards - len(first))
        last += [self.total] * (shards - len(last))
        found = []
        for begin, end in zip(first, last):
            k = bisect_right(self.ends, begin)
            stop = bisect_left(self.ends, end, k) + 1 if begin < end else k
            found.append([span for span in self.spans[k:stop] if span.groups > 1])
        return found

    def unclear(self, shards: int) -> set[str]:
        """Prefixes to look at closer; none once all cuts are known."""
        low, high = self.smallest(shards, True), self.smallest(shards, False)
        reached = {span.begin: span for spans in self.within_reach(low, high, shards) for span in spans}
        if sum(span.cost for span in reached.values()) <= MOST_SPANS:
            return {span.prefix for span in reached.values()}
        middle = (low + high) // 2
        chosen: set[str] = set()
        left = MOST_SPANS
        for span in (span for spans in self.within_reach(middle, middle, shards) for span in spans):
            if span.prefix not in chosen:
                left -= span.cost
                if left < 0:
                    break
                chosen.add(span.prefix)
        return chosen

    def boundaries(self, shards: int) -> list[str]:
        """The place from which on groups belong to each shard but the first."""
        ends = self.cuts(self.smallest(shards, False), shards, False)
        return [self.spans[bisect_left(self.ends, end) + 1].begin for end in ends if end < self.total]


def find_boundaries(
    shards: int, sums: Callable[[int, set[str] | None], list[Span]], heavy: Sequence[Span] = ()
) -> list[str]:
    """``sums(digits, prefixes)`` gives the spans of so many digits below the prefixes, or all of them, without ``heavy``.

    Spans of ``heavy`` hold one group each; those from ``sums`` end where one of them lies in between.
    """
    spans = Spans([*heavy, *sums(FIRST_DIGITS, None)])
    while unclear := spans.unclear(shards):
        found = [span for span in spans.spans if span.prefix not in unclear]
        for length in sorted(set(map(len, unclear))):
            found += sums(length + MORE_DIGITS, {prefix for prefix in unclear if len(prefix) == length})
        spans = Spans(found)
    return spans.boundaries(shards)


def digest(text: Column) -> Column:
    """A text's place in the order; null comes first, apart from the empty text."""
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(""))


def shard_of(place: Column, boundaries: list[str]) -> Column:
    shard = F.lit(0)
    for boundary in boundaries:
        shard = shard + (place >= boundary).cast("int")
    return shard.cast("int")


def balanced_boundaries(sized: DataFrame, shards: int) -> list[str]:
    """Where to cut rows with ``place`` and ``size`` into ``shards`` shards."""
    groups = stored(sized.groupBy("place").agg(F.sum("size").alias("size")), "shard-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // (shards * HEAVY)))
    found = groups.where(F.col("size") >= least).collect()  # at most shards x HEAVY rows
    heavy = sorted((Span(row["place"], row["size"], 1) for row in found), key=lambda span: span.prefix)
    others = groups.where(F.col("size") < least)

    def sums(digits: int, prefixes: set[str] | None) -> list[Span]:
        chosen = others.withColumn("prefix", F.substring("place", 1, digits))
        if prefixes is not None:
            length = max(map(len, prefixes))
            chosen = chosen.where(F.substring("place", 1, length).isin(sorted(prefixes)))
        within: dict[str, list[str]] = {}
        for span in heavy:
            if prefixes is None or span.prefix[:length] in prefixes:
                within.setdefault(span.prefix[:digits], []).append(span.prefix)
        after = F.lit("")
        if within:
            inside = groups.sparkSession.createDataFrame(list(within.items()), "prefix string, heavy array<string>")
            chosen = chosen.join(F.broadcast(inside), "prefix", "left")
            last = F.array_max(F.filter("heavy", lambda place: place < F.col("place")))
            after = F.coalesce(F.concat(last, F.lit("0")), F.lit(""))  # behind that place and before the next one
        spans = chosen.groupBy("prefix", after.alias("after")).agg(F.sum("size"), F.count("*")).collect()
        return [Span(prefix, size, count, after) for prefix, after, size, count in spans]  # about MOST_SPANS at most

    return find_boundaries(shards, sums, heavy)


def assign_shards(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", slot_buckets: int = SLOT_BUCKETS
) -> DataFrame:
    """Per row: the key, ``size`` (bytes of the text plus one), ``text_crc32``, ``place``, ``shard`` and ``slot``.

    Rows with equal texts share a shard, and so do rows without text.  Slots are gapless from 0 within a shard; equal rows
    have slots next to each other.  Rows are numbered in many tasks per shard, chosen by key and text, so neither a shard
    nor a group of copies meets in one.  Shards at the end stay empty if there are fewer groups than shards, or if one group
    alone is larger than the others' share.  An empty table gives no rows.  Columns besides key and text are ignored.
    """
    body = F.coalesce(docs[text], F.lit(""))
    sized = stored(
        docs.select(
            docs[key].alias("key"),
            (F.octet_length(body).cast("long") + 1).alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            digest(docs[text]).alias("place"),
        ),
        "shard-sizes",
    )
    boundaries = balanced_boundaries(sized, shards)
    placed = sized.withColumn("shard", shard_of(F.col("place"), boundaries)).withColumn(
        "bucket", F.pmod(F.xxhash64("key", "place"), F.lit(slot_buckets)).cast("int")
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (  # at most shards x slot_buckets rows
        placed.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    number = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("place", "key"))
    numbered = placed.withColumn("number", number)
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "place",
        "shard",
        (F.col("offset") + F.col("number") - 1).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, text: str = "text", files: int = 8) -> list[str]:
    """Write whole rows below ``path`` as ``shard=<number>``, a few files each; returns the boundaries."""
    name = "shard"
    sized = docs.select((F.octet_length(F.coalesce(docs[text], F.lit(""))).cast("long") + 1).alias("size"), digest(docs[text]).alias("place"))
    boundaries = balanced_boundaries(sized, shards)
    row = F.struct(*(docs[column] for column in docs.columns)).alias("row")
    spread = docs.select(row, shard_of(digest(docs[text]), boundaries).alias(name))
    spread.repartition(shards * files, name, F.pmod(F.xxhash64("row"), F.lit(files))).write.partitionBy(name).parquet(path)
    return boundaries
