"""Phrase collocation mining: word n-grams that occur together far more often than their parts would by chance.

Texts are cut into pieces at punctuation and pieces into words.  Each block of texts of one language is a shard: its words
as numbers, with a vocabulary of its own.  A phrase that occurs often enough consists of pairs of neighbours that do; so the
shards first sum up their pairs, and each gets back those of its own that are frequent in all together.  The count of a pair
in all is known then, so one of its shards hands it on with that.  What is left of a shard, runs of three words or more whose
neighbours are frequent pairs, goes into an FM-index, and extending intervals of its two Burrows-Wheeler transforms, to the
right and to the left in turn, enumerates the n-grams up to the given depth with their counts.  Of these a shard hands on
windows only: what begins at a word, up to the depth or the end of its run, three words at least.  Every phrase of three words
or more begins windows and nothing else does, so in the order of all windows each is one stretch, whose counts are summed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.materialize import stored
from tillhouse.llm.blocks import mix, rows_in_blocks, word_hashes

LEAST = 100  # occurrences of a candidate
DEPTH = 5  # words of the longest candidate
TOP = 2000  # phrases of a language
BLOCK_BYTES = 16 << 20  # text of a shard
UNKNOWN = "und"

# After lower-casing no byte is an upper-case letter, so "A" can stand for the end of a piece.
_END = b"A"
_PLAIN = bytearray(range(256))
for _upper in range(65, 91):
    _PLAIN[_upper] = _upper + 32
_PLAIN[9] = 32
for _mark in b".,;:!?\n\x0b\x0c\r":
    _PLAIN[_mark] = _END[0]
_PLAIN = bytes(_PLAIN)


def number_words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as numbers from 1, with 0 before, between and after pieces, and the words by number."""
    data = (_END + b"\n".join(texts).translate(_PLAIN) + _END).replace(_END, b" " + _END + b" ")
    parts = pc.split_pattern(pa.array([data], pa.large_binary()).cast(pa.large_string()), " ").flatten()
    coded = parts.filter(pc.greater(pc.binary_length(parts), 0)).dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)  # the first part is an end, so ends are 0
    again = np.zeros(len(numbers), dtype=bool)
    again[1:] = (numbers[1:] == 0) & (numbers[:-1] == 0)
    return numbers[~again], coded.dictionary.cast(pa.large_binary()).to_pylist()


class WordIndex:
    """An FM-index of a text of numbers, in which 0 ends a piece, and of the reversed text.

    Suffixes are in the order of their first six numbers only, which is enough for intervals of n-grams up to that depth.
    ``bwt`` holds the number before each suffix.  ``places`` are its entries in order, each with its row, so that the row
    at which the extension of an interval by a number begins is found by one binary search.
    """

    def __init__(self, text: np.ndarray):
        self.count = len(text)
        self.limit = int(text.max(initial=0)) + 1
        self.sizes = np.bincount(text, minlength=self.limit)
        self.forward = self._transform(text)
        self.backward = self._transform(text[::-1])

    def _transform(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def ahead(ranks: np.ndarray, by: int) -> np.ndarray:
            return np.concatenate([ranks[by:], np.zeros(min(by, len(ranks)), dtype=ranks.dtype)])

        def rank(first: np.ndarray, second: np.ndarray) -> np.ndarray:
            pairs = first * np.int64(second.max(initial=0) + 1) + second
            return np.unique(pairs, return_inverse=True)[1].astype(np.int64)

        text = text.astype(np.int64)
        threes = rank(rank(text, ahead(text, 1)), ahead(text, 2))
        later = ahead(threes + 1, 3)  # nothing after the end is less than anything
        order = np.argsort(threes * np.int64(self.count + 1) + later)
        bwt = text[order - 1]
        return bwt, np.sort(bwt * np.int64(self.count) + np.arange(self.count))

    def extended(self, grams: Grams, left: bool) -> Grams:
        """All n-grams with one more word on that side, with their intervals in both transforms."""
        bwt, places = self.forward if left else self.backward
        near, far = (grams.forward, grams.backward) if left else (grams.backward, grams.forward)
        before = np.cumsum(grams.sizes) - grams.sizes
        rows = np.repeat(near - before, grams.sizes) + np.arange(int(grams.sizes.sum()))
        owner = np.repeat(np.arange(len(near)), grams.sizes)
        found, sizes = np.unique(owner * np.int64(self.limit) + bwt[rows], return_counts=True)
        owner, word = np.divmod(found, self.limit)
        # the other interval is divided in the order of the new words, the ends of pieces first
        begins = np.cumsum(sizes) - sizes
        inside = begins - begins[np.searchsorted(owner, owner)]
        keep = word > 0
        owner, word, sizes, inside = owner[keep], word[keep], sizes[keep], inside[keep]
        new_near = np.searchsorted(places, word * np.int64(self.count) + near[owner])
        new_far = far[owner] + inside
        words, added = grams.words[owner], word[:, None]
        return Grams(
            np.concatenate([added, words] if left else [words, added], axis=1),
            new_near if left else new_far,
            new_far if left else new_near,
            sizes,
        )

    def ended(self, grams: Grams) -> np.ndarray:
        """How many of the occurrences of each n-gram are at the end of a piece."""
        ends = np.concatenate([[0], np.cumsum(self.backward[0] == 0)])
        return ends[grams.backward + grams.sizes] - ends[grams.backward]

    def n_grams(self, depth: int) -> Iterator[Grams]:
        """Those of 2, 3 and more words, each length in one step from the length before."""
        words = np.flatnonzero(self.sizes[1:]) + 1
        begins = np.cumsum(self.sizes) - self.sizes
        grams = Grams(words[:, None], begins[words], begins[words], self.sizes[words])
        for length in range(2, depth + 1):
            grams = self.extended(grams, left=length % 2 == 1)
            yield grams


class Grams:
    """N-grams, a row of words each, with where their intervals in both transforms begin and how long they are."""

    def __init__(self, words: np.ndarray, forward: np.ndarray, backward: np.ndarray, sizes: np.ndarray):
        self.words, self.forward, self.backward, self.sizes = words, forward, backward, sizes


def frequent_runs(numbers: np.ndarray, pairs: np.ndarray, shortest: int = 2) -> np.ndarray:
    """The text cut between neighbours that are none of ``pairs`` (in order, 2**32 times the first plus the second).

    What has fewer than ``shortest`` words then is left out.
    """
    neighbours = (numbers[:-1].astype(np.int64) << 32) | numbers[1:]
    at = np.searchsorted(pairs, neighbours)
    joined = np.zeros(len(numbers) + 1, dtype=bool)  # whether a word belongs to the one before
    joined[1:-1] = pairs[np.minimum(at, len(pairs) - 1)] == neighbours if len(pairs) else False
    kept = np.flatnonzero(joined[:-1] | joined[1:])
    last = ~joined[kept + 1]
    lengths = np.diff(np.flatnonzero(last), prepend=-1)
    enough = np.repeat(lengths >= shortest, lengths)
    kept, last = kept[enough], last[enough]
    out = np.zeros(len(kept) + int(last.sum()) + 1, dtype=np.int64)
    out[1 + np.arange(len(kept)) + np.cumsum(last) - last] = numbers[kept]
    return out


def _packed(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


def _shards(docs: DataFrame, text: str, lang: str, block_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for rows in rows_in_blocks(batches, "text", block_bytes):
            for own in pc.unique(rows["lang"]).to_pylist():
                texts = rows.filter(pc.equal(rows["lang"], own))["text"].cast(pa.large_binary())
                numbers, words = number_words([x for x in texts.to_pylist() if x])
                counts = np.bincount(numbers, minlength=len(words))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": [own],
                        "shard": [number],
                        "n": [int(counts[1:].sum())],
                        "vocabulary": [b" ".join(words[1:])],
                        "counts": [_packed(counts[1:])],
                        "numbers": [_packed(numbers)],
                    }
                )
                number += 1

    chosen = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text].cast("string").alias("text")
    )
    return chosen.mapInArrow(run, "lang string, shard long, n long, vocabulary binary, counts binary, numbers binary")


def _shard_words(shards: DataFrame) -> DataFrame:
    """(lang, word, n): each word of each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], dtype="<i4").astype(np.int64)
                words = row["vocabulary"].split(b" ") if len(counts) else []
                yield from pa.table(
                    {
                        "lang": pa.array([row["lang"]] * len(words), pa.string()),
                        "word": pa.array(words, pa.binary()).cast(pa.string()),
                        "n": pa.array(counts),
                    }
                ).to_batches(max_chunksize=50_000)

    return shards.select("lang", "vocabulary", "counts").mapInArrow(run, "lang string, word string, n long")


def neighbours(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of neighbours in a piece, in order, as 2**32 times the first plus the second, and their counts."""
    first, second = numbers[:-1], numbers[1:]
    both = (first > 0) & (second > 0)
    return np.unique((first[both] << 32) | second[both], return_counts=True)


def _shard_pairs(shards: DataFrame) -> DataFrame:
    """(shard, at, hash, check, n): each of the ``neighbours`` of each shard.

    Equal pairs of a language have equal hashes.  ``check`` has 32 bits more, from other hashes of the words, so that pairs
    can be told apart by both, and words too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, counts = neighbours(np.frombuffer(row["numbers"], dtype="<i4").astype(np.int64))
                vocabulary = np.frombuffer(row["vocabulary"], dtype=np.uint8)
                hashes = word_hashes(vocabulary, np.array([0, len(vocabulary)]))[0]
                language = np.frombuffer(row["lang"].encode() + b"\0", dtype=np.uint8)
                seed = mix(word_hashes(language, np.array([0, len(language)]))[0][:1])
                start = zlib.crc32(row["lang"].encode())
                checks = np.array([zlib.crc32(word, start) for word in row["vocabulary"].split(b" ")], dtype=np.uint64)
                left, right = (pairs >> 32) - 1, (pairs & 0xFFFFFFFF) - 1
                first, second = hashes[left], hashes[right]
                check = mix((checks[left] << np.uint64(32)) | checks[right]).astype(np.uint32)
                yield from pa.table(
                    {
                        "shard": pa.array(np.full(len(pairs), row["shard"])),
                        "at": pa.array(np.arange(len(pairs), dtype=np.int32)),
                        "hash": pa.array(mix(mix(first + seed) + second).view(np.int64)),
                        "check": pa.array(check.view(np.int32)),
                        "n": pa.array(counts.astype(np.int32)),
                    }
                ).to_batches(max_chunksize=50_000)

    chosen = shards.select("lang", "shard", "vocabulary", "numbers")
    return chosen.mapInArrow(run, "shard long, at int, hash long, check int, n int")


def windows_of(index: WordIndex, depth: int, shortest: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different windows of each length from ``shortest``, a row of words each, and how many words begin them."""
    for grams in index.n_grams(depth):
        if grams.words.shape[1] < shortest:
            continue
        counts = grams.sizes if grams.words.shape[1] == depth else index.ended(grams)
        yield grams.words[counts > 0], counts[counts > 0]


def _shard_windows(shards: DataFrame, frequent: DataFrame, depth: int) -> DataFrame:
    """(lang, window, size, n): windows with a space after each word.

    Those of two words are the pairs that the shard was chosen to name, with their counts in all.  The others are the windows
    of each shard in its runs of frequent pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                numbers = np.frombuffer(row["numbers"], dtype="<i4").astype(np.int64)
                words = pa.array([b"", *row["vocabulary"].split(b" ")], pa.binary()).cast(pa.string())
                pairs = neighbours(numbers)[0]
                runs = frequent_runs(numbers, pairs[np.sort(np.array(row["own"], dtype=np.int64))], 3)
                named = pairs[np.array([x["at"] for x in row["named"]], dtype=np.int64)]
                totals = np.array([x["f"] for x in row["named"]], dtype=np.int64)
                all_pairs = np.stack([named >> 32, named & 0xFFFFFFFF], axis=1), totals
                for found, counts in (all_pairs, *windows_of(WordIndex(runs), depth, 3)):
                    yield from pa.table(
                        {
                            "lang": pa.array([row["lang"]] * len(found), pa.string()),
                            "window": pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in found.T), "", " "),
                            "size": pa.array(np.full(len(found), found.shape[1], dtype=np.int32)),
                            "n": pa.array(counts.astype(np.int64)),
                        }
                    ).to_batches(max_chunksize=50_000)

    chosen = shards.select("lang", "shard", "vocabulary", "numbers").join(frequent, "shard")
    return chosen.mapInArrow(run, "lang string, window string, size int, n long")


def _window_phrases(windows: DataFrame, least: int, depth: int, shortest: int = 2) -> DataFrame:
    """(lang, phrase, size, n): the phrases of ``shortest`` words or more that begin windows, with parts of their counts.

    As words end with a space, the windows that a phrase begins are those that begin with its bytes, which are neighbours in
    order.  So a batch of ordered windows has all windows of its phrases but for the first and the last phrase of a size:
    these are always handed on, the others only if they occur often enough.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = pc.split_pattern(batch["window"], " ")
            coded = parts.flatten().dictionary_encode()
            numbers, lengths = coded.indices.to_numpy(), pc.list_value_length(parts).to_numpy()
            begins, sizes = np.cumsum(lengths) - lengths, lengths - 1  # nothing follows the last space
            langs, n = batch["lang"].dictionary_encode().indices.to_numpy(), batch["n"].to_numpy()
            table = np.full((len(n), depth), -1, dtype=np.int64)
            for k in range(depth):
                longer = np.flatnonzero(sizes > k)
                table[longer, k] = numbers[begins[longer] + k]
            new = np.ones(len(n), dtype=bool)
            new[1:] = (langs[1:] != langs[:-1]) | (table[1:, 0] != table[:-1, 0])
            for size in range(2, depth + 1):
                new[1:] |= table[1:, size - 1] != table[:-1, size - 1]
                if size < shortest:
                    continue
                first = np.flatnonzero(new)
                counts = np.add.reduceat(n, first)
                chosen = counts >= least
                chosen[[0, -1]] = True
                chosen &= sizes[first] >= size
                first, counts = first[chosen], counts[chosen]
                words = (coded.dictionary.take(pa.array(table[first, k])) for k in range(size))
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": batch["lang"].take(pa.array(first)),
                        "phrase": pc.binary_join_element_wise(*words, " "),
                        "size": pa.array(np.full(len(first), size, dtype=np.int32)),
                        "n": pa.array(counts),
                    }
                )

    ordered = windows.repartitionByRange("lang", "window").sortWithinPartitions("lang", "window")
    return ordered.mapInArrow(run, "lang string, phrase string, size int, n long")


def count_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``depth`` words that occur ``least`` times in their language, and each language's words in all.

    The first has (lang, phrase, size, f), the second (lang, n).  Pairs are known by 96 bits of hashes; for four million
    frequent pairs among two billion different ones the chance that any shares them is about one in ten million million.
    Longer phrases and words are known by themselves.  A pair has one row per shard at most, so frequent ones are no hot keys.
    """
    shards = stored(_shards(docs, text, lang, block_bytes), "phrase-shards")
    totals = stored(shards.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    words = _shard_words(shards).groupBy("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"))
    pair = Window.partitionBy("hash", "check")
    in_all = {"f": F.sum("n").over(pair), "names": F.min("shard").over(pair)}
    pairs = _shard_pairs(shards).withColumns(in_all).where(F.col("f") >= least)
    named = F.when(F.col("names") == F.col("shard"), F.struct("at", "f"))  # by one of its shards
    frequent = pairs.groupBy("shard").agg(F.collect_list("at").alias("own"), F.collect_list(named).alias("named"))
    windows = stored(_shard_windows(shards, frequent, depth), "phrase-windows")  # dealing by range reads them twice
    named_pairs = windows.where("size = 2").select("lang", F.rtrim("window").alias("phrase"), "size", F.col("n").alias("f"))
    found = _window_phrases(windows.where("size > 2"), least, depth, 3).groupBy("lang", "phrase", "size")
    longer = found.agg(F.sum("n").alias("f"))
    counted = words.agg(F.sum("n").alias("f")).unionByName(named_pairs).unionByName(longer)
    return stored(counted.where((F.col("f") >= least) & (F.col("size") <= depth)), "phrases"), totals


def _part(words: Column, begin: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates with (lang, phrase, a, l, r, n, score): of all cuts that with the least score, the first of equal ones.

    A candidate goes if a longer one holds it that occurs as often.  Each occurrence of the longer one is one of all that
    lie between the two, so it is enough to look at candidates with one word more on the left or right.
    """
    counts = phrases.select("lang", "phrase", "f")
    candidates = phrases.where(F.col("size") > 1).select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("words")
    )
    size, words = F.col("size"), F.col("words")
    inner = F.explode(F.array(_part(words, F.lit(1), size - 1), _part(words, F.lit(2), size - 1)))
    extended = candidates.where(size > 2).select("lang", inner.alias("phrase"), F.col("a").alias("longer"))
    extended = extended.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    open_ended = candidates.join(extended, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")

    cuts = open_ended.select("lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        _part(words, F.lit(1), F.col("k")).alias("first"),
        _part(words, F.col("k") + 1, size - F.col("k")).alias("rest"),
    )
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    valued = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    exact = "CAST(1000 * CAST(a AS DECIMAL(19)) * CAST(n AS DECIMAL(19)) AS DECIMAL(38)) div (CAST(l AS DECIMAL(19)) * CAST(r AS DECIMAL(19)))"
    scored = valued.withColumn("score", F.expr(exact))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mine_collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, **options) -> DataFrame:
    """Each language's first ``top`` collocations with their ``rank``: by score, then count, then phrase in byte order.

    Null texts are empty, rows without a language are of the language ``und``, repeated rows count each time, other columns
    are ignored.  A text without words adds nothing, and a table without phrases often enough gives no rows.
    """
    found = collocations(*count_phrases(docs, text, lang, **options))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
