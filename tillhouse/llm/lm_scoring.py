"""Language-model scoring: a weighted backoff automaton, cut to what each block of documents needs.

States are histories seen in training.  From a state, a seen n-gram is an arc whose weight is its smoothed probability

    p(w | h) = (count(h w) + mu * p(w | shorter h)) / (count(h) + mu),      p(w) = (count(w) + 1/2) / (N + (V + 1) / 2)

and any other word takes the failure arc to the shorter history, at the weight mu / (count(h) + mu).  Both follow from the
counts of n-grams alone, and the weights of all words sum to one in every state.

The whole automaton grows with the corpus, so no task holds it.  Documents are cut into blocks.  Each block asks for the
counts of its distinct n-grams, and says how often its own training documents have them; requests meet by n-gram, where
counts from all blocks are added up; each block gets the totals back in the order in which it asked, builds its part of
the automaton and traverses its documents once, left to right.  N-grams are known by 64-bit hashes.

Requests go to parts of the range of hashes.  A request for each block and part would be a number of rows that grows with
the square of the corpus, so with more than ``FAN`` parts they go in levels (``Levels``): a block asks at most ``FAN``
ranges, about as many blocks' requests for one range are merged into one, which asks the ``FAN`` ranges inside, and so on.
At every level a block has at most ``FAN`` rows and a task holds about as much as one block asks for.  Answers come back
the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillhouse.functions.materialize import stored
from tillhouse.llm.blocks import mix, raw_texts, rows_in_blocks, word_hashes

ORDER = 3
MU = 4.0
BLOCK_BYTES = 5 << 20  # text of a block: its n-grams are held by one task
PART_BYTES = 7 << 20  # text for each of the parts in which counts are added up
FAN = 8192  # ranges that one request is divided into, at most: two levels from 57 GB of text, and up to 470 TB
TASKS = 16_384  # of an exchange, at most; a task may hold several parts, one after the other
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
STATISTICS = -1  # who asked, in rows with totals of a part


def pack(values: np.ndarray) -> bytes:
    """Integers, compressed by byte position, as high bytes are mostly equal."""
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes(), 1)


def unpack(blob: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    flat = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(flat.reshape(width, -1).T).view(dtype).ravel()


@dataclass
class Grams:
    """The n-grams that end at each token of a block, for n from 1; ``valid`` where the text is long enough."""

    keys: list[np.ndarray]
    valid: list[np.ndarray]
    sizes: np.ndarray  # tokens of each document, the end included
    begins: np.ndarray  # where each document begins

    @classmethod
    def of(cls, rows: pa.Table, order: int) -> Grams:
        words, counts = word_hashes(*raw_texts(rows, "text"))
        sizes = counts + 1
        begins = np.cumsum(sizes) - sizes
        tokens = np.full(int(sizes.sum()), END)
        tokens[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)] = words
        place = np.arange(len(tokens)) - np.repeat(begins, sizes)
        keys, valid = [tokens | np.uint64(1)], [np.ones(len(tokens), dtype=bool)]
        for n in range(2, order + 1):  # the text's begin is a token that only histories have
            before = np.roll(keys[-1], 1)
            before[begins] = BEGIN if n == 2 else 0
            keys.append(mix(before * np.uint64(0x2545F4914F6CDD1D) + tokens + np.uint64(n)) & ~np.uint64(1))
            valid.append(place >= n - 2)
        return cls(keys, valid, sizes, begins)

    def distinct(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """All keys in order, and for each n the number of each token's key among them (0 where there is none)."""
        every, inverse = np.unique(np.concatenate([k[v] for k, v in zip(self.keys, self.valid)]), return_inverse=True)
        numbers, at = [], 0
        for valid in self.valid:
            number = np.zeros(len(valid), dtype=np.int64)
            own = int(valid.sum())
            number[valid] = inverse[at : at + own]
            numbers.append(number)
            at += own
        return every, numbers


@dataclass(frozen=True)
class Levels:
    """How requests find their parts: ``depth`` times, each range of hashes is divided into ``fan`` equal ones."""

    fan: int
    depth: int

    @classmethod
    def of(cls, parts: int, most: int) -> Levels:
        """The fewest levels with at least that many parts."""
        depth = 1
        while most**depth < parts:
            depth += 1
        fan = 1
        while fan**depth < parts:
            fan += 1
        return cls(fan, depth)

    def parts(self, level: int) -> int:
        return self.fan**level

    def groups(self, level: int) -> int:
        """Into how many groups those who ask at a level fall: with fewer ranges to ask, more of them are merged."""
        return self.fan ** (self.depth - level)

    def limits(self, level: int, part: int) -> np.ndarray:
        """The smallest key of each range at a level inside a range of the level before, but of the first."""
        parts = self.parts(level)
        return np.array([(k << 64) // parts for k in range(part * self.fan + 1, (part + 1) * self.fan)], dtype=np.uint64)

    def divide(self, level: int, part: int, keys: np.ndarray) -> tuple[list[int], list[slice]]:
        """The ranges inside ``part`` that hold any of some keys in order, and where those are."""
        cuts = [0, *np.searchsorted(keys, self.limits(level, part)).tolist(), len(keys)]
        some = [k for k in range(self.fan) if cuts[k] < cuts[k + 1]]
        return [part * self.fan + k for k in some], [slice(cuts[k], cuts[k + 1]) for k in some]


def _numbered_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table, str]]:
    """Blocks of a partition, each with a number of its own and a checksum of what the model makes use of."""
    task = TaskContext.get().partitionId()
    for k, rows in enumerate(rows_in_blocks(batches, "text", BLOCK_BYTES)):
        data, ends = raw_texts(rows, "text")
        check = xxhash.xxh3_128(data)
        check.update(ends)
        check.update(rows["train"].to_numpy().astype(np.uint8))
        yield task << 24 | k, rows, check.hexdigest()


REQUESTS = "part int, asker long, check string, keys binary, counts binary"
ANSWERS = "asker long, part int, check string, totals binary, tokens long, words long"


def _request_rows(
    levels: Levels, level: int, part: int, asker: int, check: str | None, keys: np.ndarray, counts: np.ndarray
) -> dict[str, pa.Array]:
    wanted, spans = levels.divide(level, part, keys)
    return {
        "part": pa.array(wanted, pa.int32()),
        "asker": pa.array([asker] * len(wanted), pa.int64()),
        "check": pa.array([check] * len(wanted), pa.string()),
        "keys": pa.array([pack(np.diff(keys[s], prepend=np.uint64(0))) for s in spans], pa.binary()),
        "counts": pa.array([pack(counts[s]) for s in spans], pa.binary()),
    }


def _ask(order: int, levels: Levels):
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows, check in _numbered_blocks(batches):
            grams = Grams.of(rows, order)
            keys, numbers = grams.distinct()
            train = np.repeat(rows["train"].to_numpy().astype(bool), grams.sizes)
            counts = np.zeros(len(keys), dtype=np.int64)
            for number, valid in zip(numbers, grams.valid):
                counts += np.bincount(number[valid & train], minlength=len(keys))
            yield pa.RecordBatch.from_pydict(_request_rows(levels, 1, 0, block, check, keys, counts))

    return requests


def _joined(requests: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys of some requests, their counts added up, and the places of each request's keys among them."""
    keys = [np.cumsum(unpack(blob, np.uint64), dtype=np.uint64) for blob in requests["keys"].to_pylist()]
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.zeros(len(every), dtype=np.int64)
    np.add.at(totals, inverse, np.concatenate([unpack(blob, np.int64) for blob in requests["counts"].to_pylist()]))
    return every, totals, np.split(inverse, np.cumsum([len(own) for own in keys])[:-1])


def _merge(levels: Levels, level: int):
    """One group's requests for one range at a level, as one request for each range inside."""

    def merged(group: tuple, requests: pa.Table) -> pa.Table:
        part, asker = (value.as_py() for value in group)
        every, totals, _ = _joined(requests)
        return pa.table(_request_rows(levels, level + 1, part, asker, None, every, totals))

    return merged


def _answer(requests: pa.Table) -> pa.Table:
    """Totals of one part's n-grams for each who asked, and the part's words and tokens."""
    every, totals, places = _joined(requests)
    words = totals[(every & np.uint64(1)).astype(bool)]
    n = len(places)
    return pa.table(
        {
            "asker": pa.array([*requests["asker"].to_pylist(), STATISTICS], pa.int64()),
            "part": pa.array([requests["part"][0].as_py()] * (n + 1), pa.int32()),
            "check": pa.array([*requests["check"].to_pylist(), None], pa.string()),
            "totals": pa.array([*(pack(totals[own]) for own in places), None], pa.binary()),
            "tokens": pa.array([0] * n + [int(words.sum())], pa.int64()),
            "words": pa.array([0] * n + [int((words > 0).sum())], pa.int64()),
        }
    )


def _hand_back(requests: pa.Table, answers: pa.Table) -> pa.Table:
    """The answers to a merged request, for each request in it."""
    _, _, places = _joined(requests)
    inside = sorted(zip(answers["part"].to_pylist(), answers["totals"].to_pylist()))
    totals = np.concatenate([unpack(blob, np.int64) for _, blob in inside])
    return pa.table(
        {
            "asker": requests["asker"].cast(pa.int64()),
            "part": requests["part"].cast(pa.int32()),
            "check": requests["check"].cast(pa.string()),
            "totals": pa.array([pack(totals[own]) for own in places], pa.binary()),
            "tokens": pa.array([0] * len(places), pa.int64()),
            "words": pa.array([0] * len(places), pa.int64()),
        }
    )


def _group_of(levels: Levels, level: int) -> Column:
    """The group of one who asks: of a block by its hash, of a group by its number."""
    if level == 1:
        return F.pmod(F.xxhash64("asker"), F.lit(levels.groups(1)))
    return F.floor(F.col("asker") / levels.fan).cast("long")


def totals_of(requests: DataFrame, levels: Levels) -> tuple[DataFrame, int, int]:
    """The answers to all requests of blocks, stored, and the numbers of tokens and of words in training."""
    asked = []
    for level in range(1, levels.depth):
        requests = stored(requests.withColumn("group", _group_of(levels, level)), f"lm-requests-{level}")
        asked.append(requests)
        tasks = min(TASKS, levels.parts(level) * levels.groups(level))
        requests = requests.repartition(tasks, "part", "group").groupBy("part", "group").applyInArrow(_merge(levels, level), REQUESTS)
    tasks = min(TASKS, levels.parts(levels.depth))
    answers = stored(requests.repartition(tasks, "part").groupBy("part").applyInArrow(_answer, ANSWERS), "lm-totals")
    tokens, words = answers.where(F.col("asker") == STATISTICS).agg(F.sum("tokens"), F.sum("words")).first()
    answers = answers.where(F.col("asker") != STATISTICS)
    for requests in reversed(asked):
        outer = F.floor(F.col("part") / levels.fan).cast("int").alias("outer")
        answers = stored(
            requests.groupBy("part", "group")
            .cogroup(answers.select("part", "totals", outer, "asker").groupBy("outer", "asker"))
            .applyInArrow(_hand_back, ANSWERS),
            "lm-totals",
        )
    return answers, tokens or 0, words or 0


def _wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block as one compressed row, to travel to its answers."""
    for block, rows, check in _numbered_blocks(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(rows)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block], pa.int64()),
                "check": pa.array([check], pa.string()),
                "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            }
        )


class Automaton:
    """The states and arcs that one block's documents can reach."""

    def __init__(self, grams: Grams, totals: np.ndarray, numbers: list[np.ndarray], tokens: int, words: int, mu: float):
        self.grams, self.mu = grams, mu
        self.counts = [np.where(v, totals[k], 0) for k, v in zip(numbers, grams.valid)]
        self.unigram = (self.counts[0] + 0.5) / (tokens + 0.5 * (words + 1))
        self.documents = int(self.counts[0][grams.sizes[0] - 1])  # ends in training: how often a begin was a history

    def histories(self, n: int) -> np.ndarray:
        """How often training went on from the state of n - 1 tokens that the traversal is in before each token."""
        before = np.roll(self.counts[n - 2], 1)
        before[self.grams.begins] = self.documents if n == 2 else 0
        return before

    def traverse(self) -> np.ndarray:
        """The log10 probability of each token, in the state that the tokens before it lead to."""
        arcs = [self.unigram]
        for n in range(2, len(self.counts) + 1):
            arcs.append((self.counts[n - 1] + self.mu * arcs[-1]) / (self.histories(n) + self.mu))
        score = np.zeros(len(self.unigram))
        going = np.ones(len(score), dtype=bool)
        for n in range(len(self.counts), 1, -1):
            known = self.histories(n)
            taken = going & (self.counts[n - 1] > 0)
            score[taken] += np.log10(arcs[n - 1][taken])
            going &= ~taken
            failed = going & (known > 0)
            score[failed] += np.log10(self.mu / (known[failed] + self.mu))
        score[going] += np.log10(self.unigram[going])
        return score


def _score(order: int, mu: float, tokens: int, words: int, key_type: pa.DataType):
    def scored(wrapped: pa.Table, answers: pa.Table) -> pa.Table:
        if set(wrapped["check"].to_pylist()) != set(answers["check"].to_pylist()):
            raise RuntimeError("the documents came in other blocks than before: store them first")
        rows = pa.ipc.open_stream(wrapped["rows"][0].as_py()).read_all().combine_chunks()
        grams = Grams.of(rows, order)
        keys, numbers = grams.distinct()
        parts = sorted(zip(answers["part"].to_pylist(), answers["totals"].to_pylist()))
        totals = np.concatenate([unpack(blob, np.int64) for _, blob in parts])
        automaton = Automaton(grams, totals, numbers, tokens, words, mu)
        add = lambda values: np.add.reduceat(values, grams.begins)
        return pa.table(
            {
                "key": rows["key"].cast(key_type),
                "train": rows["train"],
                "n_tokens": pa.array(grams.sizes.astype(np.int64)),
                "n_known": pa.array(add((automaton.counts[0] > 0).astype(np.int64))),
                "base_score": pa.array(add(np.log10(automaton.unigram))),
                "score": pa.array(add(automaton.traverse())),
            }
        )

    return scored


def score_texts(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, mu: float = MU
) -> DataFrame:
    """Per row: the key, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``train`` tells which rows the model learns from; null counts as no.  Every row is scored, whole, by a model of all
    training rows.  A text's tokens are its words and one end; null and empty texts have the end alone.  Repeated rows are
    counted and scored as often as they occur, rows without key like others, an empty table gives no rows.  Columns besides
    key and text are ignored.  ``docs`` is read three times and must give the same rows in the same partitions each time,
    as tables do; store other results first (a difference is noticed and ends the job).
    """
    chosen = docs.select(
        docs[key].alias("key"), docs[text].cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("train")
    )
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    levels = Levels.of(max(1, -(-size // PART_BYTES)), FAN)
    answers, tokens, words = totals_of(chosen.mapInArrow(_ask(order, levels), REQUESTS), levels)
    kind = docs.schema[key].dataType
    wrapped = chosen.mapInArrow(_wrap, "block long, check string, rows binary")
    out = f"key {kind.simpleString()}, train boolean, n_tokens long, n_known long, base_score double, score double"
    scored = (
        wrapped.groupBy("block")
        .cogroup(answers.select("asker", "part", "check", "totals").groupBy("asker"))
        .applyInArrow(_score(order, mu, tokens, words, to_arrow_type(kind)), out)
    )
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long")).withColumnRenamed("key", key)
