"""A supervised classifier of texts by subword embeddings.

Words and the character n-grams inside them (with their borders) are hashed to vectors; a document is the mean of its
vectors, and a softmax layer gives the probability of label 1.  Vectors and layer are learned by stochastic gradient
descent on a bounded sample.  For scoring, each vector is multiplied with the layer once, which leaves one number per
bucket: the logit of a document is the mean of the numbers of its features.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillhouse.functions.materialize import stored
from tillhouse.llm.blocks import mix, powers, rows_in_blocks

SIZES = (3, 4, 5)  # characters of an n-gram, of which the first or last may be a word's border
BITS = 18  # buckets: 2^18
DIMENSIONS = 10
EPOCHS = 8
RATE = 0.5
SAMPLE = 4000  # labelled rows to learn from, at most
SAMPLE_BYTES = 96 << 20  # of their features, at most
SLICE = 1 << 18  # characters whose features are held at a time
BLOCK_BYTES = 8 << 20

_BREAKS = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint32)
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_TEXT, _AGAIN = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each feature of some texts.

    Besides its words and n-grams each text has one feature that all texts have, and one for each word that repeats the
    word before it.
    """
    joined = "\n".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([0, *(len(text) + 1 for text in texts)])  # the breaks before each text and after the last
    solid = ~((points <= 32) & np.isin(points, _BREAKS))
    codes = np.where(solid, mix(points.astype(np.uint64) + np.uint64(1)), np.uint64(0))
    found, owners = [np.full(len(texts), _TEXT)], [np.arange(len(texts))]

    def add(hashes: np.ndarray, at: np.ndarray) -> None:
        found.append(mix(hashes))
        owners.append(np.searchsorted(ends, at, side="right") - 1)

    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    starts = np.flatnonzero(begins)
    if len(starts):
        at = np.flatnonzero(solid)
        place = at - starts[np.cumsum(begins)[at] - 1]
        words = np.add.reduceat(codes[at] * powers(int(place.max()) + 1)[place], np.flatnonzero(place == 0))
        add(words, starts)
        own = np.searchsorted(ends, starts, side="right")
        again = np.flatnonzero((words[1:] == words[:-1]) & (own[1:] == own[:-1])) + 1
        add(np.full(len(again), _AGAIN), starts[again])
    base = powers(max(SIZES))
    for size in SIZES:
        if len(codes) < size:
            continue
        count = len(codes) - size + 1
        inner = solid[1 : count + 1].copy()
        for k in range(2, size - 1):
            inner &= solid[k : k + count]
        at = np.flatnonzero(inner)
        hashes = np.full(len(at), np.uint64(size))
        for k in range(size):
            hashes += codes[at + k] * base[k]
        add(hashes, at + 1)
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(owners)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``_features`` of consecutive slices of the texts, with text numbers for all of them.

    A text longer than a slice is taken apart between words, which changes none of its features.
    """
    held: list[tuple[int, str, str | None]] = []
    size = 0
    for k, text in enumerate(texts):
        before = None  # the last word of the piece before
        while text is not None:
            piece, text = _split(text)
            if held and size + len(piece) > SLICE:
                yield _numbered(held)
                held, size = [], 0
            held.append((k, piece, before))
            size += len(piece)
            if text is not None:
                before = next(reversed(_WORDS.findall(piece)), before or "")
    if held:
        yield _numbered(held)


def _split(text: str) -> tuple[str, str | None]:
    if len(text) <= SLICE:
        return text, None
    cut = next((k for k in range(SLICE, len(text)) if text[k] in "\t\n\v\f\r "), None)
    return (text, None) if cut is None else (text[:cut], text[cut:])


def _numbered(held: list[tuple[int, str, str | None]]) -> tuple[np.ndarray, np.ndarray]:
    """The features of pieces; of those that continue a text (with a word before), without the one that all texts have."""
    buckets, owners = _features([piece for _, piece, _ in held])
    numbers = np.array([k for k, _, _ in held])
    keep = np.ones(len(buckets), dtype=bool)
    keep[: len(held)] = [before is None for _, _, before in held]
    seams = [k for k, piece, before in held if before and (word := _WORDS.search(piece)) and word[0] == before]
    again = np.full(len(seams), mix(np.array([_AGAIN]))[0] >> np.uint64(64 - BITS)).astype(np.int64)
    return np.concatenate([buckets[keep], again]), np.concatenate([numbers[owners[keep]], np.array(seams, dtype=numbers.dtype)])


def _sparse(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares among its features."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for buckets, owners in features(texts):
        order = np.argsort(owners, kind="stable")
        cuts = np.searchsorted(owners[order], np.arange(len(texts) + 1))
        for k in np.unique(owners).tolist():
            parts[k].append(buckets[order[cuts[k] : cuts[k + 1]]])
    out = []
    for own in parts:
        distinct, counts = np.unique(np.concatenate(own), return_counts=True)
        out.append((distinct, (counts / counts.sum()).astype(np.float32)))
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # by bucket: the vector times the difference of the softmax layer's two rows
    bias: float

    def logits(self, texts: list[str]) -> np.ndarray:
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, owners in features(texts):
            total += np.bincount(owners, self.weights[buckets], len(texts))
            count += np.bincount(owners, minlength=len(texts))
        return total / np.maximum(count, 1) + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -500, 500)))


def fit(texts: list[str], labels: list[int], seed: int = 1) -> Model:
    """Learn from texts and labels 0 or 1; with no text, all scores are one half."""
    return fit_features([(*own, label) for own, label in zip(_sparse(texts), labels)], seed)


def fit_features(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> Model:
    """Learn from the buckets, shares and label of each text."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((2, DIMENSIONS), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps = max(1, EPOCHS * len(samples))
    for step in range(EPOCHS * len(samples)):
        if step % len(samples) == 0:
            order = random.permutation(len(samples))
        buckets, shares, label = samples[order[step % len(samples)]]
        rate = RATE * (1 - step / steps)
        mean = shares @ vectors[buckets]
        logits = layer @ mean + bias
        error = np.exp(logits - logits.max())
        error /= error.sum()
        error[label] -= 1
        back = error @ layer
        layer -= rate * np.outer(error, mean)
        bias -= rate * 0.1 * error
        vectors[buckets] -= (rate * 10) * np.outer(shares, back)
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def _sample_rows(key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_in_blocks(batches, "text", BLOCK_BYTES):
            own = _sparse([value or "" for value in rows["text"].to_pylist()])
            yield pa.RecordBatch.from_pydict(
                {
                    "key": rows["key"].combine_chunks().cast(key_type),
                    "label": rows["label"].combine_chunks().cast(pa.int32()),
                    "buckets": pa.array([buckets.astype("<i4").tobytes() for buckets, _ in own], pa.binary()),
                    "shares": pa.array([shares.astype("<f4").tobytes() for _, shares in own], pa.binary()),
                }
            )

    return run


def sample_features(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    limit: int = SAMPLE_BYTES,
) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets, shares and label of each text of the sample, made from whole texts in tasks."""
    chosen = (
        labels.where(usable & labels[label].isin(0, 1) & labels[key].isNotNull())
        .groupBy(labels[key].alias("key"))
        .agg(F.min(labels[label]).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(sample)
    )
    texts = docs.select(docs[key].alias("key"), F.coalesce(docs[text], F.lit("")).alias("text"))
    kind = docs.schema[key].dataType
    found = stored(
        texts.join(F.broadcast(chosen), "key")  # at most ``sample`` rows
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.min("text").alias("text"))
        .mapInArrow(_sample_rows(to_arrow_type(kind)), f"key {kind.simpleString()}, label int, buckets binary, shares binary"),
        "classifier-sample",
    )
    size = F.octet_length("buckets") + F.octet_length("shares")
    so_far = F.sum(size.cast("long")).over(Window.orderBy(F.xxhash64("key"), "key"))  # over sizes of at most ``sample`` rows
    kept = found.select("key", so_far.alias("so_far")).where(F.col("so_far") <= limit).select("key")
    rows = found.join(F.broadcast(kept), "key", "left_semi").orderBy("key").collect()  # at most ``limit`` bytes
    return [(np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["shares"], "<f4"), r["label"]) for r in rows]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    limit: int = SAMPLE_BYTES,
) -> Model:
    """Fit on at most ``sample`` labelled rows of ``labels`` for which ``usable`` holds, and ``limit`` bytes of features.

    Those with the smallest hashes of their keys are taken, until either bound; a text takes eight bytes for each distinct
    feature of it, two million at most.  Labels other than 0 and 1 are not taken.  Where a key has several labels or
    texts, the smallest counts.
    """
    return fit_features(sample_features(docs, labels, usable, label, key, text, sample, limit))


def score_quality(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and ``score``, the probability of label 1.

    Whole texts are scored, without shuffle; null and empty texts by the one feature that all texts have.  Repeated rows
    get equal scores, an empty table gives no rows.  Columns besides key and text are ignored.
    """
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_in_blocks(batches, "text", BLOCK_BYTES):
            scores = model.scores([value or "" for value in rows["text"].to_pylist()])
            yield from pa.table({"key": rows["key"].cast(key_type), "score": pa.array(scores)}).to_batches()

    chosen = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    return chosen.mapInArrow(run, f"key {kind.simpleString()}, score double").withColumnRenamed("key", key)
