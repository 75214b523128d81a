"""Language model, classifier and packing: against plain Python, on held-out rows, and by round trips."""

import json
import math
import re
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.tables import awkward, empty, prose, texts
from tillhouse.llm import lm_scoring, packing, quality_classifier
from tillhouse.llm.blocks import raw_texts, rows_in_blocks, word_hashes
from tillhouse.llm.common import held_out
from tillhouse.llm.queries import op5_quality_classifier

SAMPLE = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def tokens(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w] + ["end"]


class Reference:
    """The model by its definition."""

    def __init__(self, training, order, mu):
        self.order, self.mu, self.counts, self.after = order, mu, Counter(), Counter()
        for text in training:
            own = ["begin", *tokens(text)]
            for k in range(1, len(own)):
                for n in range(order):
                    if k - n >= 0:
                        self.counts[tuple(own[k - n : k + 1])] += 1
                        self.after[tuple(own[k - n : k])] += 1
        self.total = sum(c for gram, c in self.counts.items() if len(gram) == 1)
        self.known = sum(len(gram) == 1 for gram in self.counts)

    def unigram(self, word):
        return (self.counts[(word,)] + 0.5) / (self.total + 0.5 * (self.known + 1))

    def p(self, history, word):
        if not history:
            return self.unigram(word)
        lower = self.p(history[1:], word)
        return (self.counts[(*history, word)] + self.mu * lower) / (self.after[tuple(history)] + self.mu)

    def score(self, text):
        own = ["begin", *tokens(text)]
        return sum(math.log10(self.p(own[max(0, k - self.order + 1) : k], own[k])) for k in range(1, len(own)))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_language_model(spark, order, tmp_path):
    awkward(spark).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    every = [(row["doc_id"], row["text"]) for row in docs.collect()]
    training = [text for key, text in every if key is None or key % 4]
    model = Reference(training, order, 3.0)
    found = lm_scoring.score_texts(docs, F.expr("doc_id is null or doc_id % 4 <> 0"), order=order, mu=3.0).collect()
    assert len(found) == len(every)
    bodies = dict(every)
    for row in found:
        own = tokens(bodies[row["doc_id"]])
        assert row["n_tokens"] == len(own)
        assert row["n_known"] == sum(model.counts[(word,)] > 0 for word in own)
        assert row["train_tokens"] == model.total
        assert row["base_score"] == pytest.approx(sum(math.log10(model.unigram(word)) for word in own), rel=1e-9)
        assert row["score"] == pytest.approx(model.score(bodies[row["doc_id"]]), rel=1e-9)
    words = {gram[0] for gram in model.counts if len(gram) == 1}
    for history in (["begin"], [b"the"], [b"the", b"and"][: order - 1]):
        if len(history) < order:
            assert sum(model.p(history, word) for word in [*words, "new"]) == pytest.approx(1)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_totals_do_not_depend_on_levels(spark, parts, monkeypatch):
    """Requests of many blocks for many parts, over up to four levels, get the sums by n-gram."""
    levels = lm_scoring.Levels.of(parts, 4)
    assert levels.fan <= 4 and levels.parts(levels.depth) >= parts
    random = np.random.default_rng(parts)
    known = np.unique(random.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + np.arange(400, dtype=np.uint64) % np.uint64(2))
    rows, asked, sums = [], {}, Counter()
    for block in range(60):
        keys = np.sort(random.choice(known, 90, replace=False))
        counts = random.integers(0, 5, len(keys))
        asked[block << 24] = keys.tolist()
        sums.update(dict(zip(keys.tolist(), counts.tolist())))
        rows += pa.table(lm_scoring._request_rows(levels, 1, 0, block << 24, str(block), keys, counts)).to_pylist()
    requests = spark.createDataFrame(rows, lm_scoring.REQUESTS)
    answers, tokens, words = lm_scoring.totals_of(requests, levels)
    found = {}
    for row in answers.orderBy("asker", "part").collect():
        assert row["check"] == str(row["asker"] >> 24)
        found.setdefault(row["asker"], []).extend(lm_scoring.unpack(row["totals"], np.int64).tolist())
    assert found == {block: [sums[key] for key in keys] for block, keys in asked.items()}
    assert tokens == sum(n for key, n in sums.items() if key & 1)
    assert words == sum(n > 0 for key, n in sums.items() if key & 1)


def test_requests_of_a_block_do_not_grow_with_the_corpus():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 300_000, dtype=np.uint64) * np.uint64(2))
    counts = np.ones(len(keys), dtype=np.int64)
    sizes = []
    for parts in (100, 8_192, 10_000, 100_000, 10_000_000):
        levels = lm_scoring.Levels.of(parts, lm_scoring.FAN)
        rows = pa.table(lm_scoring._request_rows(levels, 1, 0, 0, "check", keys, counts))
        assert rows.num_rows <= lm_scoring.FAN and levels.depth <= 2
        sizes.append(rows.nbytes)
        for level in range(1, levels.depth + 1):  # what one task merges: as many requests as one has been divided into
            assert parts <= levels.parts(level) * levels.groups(level) < 2 * parts
    assert max(sizes) < 1.5 * min(sizes)


def test_language_model_in_levels(spark, tmp_path, monkeypatch):
    awkward(spark).repartition(7).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")

    def scored():
        return sorted(map(repr, lm_scoring.score_texts(docs, F.expr("doc_id % 4 <> 0")).collect()))

    whole = scored()
    for name, value in (("PART_BYTES", 20_000), ("BLOCK_BYTES", 5_000), ("FAN", 3)):
        monkeypatch.setattr(lm_scoring, name, value)
    assert scored() == whole


def test_language_model_of_nothing(spark):
    docs = empty(spark)
    assert lm_scoring.score_texts(docs, F.lit(True)).count() == 0
    untrained = lm_scoring.score_texts(awkward(spark).sortWithinPartitions("doc_id"), F.lit(None).cast("boolean"))
    assert untrained.where("score <> 0 or n_known <> 0 or train_tokens <> 0").count() == 0


def test_held_out_texts_are_more_likely_than_by_words_alone(spark):
    docs = spark.read.parquet(f"{SAMPLE}/documents.parquet")
    scored = lm_scoring.score_texts(docs, ~held_out(docs["doc_id"], 5, 1))
    score, base, n = scored.where("not train").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert n > 100 and score > base


def test_blocks_bound_rows_without_text():
    bodies = [None, ""] * 5000 + ["a" * 5000, "b"] + [""] * 3
    batches = pa.table({"text": pa.array(bodies, pa.string())}).to_batches(max_chunksize=700)
    blocks = [block["text"].to_pylist() for block in rows_in_blocks(iter(batches), "text", 4096)]
    assert [text for block in blocks for text in block] == bodies
    assert all(blocks) and max(map(len, blocks)) <= 64
    assert ["a" * 5000] in blocks


def test_word_hashes_of_long_texts():
    import pyarrow as pa

    words = [f"w{k % 1000}" for k in range(600_000)]
    whole = pa.table({"text": [" ".join(words), None, "W1 w1"]})
    hashes, counts = word_hashes(*raw_texts(whole, "text"))
    assert counts.tolist() == [600_000, 0, 2]
    assert len(np.unique(hashes)) == 1000 and hashes[-1] == hashes[-2] == hashes[1]


def test_classifier_on_held_out_rows(spark):
    labels = spark.read.parquet(f"{SAMPLE}/labels.parquet")
    scored = op5_quality_classifier(spark, SAMPLE)
    assert scored.count() == spark.read.parquet(f"{SAMPLE}/documents.parquet").count()
    rows = scored.join(labels, "doc_id").where("held_out and quality is not null").collect()
    good = [row["score"] for row in rows if row["quality"] == 1]
    bad = [row["score"] for row in rows if row["quality"] == 0]
    ordered = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert ordered > 0.95
    assert sum(row["predicted"] == row["quality"] for row in rows) > 0.9 * len(rows)


def test_classifier_of_awkward_texts(spark, monkeypatch):
    model = quality_classifier.fit([prose(k, 50) for k in range(6)] + ["!! ??", "?? !!"], [1] * 6 + [0] * 2)
    found = quality_classifier.score_quality(awkward(spark), model).collect()
    assert len(found) == len(texts()) + 2 and all(0 <= row["score"] <= 1 for row in found)
    by_id = {row["doc_id"]: row["score"] for row in found}
    bodies = dict(enumerate(texts()))
    for key in bodies:
        assert by_id[key] == pytest.approx(model.scores([bodies[key] or ""])[0])
    assert by_id[14] == by_id[15]  # null and empty
    whole = model.logits([bodies[20]])[0]
    monkeypatch.setattr(quality_classifier, "SLICE", 5000)
    assert model.logits([bodies[20]])[0] == pytest.approx(whole, abs=1e-9)
    assert quality_classifier.score_quality(empty(spark), model).count() == 0
    assert quality_classifier.fit([], []).scores(["x"]) == [0.5]


def check_pieces(rows, bodies, capacity):
    """Pieces cover each document's ids once and fill sequences without gaps; returns the padding."""
    file = Tokenizer.from_file(TOKENIZER)
    left = Counter()
    for body in bodies:
        left[tuple(file.encode(body or "", add_special_tokens=False).ids) + (1,)] += 1
    starts = {}
    sequences = {}
    for row in rows:
        ids = np.frombuffer(row["ids"], dtype="<u4")
        assert len(ids) == row["length"] > 0
        starts.setdefault((row["doc_id"], row["doc_tokens"]), []).append((row["start"], ids))
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for (_, total), pieces in starts.items():
        pieces.sort(key=lambda piece: piece[0])
        copies = sum(start == 0 for start, _ in pieces)
        if copies > 1:  # repeated rows are cut alike or not at all
            continue
        joined = np.concatenate([ids for _, ids in pieces])
        assert len(joined) == total and [s for s, _ in pieces] == np.cumsum([0, *(len(i) for _, i in pieces)])[:-1].tolist()
        left[tuple(joined.tolist())] -= 1
    assert sum(max(n, 0) for n in left.values()) <= 2
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
        padding += capacity - at
    return padding


def test_packing(spark):
    docs = awkward(spark)
    rows = packing.pack_texts(docs, TOKENIZER, capacity=256).collect()
    padding = check_pieces(rows, [row["text"] for row in docs.collect()], 256)
    assert padding < 256 * docs.rdd.getNumPartitions()
    assert packing.pack_texts(empty(spark), TOKENIZER).count() == 0


def test_ids_are_those_of_the_file():
    own, file = packing.Tokenizer(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    odd = ["", " ", "  ", "a  b", "a   b\n  c \t d", "x<|endoftext|>y z", "\n\n a", "it's John's x 12 3", "a \n b", "é́ 　 b  "]
    odd += ["  a", "a ", "tab\t b", "\r\n x", "a b c  d", "\x1c x \x85 y", "日本 語", "\U0001f600 x", *[t or "" for t in texts()]]
    for text, ids in zip(odd, own.encode(odd)):
        assert ids.tolist() == file.encode(text, add_special_tokens=False).ids, text[:50]


def test_long_texts_are_cut_between_tokens(monkeypatch):
    own, file = packing.Tokenizer(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    long = [" ".join(["it's", "a  b", "\n c", "12 3", " \t", "x\x85 y", "日本"] * 40), "no-space" * 50, " " * 300 + "a b"]
    for least in (1, 7, 100):
        monkeypatch.setattr(packing, "SLICE", least)
        assert all("".join(packing._parts(text, least)) == text for text in long)
        for text, ids in zip(long, own.encode(long)):
            assert ids.tolist() == file.encode(text, add_special_tokens=False).ids


def test_other_kinds_of_tokenizer_files_are_refused(tmp_path):
    found = json.loads(Path(TOKENIZER).read_text())
    for change in ({"normalizer": {"type": "Lowercase"}}, {"model": {**found["model"], "merges": found["model"]["merges"][::-1]}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**found, **change}))
        with pytest.raises(ValueError):
            packing.Tokenizer(str(path))


def test_placement_is_full_and_balanced():
    lengths = np.random.default_rng(1).integers(1, 700, 3000)
    pieces = packing.place(lengths, 1000, 1.0, 0.001)
    load, cost = Counter(), Counter()
    for _, _, n, sequence, _ in pieces:
        load[sequence] += n
        cost[sequence] += n + 0.001 * n * n
    assert sum(load.values()) == lengths.sum() and max(load.values()) <= 1000
    assert len(load) == -(-int(lengths.sum()) // 1000)
    assert len(pieces) < len(lengths) * 1.5
    assert max(cost.values()) < 1.6 * sum(cost.values()) / len(cost)


class PlainClassifier:
    """The classifier by its definition, feature by feature."""

    def __init__(self, texts, labels, seed):
        random = np.random.default_rng(seed)
        size, self.vectors = quality_classifier.DIMENSIONS, {}
        start = random.uniform(-1 / size, 1 / size, (1 << quality_classifier.BITS, size)).astype(np.float32)
        self.vector = lambda bucket: self.vectors.setdefault(bucket, [float(x) for x in start[bucket]])
        self.layer, self.bias = [[0.0] * size, [0.0] * size], [0.0, 0.0]
        steps = quality_classifier.EPOCHS * len(texts)
        for step in range(steps):
            if step % len(texts) == 0:
                order = random.permutation(len(texts))
            k = order[step % len(texts)]
            self.learn(texts[k], labels[k], quality_classifier.RATE * (1 - step / steps))

    def mean(self, text):
        found = self.buckets(text)
        return found, [sum(self.vector(b)[d] for b in found) / len(found) for d in range(quality_classifier.DIMENSIONS)]

    @staticmethod
    def buckets(text):
        return quality_classifier._features([text])[0].tolist()

    def probabilities(self, mean):
        raised = [math.exp(sum(w * x for w, x in zip(row, mean)) + b) for row, b in zip(self.layer, self.bias)]
        return [x / sum(raised) for x in raised]

    def learn(self, text, label, rate):
        found, mean = self.mean(text)
        error = [p - (j == label) for j, p in enumerate(self.probabilities(mean))]
        back = [sum(error[j] * self.layer[j][d] for j in (0, 1)) for d in range(len(mean))]
        for j in (0, 1):
            self.bias[j] -= rate * 0.1 * error[j]
            self.layer[j] = [w - rate * error[j] * x for w, x in zip(self.layer[j], mean)]
        for bucket in found:  # each occurrence moves its vector
            vector = self.vector(bucket)
            for d, slope in enumerate(back):
                vector[d] -= rate * 10 * slope / len(found)

    def score(self, text):
        return self.probabilities(self.mean(text)[1])[1]


def test_classifier_against_plain_python():
    bodies = [prose(k, 12) for k in range(5)] + ["!! ?? !! !!", "buy buy buy now", "x", ""]
    labels = [1, 1, 1, 0, 1, 0, 0, 0, 1]
    plain, model = PlainClassifier(bodies, labels, 3), quality_classifier.fit(bodies, labels, seed=3)
    for text in [*bodies, prose(9, 30), "buy now", "\u65e5\u672c !!"]:
        assert model.scores([text])[0] == pytest.approx(plain.score(text), abs=1e-4), text


def test_classifier_features_by_definition():
    """Number of features: the common one, each word, each repeated word, and n-grams with a border."""
    for text in ["", "a", "ab ab", "abcd x", "one one one\tlonger-word", "caf\u00e9 caf\u00e9"]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        inner = sum(max(0, len(w) + 2 - n + 1) for w in words for n in quality_classifier.SIZES)
        again = sum(a == b for a, b in zip(words, words[1:]))
        assert len(quality_classifier._features([text])[0]) == 1 + len(words) + again + inner, text


def test_sample_is_bounded_by_bytes(spark):
    """What goes to the driver is the features of rows in the order of their hashes, until the bound is reached."""
    docs = spark.createDataFrame([(k, prose(k, 40)) for k in range(30)] + [(None, "x"), (99, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(99, 1), (None, 1)], "doc_id long, quality int")
    every = quality_classifier.sample_features(docs, labels, F.lit(True), "quality")
    assert len(every) == 31 and sorted(label for _, _, label in every) == [0] * 15 + [1] * 16
    bodies = [prose(k, 40) for k in range(30)] + [""]
    for (buckets, shares, label), (own, parts) in zip(every, quality_classifier._sparse(bodies)):
        assert buckets.tolist() == own.tolist() and shares.tolist() == parts.tolist()
    sizes = sum(len(buckets) for buckets, _, _ in every) * 8
    some = quality_classifier.sample_features(docs, labels, F.lit(True), "quality", limit=sizes // 2)
    assert 5 < len(some) < 31 and sum(len(buckets) for buckets, _, _ in some) * 8 <= sizes // 2
    assert quality_classifier.sample_features(docs, labels, F.lit(True), "quality", limit=1) == []
    assert len(quality_classifier.sample_features(docs, labels, F.lit(True), "quality", sample=7)) == 7


def test_slices_change_no_features(monkeypatch):
    some = ["again " * 40 + "once", "a b\n\nb  b c" * 9, "long" * 30, "", "  ", "x " + "y" * 50 + " " + "y" * 50 + " \t z"]

    def found():
        parts = [(b, o) for b, o in quality_classifier.features(some)]
        return Counter(zip(np.concatenate([b for b, _ in parts]).tolist(), np.concatenate([o for _, o in parts]).tolist()))

    whole = found()
    for size in (1, 3, 8, 40):
        monkeypatch.setattr(quality_classifier, "SLICE", size)
        assert found() == whole
