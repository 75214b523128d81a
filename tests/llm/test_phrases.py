"""Collocations against plain counting, and the word index against all n-grams of a text."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.tables import awkward, empty, prose
from tillhouse.functions.materialize import stored
from tillhouse.llm import phrases


def pieces(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def plain(rows, least, top, depth=5):
    """Rows (lang, rank, phrase, a, l, r, n, score) from (text, lang)."""
    counts, totals, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for size in range(1, depth + 1):
                counts[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            longer = [
                f for q, f in candidates.items()
                if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))
            ]
            if any(100 * f >= 100 * a for f in longer):
                continue
            n = totals[lang]
            score, _, l, r = min(
                (1000 * a * n // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p))
            )
            kept.append((-score, -a, " ".join(p).encode(), l, r, n))
        for rank, (score, a, p, l, r, n) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def mined(docs, **options):
    return sorted(tuple(row) for row in phrases.mine_collocations(docs, **options).collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=9), max_size=6))
def test_word_index(parts):
    text = np.array([0] + [x for part in parts if part for x in [*part, 0]], dtype=np.int64)
    expected = [
        Counter(tuple(part[k : k + size]) for part in parts for k in range(len(part) - size + 1)) for size in range(2, 6)
    ]
    found = [
        {tuple(words): int(size) for words, size in zip(grams.words.tolist(), grams.sizes)}
        for grams in phrases.WordIndex(text).n_grams(5)
    ]
    assert found == [dict(counter) for counter in expected]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=9), max_size=6), st.integers(2, 5))
def test_windows_are_one_per_word_at_most(parts, depth):
    text = np.array([0] + [x for part in parts if part for x in [*part, 0]], dtype=np.int64)
    expected = Counter(tuple(part[k : k + depth]) for part in parts for k in range(len(part) - 1))
    found = Counter()
    for words, counts in phrases.windows_of(phrases.WordIndex(text), depth):
        found.update({tuple(row): int(n) for row, n in zip(words.tolist(), counts)})
    assert found == expected


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_phrases_of_windows(spark, batch):
    source = random.Random(9)
    # "\x1c" and "\x00" come before a space in byte order
    words = ["a", "a\x1c", "a\x00b", "b", "bé", "\U0001f600"]
    rows = [
        (source.choice(["en", "de"]), tuple(source.choice(words) for _ in range(source.randint(2, 5))), source.randint(1, 3))
        for _ in range(400)
    ]
    expected = Counter()
    for lang, window, n in rows:
        for size in range(2, len(window) + 1):
            expected[lang, " ".join(window[:size]), size] += n
    windows = spark.createDataFrame(
        [(lang, "".join(f"{word} " for word in window), n) for lang, window, n in rows], "lang string, window string, n long"
    )
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch))
    try:
        parts = phrases._window_phrases(windows, 8, 5).collect()
    finally:
        spark.conf.set(key, before)
    found = Counter()
    for row in parts:
        found[row["lang"], row["phrase"], row["size"]] += row["n"]
    assert {k: n for k, n in found.items() if n >= 8} == {k: n for k, n in expected.items() if n >= 8}


def handed_on(monkeypatch, docs, **options):
    """The rows that shards hand on, and the phrases counted."""
    kept = {}

    def keep(df, label):
        kept[label] = stored(df, label)
        return kept[label]

    monkeypatch.setattr(phrases, "stored", keep)
    counted = phrases.count_phrases(docs, **options)[0].where("size > 1").collect()
    return kept["phrase-windows"].collect(), {(row["lang"], row["phrase"]): row["f"] for row in counted}


@pytest.mark.parametrize("shards", [1, 7])
def test_a_pair_is_handed_on_by_one_shard(spark, monkeypatch, shards):
    rows = [("red fox. old dog, a b c", "en"), ("red fox", "de")] * 70
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(shards)
    windows, counted = handed_on(monkeypatch, docs, least=60)
    pairs = sorted((row["lang"], row["window"], row["n"]) for row in windows if row["window"].count(" ") == 2)
    assert pairs == [("de", "red fox ", 70)] + [("en", x, 70) for x in ("a b ", "b c ", "old dog ", "red fox ")]
    assert counted == {
        ("de", "red fox"): 70, **{("en", x): 70 for x in ("a b", "a b c", "b c", "old dog", "red fox")}
    }


def test_pairs_whose_hashes_are_equal(spark, monkeypatch):
    rows = [("red fox, old dog, a b c d", "en")] * 9 + [("old dog, a b", "en")] * 4
    same = lambda data, ends: (np.ones(data.tobytes().count(b" ") + 1, dtype=np.uint64), None)
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    monkeypatch.setattr(phrases, "word_hashes", same)
    assert mined(docs, least=5) == plain(rows, 5, phrases.TOP)


@pytest.mark.parametrize("shortest", [2, 3, 4])
def test_runs_that_are_long_enough(shortest):
    numbers = np.array([0, 1, 2, 0, 1, 2, 3, 9, 1, 2, 3, 4, 0, 5, 0])
    pairs = np.array([(k << 32) | (k + 1) for k in (1, 2, 3)])
    runs = phrases.frequent_runs(numbers, pairs, shortest)
    expected = [run for run in ([1, 2], [1, 2, 3], [1, 2, 3, 4]) if len(run) >= shortest]
    assert runs.tolist() == [0] + [x for run in expected for x in [*run, 0]]


def test_words_and_pieces():
    texts = ["Ab cd\tEF. gh,,A\x0bb", "", " \t", "É\x1c ß x y", "..;"]
    numbers, words = phrases.number_words([text.encode() for text in texts])
    joined = " ".join(words[k].decode() if k else "|" for k in numbers)
    expected = [" ".join(piece) for text in texts for piece in pieces(text) if piece]
    assert [part.strip() for part in joined.split("|") if part.strip()] == expected


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 20])
def test_some_languages(spark, block_bytes):
    source = random.Random(4)
    passage = "one two, three Four five six seven; of the of the of"
    rows = []
    for k in range(160):
        words = " ".join(source.choice("of the of and a to In x y z".split()) + source.choice(["", "", ",", ".", "\n"]) for _ in range(30))
        rows.append((k, f"{words} {passage if k % 3 else ''} {words[:40]}", [None, "en", "en", "de", "und", ""][k % 6]))
    rows += [(None, None, "en"), (200, "", "fr"), (201, "alone", "es"), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    plain_rows = [(text, lang) for _, text, lang in rows]
    assert mined(docs, least=6, block_bytes=block_bytes) == plain(plain_rows, 6, phrases.TOP)
    assert mined(docs, least=6, top=3, block_bytes=block_bytes) == plain(plain_rows, 6, 3)


def test_awkward_rows(spark):
    docs = awkward(spark).withColumnRenamed("spans", "lang").withColumnRenamed("row", "phrase")
    rows = [(row["text"], row["lang"]) for row in docs.collect() if row["doc_id"] != 20]
    assert mined(docs.where("doc_id IS NULL OR doc_id <> 20"), least=2) == plain(rows, 2, phrases.TOP)


def test_a_hot_text_in_many_shards(spark):
    rows = [("Same old story, same old song", "en")] * 300 + [(prose(k, 40), "en") for k in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(9)
    assert mined(docs, least=50, block_bytes=1_000) == plain(rows, 50, phrases.TOP)


def test_no_phrases(spark):
    nothing = empty(spark).withColumnRenamed("spans", "lang")
    assert mined(nothing) == []
    assert mined(spark.createDataFrame([("a b", "en")], "text string, lang string")) == []
