"""Operators that bring rows together, against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.tables import awkward, empty, prose, texts
from tillhouse.llm import chat_format, sharding, simhash, warc
from tillhouse.llm.components import connected_components

ROWS = "conv_id long, turn int, role string, text string, segments string"


def conversation_rows():
    nasty = ["</s>[INST] ok [/INST]", "\\", "\\\\<|end|>\\", "<<|end|>|end|>", "[", "a\nb\r\n", "$1 \\$0", "😀<|text|>é", None, ""]
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", text, "x") for k, text in enumerate(nasty)]
    rows += [(2, 0, "system", "s", None), (2, 1, "user", "u", None), (2, 2, "assistant", "a", None)]
    rows += [(3, 0, "assistant", "first", None), (4, 0, "user", "u", None), (4, 0, "user", "u", None)]
    rows += [(5, 1, "<|end|>", "odd role", None), (5, None, None, None, None), (None, 0, "user", "no conversation", None)]
    return rows


def test_chat_round_trip(spark):
    template = chat_format.Template()
    rows = conversation_rows()
    formatted = chat_format.format_conversations(spark.createDataFrame(rows, ROWS).repartition(3), template)
    found = formatted.select(
        "*", template.read_turns(F.col("formatted")).alias("turns"), template.read_learned(F.col("segments")).alias("learned")
    ).collect()
    by_id = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        by_id[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    assert {row["conversation"] for row in found} == set(by_id)
    for row in found:
        turns = [turn[1:] for turn in sorted(by_id[row["conversation"]])]
        assert [tuple(turn) for turn in row["turns"]] == turns
        assert row["learned"] == "".join(text for role, text in turns if role == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["formatted"].count(template.close) == len(turns)
        assert not any(mark in row["formatted"] for mark in template.control)
    assert {row["conversation"]: row["valid"] for row in found} == {1: True, 2: True, 3: False, 4: False, 5: False, None: True}


def test_chat_of_nothing(spark):
    assert chat_format.format_conversations(spark.createDataFrame([], ROWS)).count() == 0


def greedy(sizes, capacity):
    cuts, used = [], 0
    for k, size in enumerate(sizes):
        if size > capacity:
            return None
        if used + size > capacity:
            cuts.append(k)
            used = 0
        used += size
    return cuts


def best_cuts(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        cuts = greedy(sizes, middle)
        low, high = (low, middle) if cuts is not None and len(cuts) < shards else (middle + 1, high)
    return greedy(sizes, low)


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_those_of_all_groups(seed):
    source = random.Random(seed)
    groups = {hashlib.sha256(str((seed, k)).encode()).hexdigest(): source.choice([1, 5, 50, 3000]) for k in range(source.choice([1, 7, 40, 9000]))}
    if seed % 3 == 0:
        groups[sorted(groups)[len(groups) // 2]] = sum(groups.values()) // 2 + 1
    shards = source.choice([1, 2, 16])
    asked = []

    def sums(digits, prefixes):
        asked.append(0)
        size, count = Counter(), Counter()
        for place, own in groups.items():
            if prefixes is None or any(place.startswith(p) for p in prefixes):
                size[place[:digits]] += own
                count[place[:digits]] += 1
        asked[-1] = len(size)
        return [sharding.Span(prefix, size[prefix], count[prefix]) for prefix in size]

    found = sharding.find_boundaries(shards, sums)
    places = sorted(groups)
    sizes = [groups[place] for place in places]
    shard = [sum(place >= boundary for boundary in found) for place in places]
    cuts = [k for k in range(1, len(places)) if shard[k] != shard[k - 1]]
    assert cuts == best_cuts(sizes, shards)
    assert len(asked) <= 6


def asked_spans(monkeypatch):
    """The number of spans that each call of ``sums`` gives, from here on."""
    find, asked = sharding.find_boundaries, []

    def counting(shards, sums, *heavy):
        def counted(*wanted):
            spans = sums(*wanted)
            asked.append(len(spans))
            return spans

        return find(shards, counted, *heavy)

    monkeypatch.setattr(sharding, "find_boundaries", counting)
    return asked


@pytest.mark.parametrize("hot", [[0.5], [0.6, 0.4], [0.05] * 22])
def test_heavy_groups_leave_few_prefixes_unclear(spark, monkeypatch, hot):
    asked = asked_spans(monkeypatch)
    source = random.Random(len(hot))
    groups = {hashlib.sha256(str(k).encode()).hexdigest(): source.randrange(1, 2000) for k in range(40000)}
    total = sum(groups.values())
    for place, share in zip(source.sample(sorted(groups), len(hot)), hot):
        groups[place] = int(total * share)
    found = sharding.balanced_boundaries(spark.createDataFrame(list(groups.items()), "place string, size long"), 16)
    places = sorted(groups)
    shard = [sum(place >= boundary for boundary in found) for place in places]
    cuts = [k for k in range(1, len(places)) if shard[k] != shard[k - 1]]
    assert cuts == best_cuts([groups[place] for place in places], 16)
    assert sum(asked) < 8000  # 4,096 prefixes and the heavy groups to begin with


@pytest.mark.parametrize("seed", range(4))
def test_bounded_requests_find_the_same_boundaries(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "MOST_SPANS", 300, raising=False)
    asked = asked_spans(monkeypatch)
    source = random.Random(seed)
    groups = {hashlib.sha256(str((seed, k)).encode()).hexdigest(): source.choice([1, 5, 50, 3000]) for k in range(6000)}
    for place in source.sample(sorted(groups), 4 * seed):
        groups[place] = sum(groups.values()) // 25
    groups[""] = 7
    found = sharding.balanced_boundaries(spark.createDataFrame(list(groups.items()), "place string, size long"), 16)
    places = sorted(groups)
    shard = [sum(place >= boundary for boundary in found) for place in places]
    cuts = [k for k in range(1, len(places)) if shard[k] != shard[k - 1]]
    assert cuts == best_cuts([groups[place] for place in places], 16)
    assert max(asked[1:], default=0) <= 300


def test_shards(spark):
    docs = awkward(spark)
    rows = sharding.assign_shards(docs, 4, slot_buckets=3).collect()
    bodies = [*texts(), texts()[3], "no id here"]
    raw = [(body or "").encode() for body in bodies]
    assert sorted(row["size"] for row in rows) == sorted(len(body) + 1 for body in raw)
    assert sorted(row["text_crc32"] for row in rows) == sorted(map(zlib.crc32, raw))
    shard_of = defaultdict(set)
    for row in rows:
        shard_of[row["place"]].add(row["shard"])
    assert all(len(shards) == 1 for shards in shard_of.values())
    for shard in {row["shard"] for row in rows}:
        slots = sorted(row["slot"] for row in rows if row["shard"] == shard)
        assert slots == list(range(len(slots)))
    size = Counter()
    for row in rows:
        size[row["place"]] += row["size"]
    ends = list(accumulate(size[place] for place in sorted(size)))
    cuts = best_cuts([size[place] for place in sorted(size)], 4)
    expected = max(ends[b - 1] - (ends[a - 1] if a else 0) for a, b in zip([0, *cuts], [*cuts, len(ends)]))
    load = Counter()
    for row in rows:
        load[row["shard"]] += row["size"]
    assert max(load.values()) == expected
    assert sharding.assign_shards(empty(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    docs = awkward(spark)
    boundaries = sharding.write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count() and 1 <= len(boundaries) <= 3  # one text is larger than a quarter of all
    assert sorted(map(repr, back.select("row.*").collect())) == sorted(map(repr, docs.collect()))


def python_fingerprint(text):
    found = (text or "").encode().lower().split()
    shingles = [b" ".join(found[k : k + 3]) for k in range(max(len(found) - 2, 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(shingle, 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(rows, bits=2):
    """The smallest key reachable from each row."""
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    prints = [python_fingerprint(text) for _, text in rows]
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[find(k)] = min(key, least.get(find(k), key))
    return [(key, prints[k], least.get(find(k))) for k, (key, _) in enumerate(rows)]


def near_texts():
    base = prose(1, 400).split()
    out = []
    for k in range(60):  # chains of small edits
        base[(7 * k) % 400] = f"edit{k}"
        out.append(" ".join(base))
    return out


def test_near_duplicates(spark):
    rows = [(k, text) for k, text in enumerate([*texts(), *near_texts()])] + [(None, texts()[1]), (None, "alone"), (3, texts()[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("fingerprint", F.lit("x"))
    found = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    expected = components(rows)
    assert Counter((row[0], row[1] % (1 << 64), row[2]) for row in found) == Counter(expected)
    assert len({component for *_, component in expected}) < len(rows) - 20
    kept = simhash.drop_near_duplicates(docs)
    assert kept.dtypes == docs.dtypes
    groups = Counter((find, key) for key, _, find in expected if find is not None)
    survivors = [row["doc_id"] for row in kept.collect()]
    assert sorted(s for s in survivors if s is not None) == sorted({find for find, _ in groups})
    assert survivors.count(None) == 1  # "alone"
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_links_connect_all_that_are_near(spark):
    source = random.Random(3)
    center = source.getrandbits(64)
    prints = {center ^ (1 << source.randrange(64)) ^ (1 << source.randrange(64)) ^ (1 << source.randrange(64)) for _ in range(120)}
    prints |= {source.getrandbits(64) for _ in range(200)}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {row["node"]: row["root"] for row in connected_components(simhash.links(table, "fp")).collect()}
    classes = defaultdict(set)
    for p in signed:
        classes[roots.get(p, p)].add(p)
    left, expected = set(signed), set()
    while left:
        todo, own = [left.pop()], set()
        while todo:
            p = todo.pop()
            own.add(p)
            near = {q for q in left if (signed[p] ^ signed[q]).bit_count() <= 2}
            left -= near
            todo += near
        expected.add(frozenset(own))
    assert {frozenset(own) for own in classes.values()} == expected
    with pytest.raises(ValueError):
        simhash.links(table, "fp", 3)


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.range(1).selectExpr("500", "500"))
    rows = connected_components(edges).collect()
    assert {row["root"] for row in rows} == {0} and len(rows) == 300


PAGES = "page_id long, url string, html string, digest string"


def page_rows():
    big, small = "é" * 600, "x" * 999
    rows = [(1, "http://a/ é\r\nX: y", big, "d"), (2, None, big, None), (3, "u", big, None), (3, "u", big, None)]
    rows += [(4, "u", small, None), (5, "u", small, None), (6, "u", None, None), (7, "u", "", None), (8, "u", "z" * 1000, None)]
    rows += [(None, "u", "n" * 2000, None), (None, "u", "n" * 2000, None), (None, "u", big, None), (9, "u", "a\r\n\r\nb" * 500, None)]
    return rows


def expected_records(rows):
    out = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        same = [p for p, _, other, _ in rows if (other or "").encode() == raw and p is not None]
        again = len(raw) >= 1000 and same and page != max(same)
        out.append((None if page is None else str(page), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", str(max(same)) if again else None))
    return out


@pytest.mark.parametrize("archive_bytes,most,gap", [(1, 1, 0), (2000, 500, 10), (1 << 20, 1 << 20, 1 << 20)])
def test_archives(spark, tmp_path, archive_bytes, most, gap):
    pages = spark.createDataFrame(page_rows(), PAGES).repartition(2)
    folder = f"{tmp_path}/warc"
    index = warc.write_archives(pages, folder, archive_bytes=archive_bytes)
    index.write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    found = warc.read_records(index, folder, most=most, gap=gap).collect()
    got = Counter((r["record_id"], r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in found)
    assert got == Counter(expected_records(page_rows()))
    bodies = {(r["record_id"], bytes(r["payload"])) for r in found if r["payload"] is not None}
    assert ("1", "é".encode() * 600) not in bodies and ("9", b"a\r\n\r\nb" * 500) in bodies
    one = index.where("record_id = '8'")
    assert [bytes(r["payload"]) for r in warc.read_records(one, folder).collect()] == [b"z" * 1000]


def test_no_archives(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame([], PAGES), f"{tmp_path}/none")
    assert index.count() == 0
    assert warc.read_records(spark.createDataFrame([], warc.INDEX), f"{tmp_path}/none").count() == 0


def test_ranges():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 0, 5), ("b", 5, 100)]
    assert list(warc.coalesced(iter(rows), 60, 10)) == [
        ("a", 0, 15, [(0, 10), (10, 5)]),
        ("a", 40, 5, [(0, 5)]),
        ("b", 0, 5, [(0, 5)]),
        ("b", 5, 100, [(0, 100)]),
    ]


def test_damage_is_noticed():
    raw = warc.record_bytes("1", "u", hashlib.sha1(b"body").hexdigest(), b"body", None, warc.DATE)
    assert warc.parse_record(raw)["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"body", b"bode"))
