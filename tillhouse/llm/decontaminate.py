"""Benchmark decontamination: one Aho-Corasick automaton over windows of benchmark words, run once over each text.

Texts are normalised byte by byte (A-Z to a-z, everything but digits, letters and non-ASCII characters to a break), so a
word's place in the normalised text is found again in the original.

The windows are written to shared storage, divided by hash into blocks of bounded size, and each task reads them from
there: neither the driver nor a task holds more of the benchmark than one block, whatever its size.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tillhouse.functions.materialize import scratch_path, stored
from tillhouse.llm.blocks import file_system, rows_in_blocks

WINDOW = 10
BLOCK_CHARS = 16 << 20  # characters of the windows in one automaton
TEXT_BYTES = 8 << 20  # text that meets one automaton after the other

_TABLE = bytearray(b" " * 128 + bytes(range(128, 256)))
_TABLE[48:58] = bytes(range(48, 58))
_TABLE[97:123] = bytes(range(97, 123))
_TABLE[65:91] = bytes(range(97, 123))
NORMAL = bytes(_TABLE)

_automata: dict[str, ahocorasick.Automaton | None] = {}  # in each worker, the last one built


def windows(text: str | None, size: int = WINDOW) -> set[str]:
    """The windows of a benchmark text, as patterns that match whole words only."""
    found = (text or "").encode().translate(NORMAL).split()
    last = max(len(found) - size, 0)
    return {f" {b' '.join(found[k : k + size]).decode('latin-1')} " for k in range(last + 1)} if found else set()


def write_patterns(benchmark: DataFrame, item: str, item_text: str, size: int, block_chars: int) -> tuple[str, int]:
    """Write patterns and the items that have them, in blocks of about ``block_chars``; returns the path and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch["item"].to_pylist(), batch["text"]):
                found = list(windows(text.as_py(), size))
                yield pa.RecordBatch.from_pydict({"pattern": pa.array(found, pa.string()), "item": pa.array([name] * len(found), pa.string())})

    listed = benchmark.select(
        F.coalesce(benchmark[item].cast("string"), F.lit("")).alias("item"), benchmark[item_text].cast("string").alias("text")
    )
    pairs = stored(listed.mapInArrow(run, "pattern string, item string").distinct(), "benchmark-windows")
    patterns, chars = pairs.select("pattern").distinct().agg(F.count("*"), F.sum(F.length("pattern"))).first()
    blocks = min(patterns, -(-(chars or 0) // block_chars))
    path = scratch_path(benchmark.sparkSession, "benchmark-blocks")
    if blocks:
        numbered = pairs.withColumn("block", F.pmod(F.xxhash64("pattern"), F.lit(blocks)).cast("int"))
        numbered.repartition(blocks, "block").write.partitionBy("block").parquet(path)
    return path, blocks


def _automaton(path: str, block: int) -> ahocorasick.Automaton | None:
    """The automaton of one block of patterns; none where hashes left the block empty."""
    name = f"{path}/block={block}"
    if name not in _automata:
        _automata.clear()
        system, root = file_system(name)
        found: dict[str, list[str]] = {}
        for file in system.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if file.base_name.endswith(".parquet"):
                with system.open_input_file(file.path) as source:
                    rows = pq.ParquetFile(source).read(["pattern", "item"])
                for pattern, item in zip(rows["pattern"].to_pylist(), rows["item"].to_pylist()):
                    found.setdefault(pattern, []).append(item)
        machine = None
        if found:
            machine = ahocorasick.Automaton()
            for pattern, items in found.items():
                machine.add_word(pattern, (pattern.count(" ") - 1, items))
            machine.make_automaton()
        _automata[name] = machine
    return _automata[name]


def scan(raw: bytes, machine: ahocorasick.Automaton, ranges: list[tuple[int, int]]) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of a text, the runs of words that are hit (added to earlier ``ranges``), and the items found."""
    found = raw.translate(NORMAL).split()
    normal = (b" " + b" ".join(found) + b" ").decode("latin-1")
    hits = list(machine.iter(normal))
    if not hits:
        return len(found), ranges, set()
    breaks = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), dtype=np.uint8) == 32)
    lasts = np.searchsorted(breaks, [end for end, _ in hits]).tolist()
    added = [(last - length, last) for last, (_, (length, _)) in zip(lasts, hits)]
    merged: list[tuple[int, int]] = []
    for begin, end in sorted([*ranges, *added]):
        if merged and begin <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((begin, end))
    return len(found), merged, {item for _, (_, items) in hits for item in items}


def original_spans(raw: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Where runs of words lie in the original text, in code points."""
    solid = np.frombuffer(raw.translate(NORMAL), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    points = np.cumsum(np.concatenate([[0], (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80]))
    return [{"start": int(points[edges[2 * a]]), "end": int(points[edges[2 * b - 1]])} for a, b in ranges]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Each row as ``row`` (its columns ``keep``, or all), with ``n_words``, ``n_hit``, ``items`` and ``spans``.

    ``items`` are the sorted ids (as strings) of the items that have a window in the text, ``spans`` the stretches of hit
    words in the original text.  The benchmark is divided into blocks, each an automaton of bounded size; a larger benchmark
    means that texts, some megabytes at a time, meet more automata within the same task, without a shuffle.  Null and empty
    texts have no words, items without words no windows; an item without id counts under the empty id, repeated items once.
    Repeated rows get equal results; without a benchmark nothing is hit; an empty table gives no rows.
    """
    kept = docs.columns if keep is None else keep
    row = F.struct(*(docs[name] for name in kept)).alias("row") if kept else F.struct(F.lit(0).alias("none")).alias("row")
    chosen = docs.select(row, docs[text].cast("string").alias("text"))
    out = chosen.select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast("array<struct<start:long,end:long>>").alias("spans"),
    )
    path, blocks = write_patterns(benchmark, item, item_text, window, block_chars)
    schema = to_arrow_schema(out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_in_blocks(batches, "text", TEXT_BYTES):
            texts = rows["text"].cast(pa.large_binary())
            n_words = [0] * len(texts)
            ranges: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
            items: list[set[str]] = [set() for _ in range(len(texts))]
            machines = (_automaton(path, block) for block in range(blocks))
            for machine in machines if blocks else [None]:
                for k, value in enumerate(texts):
                    raw = value.as_py() or b""
                    if machine is None:
                        n_words[k] = len(raw.translate(NORMAL).split())
                        continue
                    n_words[k], ranges[k], found = scan(raw, machine, ranges[k])
                    items[k] |= found
            spans = [original_spans(value.as_py() or b"", own) if own else [] for value, own in zip(texts, ranges)]
            columns = {
                "row": rows["row"],
                "n_words": pa.array(n_words, pa.int64()),
                "n_hit": pa.array([sum(b - a for a, b in own) for own in ranges], pa.int64()),
                "items": pa.array([sorted(own) for own in items], schema.field("items").type),
                "spans": pa.array(spans, schema.field("spans").type),
            }
            yield from pa.table(columns).to_batches()

    return chosen.mapInArrow(run, out.schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose text has no window of the benchmark, unchanged."""
    return find_contamination(docs, benchmark, **options).where("n_hit = 0").select("row.*")
