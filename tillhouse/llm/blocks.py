"""Inside tasks: reaching shared files, cutting Arrow batches into blocks of texts, and hashing their words with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs as pafs

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ROW_BYTES = 64  # what a row counts for besides its text, so that short and empty texts fill blocks as well
SLICE_BYTES = 2 << 20  # bytes hashed at a time: numpy's intermediate arrays take about fifty times as much

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a folder, and the folder's path there."""
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CODES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def powers(count: int) -> np.ndarray:
    out = np.full(count, _BASE, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def rows_in_blocks(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """The rows in order, in tables of at most ``limit`` bytes, ``ROW_BYTES`` a row and its text; one larger row makes a table of its own."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        lengths = pa.compute.fill_null(pa.compute.binary_length(rows[text]), 0).to_numpy()
        at = 0
        for k, length in enumerate((lengths + ROW_BYTES).tolist()):
            if size and size + length > limit:
                held.append(rows.slice(at, k - at))
                yield pa.concat_tables(held).combine_chunks()
                held, size, at = [], 0, k
            size += length
        held.append(rows.slice(at))
    if held and sum(part.num_rows for part in held):
        yield pa.concat_tables(held).combine_chunks()


def raw_texts(rows: pa.Table, text: str) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in a row, nulls as empty, and where each text begins and ends."""
    column = rows[text].cast(pa.large_binary()).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    column = pa.compute.fill_null(column, b"")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z as a-z, in order, and the number of words of each text."""
    hashes, starts = [], []
    at = 0
    while at < len(data):
        stop = min(at + SLICE_BYTES, len(data))
        while stop < len(data) and not SPACE[data[stop]]:  # a word is never cut
            gap = np.flatnonzero(SPACE[data[stop : stop + 4096]])
            stop = stop + int(gap[0]) if len(gap) else min(stop + 4096, len(data))
        own = ends[np.searchsorted(ends, at) : np.searchsorted(ends, stop)] - at
        found, begins = _slice_hashes(data[at:stop], own)
        hashes.append(found)
        starts.append(begins + at)
        at = stop
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(ends) - 1, dtype=np.int64)
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(starts), ends))


def _slice_hashes(data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    solid = ~SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    begins[text_starts] = solid[text_starts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    at = np.flatnonzero(solid)
    word = np.cumsum(begins)[at] - 1
    place = at - starts[word]
    terms = CODES[LOWER[data[at]]] * powers(int(place.max()) + 1)[place]
    first = np.flatnonzero(place == 0)
    lengths = np.diff(np.append(first, len(at))).astype(np.uint64)
    return mix(np.add.reduceat(terms, first) + lengths * _STEP), starts
