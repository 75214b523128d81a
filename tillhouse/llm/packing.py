"""Packing token sequences: cost-balanced, in blocks.

The cost of a piece is linear in its tokens plus quadratic, as attention is.  Documents longer than a sequence fill whole
sequences by themselves; what is left of each is placed in descending order of length into the sequence of lowest cost
that still has room for all of it.  A block gets as few sequences as hold its tokens, so at last a piece may fit nowhere:
it is cut and fills the sequences with most room.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer as FileTokenizer

from tillhouse.llm.blocks import rows_in_blocks

CAPACITY = 2048
LINEAR, QUADRATIC = 1.0, 1.0 / 2048
END_ID = 1
BLOCK_BYTES = 8 << 20  # text packed together
SLICE = 1 << 20  # characters tokenized together; a longer text is cut where no token can lie across
# The split that byte-level tokenizers make before merging (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CUT = re.compile(r"(?<=\S) (?=\S)")


class Tokenizer:
    """Ids of texts as the file's byte-level BPE gives them.

    The merging is done by tiktoken, whose ranks are the file's ids; it takes a fraction of the time of the library that
    wrote the file.  That gives the same ids as long as the file does nothing else, which is checked: no normalizer, the split
    of byte-level tokenizers, plain BPE, and merges in the order of the ids that they make.  Texts that hold a special token
    go to that library.

    Such a tokenizer splits a text before it merges, and never merges across a single space between two characters that are
    no white space, so a long text is cut before such spaces.
    """

    def __init__(self, path: str):
        self.file = FileTokenizer.from_file(path)
        found = json.loads(self.file.to_str())
        split, model = found["pre_tokenizer"] or {}, found["model"]
        if split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or found["normalizer"]:
            raise ValueError(f"{path} is no byte-level tokenizer of texts as they are")
        extras = "dropout unk_token continuing_subword_prefix end_of_word_suffix byte_fallback ignore_merges".split()
        made = [model["vocab"]["".join(merge if isinstance(merge, list) else merge.split(" "))] for merge in model["merges"]]
        if model["type"] != "BPE" or any(model.get(name) for name in extras) or made != sorted(made):
            raise ValueError(f"{path} holds more than merges in the order of their ids")
        self.special = [token.content for token in self.file.get_added_tokens_decoder().values()]
        of_byte = {char: byte for byte, char in _byte_chars().items()}
        ranks = {
            bytes(of_byte[char] for char in token): number
            for token, number in self.file.get_vocab(with_added_tokens=False).items()
            if token not in self.special
        }
        self.merges = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for text in texts:
            if any(token in text for token in self.special):
                yield np.array(self.file.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
            elif len(text) <= SLICE:
                yield np.array(self.merges.encode_ordinary(text), dtype=np.uint32)
            else:
                parts = [np.array(self.merges.encode_ordinary(part), dtype=np.uint32) for part in _parts(text, SLICE)]
                yield np.concatenate(parts)


def _parts(text: str, least: int) -> Iterator[str]:
    """The text cut before single spaces between other characters, in parts of at least so many characters but for the last."""
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + least)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def _byte_chars() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte: itself if it is printable, else the next free one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + k) for k, byte in enumerate(rest)}


def place(lengths: np.ndarray, capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of all pieces; sequences are numbered from 0."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    for k in np.flatnonzero(lengths >= capacity).tolist():
        for start in range(0, int(lengths[k]) - capacity + 1, capacity):
            pieces.append((k, start, capacity, sequences, 0))
            sequences += 1
    rest = lengths % capacity
    room = np.full(-(-int(rest.sum()) // capacity), capacity, dtype=np.int64)
    cost = np.zeros(len(room))

    def put(document: int, start: int, length: int, into: int) -> None:
        pieces.append((document, start, length, sequences + into, capacity - int(room[into])))
        room[into] -= length
        cost[into] += linear * length + quadratic * length * length

    for k in np.argsort(-rest, kind="stable").tolist():
        start, left = int(lengths[k] - rest[k]), int(rest[k])
        while left:
            fitting = np.flatnonzero(room >= left)
            into = int(fitting[np.argmin(cost[fitting])] if len(fitting) else np.argmax(room))
            length = min(left, int(room[into]))
            put(k, start, length, into)
            start, left = start + length, left - length
    return pieces


_tokenizers: dict[str, Tokenizer] = {}  # in each worker, by path


def pack_texts(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    end_id: int = END_ID,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per piece: the key, ``start``, ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``.

    A document's ids are those of the tokenizer file, which each executor must have at the path, then ``end_id``.  Each id
    lies in one piece.  Blocks of rows are packed by themselves, in their partition, so nothing is shuffled and less than
    one sequence per block is padding.  Null and empty texts have the end id alone; repeated rows are packed as often as
    they occur, rows without key like others; an empty table gives no rows.  Other columns are ignored.
    """
    kind = docs.schema[key].dataType
    key_type = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizers.setdefault(tokenizer, None) or Tokenizer(tokenizer)
        _tokenizers[tokenizer] = own
        next_id = TaskContext.get().partitionId() << 33
        for rows in rows_in_blocks(batches, "text", block_bytes):
            texts = [value or "" for value in rows["text"].to_pylist()]
            ids = [np.append(found, np.uint32(end_id)) for found in own.encode(texts)]
            pieces = place(np.array([len(found) for found in ids], dtype=np.int64), capacity, linear, quadratic)
            document, start, length, sequence, offset = np.array(pieces, dtype=np.int64).reshape(-1, 5).T
            yield from pa.table(
                {
                    "key": rows["key"].cast(key_type).take(pa.array(document)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids": pa.array([ids[k][a : a + n].astype("<u4").tobytes() for k, a, n, _, _ in pieces], pa.binary()),
                    "doc_tokens": pa.array(np.array([len(found) for found in ids], dtype=np.int64)[document]),
                    "sequence_id": pa.array(sequence + next_id),
                    "offset": pa.array(offset),
                }
            ).to_batches(max_chunksize=10_000)
            next_id += int(sequence.max()) + 1

    chosen = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    schema = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return chosen.mapInArrow(run, f"key {kind.simpleString()}, {schema}").withColumnRenamed("key", key)
