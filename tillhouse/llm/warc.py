"""WARC archives: written record by record, indexed first, and read back by coalesced byte ranges.

Every record is a gzip member of its own, as is usual, so a record can be read alone, given its offset and length.
Archives lie in a folder that all executors reach, by any file system that Arrow knows (local or mounted, HDFS, S3).  Each
task attempt writes files of its own names and returns the index of what it wrote; Spark keeps the index of the attempts
that succeeded, so files of lost attempts are never looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tillhouse.functions.materialize import stored
from tillhouse.llm.blocks import file_system

LEAST_REVISIT = 1000  # bytes of a payload from which copies are revisit records
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20  # at most read at once, unless one record is longer
TASK_BYTES = 32 << 20  # of records for each reading task
GAP_BYTES = 64 << 10  # bytes between two wanted records that are rather read than skipped
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "archive string, offset long, length long, url string, digest string, record_id string, record_type string"
)
RECORD = "record_id string, record_type string, refers_to string, url string, digest string, payload_bytes long, payload binary"


def with_record_types(pages: DataFrame, page: str = "page_id", body: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Each row as ``row``, with its ``digest`` (SHA-1 of the payload) and ``refers_to``, null for responses.

    Digests are counted on their own; only those that occur more than once are stored, with their largest page, and joined.
    Spark sees the size of what is stored, and moves the pages only if that is too much to broadcast; a frequent payload is
    then a skewed key with one row on the other side, which adaptive execution splits.
    """
    payload = F.coalesce(pages[body].cast("string"), F.lit("")).cast("binary")
    copies = (
        pages.where(F.octet_length(payload) >= least)
        .groupBy(F.sha1(payload).alias("digest"))
        .agg(F.max(pages[page]).alias("keeper"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "keeper")
    )
    copies = stored(copies, "repeated-payloads")
    row = F.struct(*(pages[name] for name in pages.columns)).alias("row")
    whole = pages.select(row, F.sha1(payload).alias("digest"))
    later = F.when(~F.col("row")[page].eqNullSafe(F.col("keeper")), F.col("keeper"))
    return whole.join(copies, "digest", "left").select("row", "digest", later.alias("refers_to"))


def _fields(pairs: list[tuple[str, str | None]]) -> bytes:
    return b"".join(f"{name}: {value}\r\n".encode() for name, value in pairs if value is not None)


def _uri(record: str | None) -> str:
    return f"<urn:page:{quote(record or '', safe='')}>"


def record_bytes(record: str | None, url: str | None, digest: str, payload: bytes, refers_to: str | None, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))])
    block = http + b"\r\n" + (payload if refers_to is None else b"")
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _uri(record)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="%/:?#[]@!$&'()*+,;=~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else _uri(refers_to)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of ``RECORD`` from the bytes of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")

    def record(uri: str | None) -> str | None:
        return unquote(uri.removeprefix("<urn:page:").removesuffix(">")) or None if uri else None

    return {
        "record_id": record(fields["WARC-Record-ID"]),
        "record_type": fields["WARC-Type"],
        "refers_to": record(fields.get("WARC-Refers-To")),
        "url": fields.get("WARC-Target-URI"),
        "digest": digest,
        "payload_bytes": size,
        "payload": payload if response else None,
    }


def write_archives(
    pages: DataFrame,
    folder: str,
    page: str = "page_id",
    url: str = "url",
    body: str = "html",
    least: int = LEAST_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write a record per row to archives below ``folder``; the index (``INDEX``) is the result and must be stored at once.

    Of rows with equal payloads of at least ``least`` bytes, those with the largest page id are responses, the others revisit
    records without payload; rows that repeat the largest id are all responses, and so are all rows if no id is there.  Null
    bodies are empty payloads, null urls are left out.  An empty table writes nothing.  Other columns are ignored.
    """
    chosen = pages.select(pages[page].alias("page"), pages[url].cast("string").alias("url"), pages[body].cast("string").alias("body"))
    typed = with_record_types(chosen, "page", "body", least).select(
        F.col("row.page").cast("string").alias("page"),
        "row.url",
        F.coalesce("row.body", F.lit("")).cast("binary").alias("body"),
        "digest",
        F.col("refers_to").cast("string").alias("refers_to"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, root = file_system(folder)
        system.create_dir(root, recursive=True)
        out, at, number = None, 0, 0
        for batch in batches:
            index: list[dict] = []
            for values in zip(*(batch[name] for name in ("page", "url", "digest", "body", "refers_to"))):
                record, address, digest, payload, refers_to = (value.as_py() for value in values)
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name = f"{context.partitionId():06d}-{number:04d}-{context.taskAttemptId()}.warc.gz"
                    out, at, number = system.open_output_stream(f"{root}/{name}", compression=None), 0, number + 1
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = packer.compress(record_bytes(record, address, digest, payload, refers_to, date)) + packer.flush()
                out.write(data)
                kind = "response" if refers_to is None else "revisit"
                index.append(dict(zip(_names(INDEX), (name, at, len(data), address, digest, record, kind))))
                at += len(data)
            yield pa.RecordBatch.from_pylist(index, schema=_arrow(INDEX))
        if out is not None:
            out.close()

    return typed.mapInArrow(run, INDEX)


_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(part.split()[0], _ARROW[part.split()[1]]) for part in ddl.split(", ")])


def coalesced(rows: Iterator[tuple[str, int, int]], most: int, gap: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Byte ranges (archive, offset, length, records inside) of sorted records that lie close together."""
    archive, begin, end, inside = None, 0, 0, []
    for name, offset, length in rows:
        if inside and (name != archive or offset - end > gap or max(end, offset + length) - begin > most):
            yield archive, begin, end - begin, inside
            inside = []
        if not inside:
            archive, begin, end = name, offset, offset
        inside.append((offset - begin, length))
        end = max(end, offset + length)
    if inside:
        yield archive, begin, end - begin, inside


def read_records(
    index: DataFrame, folder: str, payload: bool = True, most: int = RANGE_BYTES, gap: int = GAP_BYTES
) -> DataFrame:
    """The records (``RECORD``) that the rows of ``index`` point to; without ``payload`` that column is null.

    Index rows are sorted by archive and offset over tasks, and each task reads stretches of an archive at once.  A row that
    occurs twice is read twice; an empty index gives no rows.
    """
    wanted = index.select("archive", "offset", "length")
    tasks = -(-(wanted.agg(F.sum("length")).first()[0] or 1) // TASK_BYTES)  # by what is read: the index itself is small
    ordered = wanted.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        rows = (row for batch in batches for row in zip(*(batch[k].to_pylist() for k in range(3))))
        opened, source = None, None
        for archive, begin, length, inside in coalesced(rows, most, gap):
            if archive != opened:
                opened, source = archive, system.open_input_file(f"{root}/{archive}")
            data = source.read_at(length, begin)
            found = [parse_record(zlib.decompress(data[a : a + n], 31)) for a, n in inside]
            if not payload:
                found = [record | {"payload": None} for record in found]
            yield pa.RecordBatch.from_pylist(found, schema=_arrow(RECORD))

    return ordered.mapInArrow(run, RECORD)
