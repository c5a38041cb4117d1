"""WARC archives: write with an index, read back by coalesced byte ranges.

``write_archives`` writes one gzip member per record into rolling
``.warc.gz`` files of bounded size and returns the index: file, offset,
length, URL and payload digest of every record.  A task names its files
uniquely and the index (a Parquet table, committed by Spark) lists only those
of the attempts that succeeded, so a lost executor leaves at most a file that
nothing refers to.  ``read_records`` takes any selection of index rows, sorts
them by place, joins neighbouring ranges into one read each and parses the
records.

Of records with equal payloads of at least ``min_revisit_bytes`` the one with
the largest page id is the response and the others are revisits that refer to
it; their block keeps the HTTP header (with the payload's length), not the
payload.

Defined cases: a null payload counts as empty; a null URL is left out; line
breaks in a URL are percent-encoded; a null page id is smaller than any other
and stays null; repeated rows of the response's page id are responses too; an
empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import materialize
from parcelkit.session import scratch_path

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
#: Ranges that lie this close are read at once, up to READ_BYTES.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
#: Archive bytes that one reading task gets.
TASK_BYTES = 128 << 20

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = ("file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, "
          "record_type string, refers_to bigint")
_RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint")


def _file_system(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields if v is not None]
    return b"\r\n".join(lines) + b"\r\n\r\n"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 revisit: bool, date: str) -> bytes:
    """One record; a revisit's block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = None if url is None else re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
    head = _header([
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Refers-To", _urn(refers_to) if revisit else None),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))])
    return head + block + b"\r\n\r\n"


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def assign_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
                 min_revisit_bytes: int) -> DataFrame:
    """(page_id, url, payload, payload_digest, record_type, refers_to).

    Only digests that repeat are kept in the lookup (counted with partial
    sums), as a written table: where it is small Spark broadcasts it by its
    size on disk and payloads are never shuffled; else it is a sort-merge join
    whose hot digests AQE splits."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("payload_digest"))
    repeated = (rows.where(F.octet_length("payload") >= min_revisit_bytes)
                .groupBy("payload_digest").agg(F.max("page_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
                .where("_n > 1 AND _response IS NOT NULL").drop("_n"))
    repeated, _ = materialize(repeated, "warc-digests")
    revisit = F.col("_response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    return (rows.join(repeated, "payload_digest", "left")
            .select("page_id", "url", "payload", "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("_response")).alias("refers_to")))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES,
                   file_bytes: int = FILE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives below ``folder`` and return their index (already
    written, so reading it never writes an archive again)."""
    records = assign_types(pages, id_col, url_col, payload_col, min_revisit_bytes)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            places = []
            for row in batch.to_pylist():
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    info = b"software: parcelkit\r\nformat: WARC File Format 1.1\r\n"
                    first = _member(_header([
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                        ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
                        ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n")
                    out.write(first)
                    at = len(first)
                member = _member(record_bytes(row["page_id"], row["url"], row["payload"], row["payload_digest"],
                                              row["refers_to"], row["record_type"] == "revisit", date))
                out.write(member)
                places.append((name, at, len(member)))
                at += len(member)
            files, offsets, lengths = zip(*places, strict=True) if places else ((), (), ())
            kept = [batch.column(c) for c in ("page_id", "url", "payload_digest", "record_type", "refers_to")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()), *kept],
                ["file", "offset", "length", "page_id", "url", "payload_digest", "record_type", "refers_to"])
        if out is not None:
            out.close()

    return materialize(records.mapInArrow(write, _INDEX), "warc-index")[0]


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits else None


def parse_record(raw: bytes) -> dict:
    """Fields of one uncompressed record; digest and length of a response are
    taken from the payload itself and must agree with the header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": _page(fields.get("WARC-Refers-To")),
            "payload": payload}


def coalesce_ranges(places: Iterator[tuple[str, int, int]], gap: int = GAP_BYTES,
                    most: int = READ_BYTES) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Join sorted (file, offset, length) into (file, start, stop, members)."""
    file, start, stop, members = None, 0, 0, []
    for name, offset, length in places:
        if members and (name != file or offset - stop > gap or offset + length - start > most):
            yield file, start, stop, members
            members = []
        if not members:
            file, start = name, offset
        members.append((offset, length))
        stop = offset + length
    if members:
        yield file, start, stop, members


def read_records(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the given index rows: page_id, url, payload_bytes,
    payload_digest, record_type, refers_to (and payload)."""
    # Tasks are counted by the bytes to read, not by the size of the index rows that say where.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    stretch = F.floor(F.col("offset") / F.lit(READ_BYTES))
    places = (index.select("file", "offset", "length").repartition(tasks, "file", stretch)
              .sortWithinPartitions("file", "offset"))
    schema = _RECORD + (", payload binary" if payloads else "")
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(folder)
        rows = ((r["file"], r["offset"], r["length"]) for b in batches for r in b.to_pylist())
        opened, handle = None, None
        for file, start, stop, members in coalesce_ranges(rows):
            if file != opened:
                if handle is not None:
                    handle.close()
                opened, handle = file, fs.open_input_file(f"{base}/{file}")
            handle.seek(start)
            data = handle.read(stop - start)
            found = [parse_record(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in members]
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in names} for r in found], schema=arrow)
        if handle is not None:
            handle.close()

    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in schema.split(", ")])
    return places.mapInArrow(read, schema)


def archive_folder(spark) -> str:
    """A new folder for archives in the shared checkpoint folder."""
    return scratch_path(spark, "warc")
