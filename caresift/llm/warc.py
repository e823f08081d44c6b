"""WARC archives: an index first, then coalesced byte-range reads.

Writing: every task writes gzip-per-record archives and returns one index row
per record (file, offset, length, URL, digest). Reading: the records wanted are
selected on the index alone; what is left is cut into blocks of a file, sorted by offset, and
neighbouring ranges are fetched with one read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.llm.store import BYTES_PER_TASK, new_file, new_folder, open_store, tasks_for
from caresift.llm.tables import narrow, read
from caresift.session import materialize

#: An archive file is closed when it has grown to this size.
FILE_BYTES = 1 << 30
#: Records at most this far apart are fetched by one read.
MAX_GAP = 64 << 10
RECORD_URN = "urn:caresift:page:"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX_SCHEMA = (
    "file string, offset long, length long, page_id long, url string, payload_digest string, record_type string"
)
RECORD_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload string, file string, offset long, length long"
)


def record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``refers_to``: the smallest page_id with an equal payload of at least ``min_bytes`` bytes.

    It is null where the row is itself the response. Payloads are equal if length and SHA-1 are. The
    table of repeated payloads holds digests only and is written before the
    join, so that both sides of the join are plain shuffles and a payload
    that a third of all rows share is split by the skew join. Rows that repeat the smallest page_id are
    responses too; a null page_id is never referred to, and revisits where another row has an id.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.withColumns({"sha": F.sha1(body.cast("binary")), "size": F.octet_length(body).cast("long")})
    repeated = (
        keyed.where(F.col("size") >= min_bytes)
        .groupBy(F.col("sha").alias("r_sha"), F.col("size").alias("r_size"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("r_sha", "r_size", "first_id")
    )
    repeated = materialize(repeated, "warc-repeated")
    same = (F.col("sha") == F.col("r_sha")) & (F.col("size") == F.col("r_size"))
    is_first = F.col("page_id").eqNullSafe(F.col("first_id"))
    return keyed.join(repeated, same, "left").select(
        "page_id", "url", "html", F.when(~is_first, F.col("first_id")).alias("refers_to")
    )


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Control characters and blanks percent-encoded, so that a value stays on its line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _urn(page_id: int | None) -> str:
    return f"<{RECORD_URN}{'null' if page_id is None else page_id}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member of its own."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_urn(page_id)}"]
    lines.append("WARC-Date: 1970-01-01T00:00:00Z")
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    body = http + payload if refers_to is None else http
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    lines.append(f"Content-Length: {len(body)}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    pairs = (line.partition(": ") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value for name, _, value in pairs}, rest


def _id_of(urn: str | None) -> int | None:
    text = (urn or "null").strip("<>").removeprefix(RECORD_URN)
    return None if text == "null" else int(text)


def decode_record(member: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, rest = _headers(zlib.decompress(member, 31))
    http, payload = _headers(rest[: int(head["content-length"])])
    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and payload_digest(payload) != digest:
        raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
    return {
        "page_id": _id_of(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _id_of(head.get("warc-refers-to")),
        "payload_bytes": len(payload) if kind == "response" else int(http["content-length"]),
        "payload_digest": digest,
        "payload": payload.decode() if kind == "response" else None,
    }


def write_archives(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) and returns the index, itself stored.

    A null html is an empty payload, a null url leaves the header out, a null
    page_id is kept as null. An empty table writes no archive and gives an empty index. Other
    columns are ignored.
    """
    import pyarrow as pa

    typed = record_types(narrow(pages, page_id="page_id", url="url", html="html"), min_bytes)
    folder = new_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, out, name, offset = None, None, None, 0
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                page_id, url, html, refers_to = (batch.column(k)[i].as_py() for k in range(4))
                payload = (html or "").encode()
                digest = payload_digest(payload)
                member = encode_record(page_id, url, payload, digest, refers_to)
                if out is None or offset >= file_bytes:
                    if out is not None:
                        out.close()
                    name, offset = new_file(folder, ".warc.gz"), 0
                    store, path = open_store(name)
                    out = store.open_output_stream(path, compression=None)
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                rows.append((name, offset, len(member), page_id, url, digest, kind))
                offset += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(index_types)], names=index_names
            )
        if out is not None:
            out.close()

    index_names = [c.split()[0] for c in INDEX_SCHEMA.split(", ")]
    index_types = [pa.int64() if c.endswith("long") else pa.string() for c in INDEX_SCHEMA.split(", ")]
    return materialize(typed.mapInArrow(write, INDEX_SCHEMA), "warc-index")


def _ranges(rows: list[tuple[int, int]], max_gap: int, max_bytes: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Sorted (offset, length) pairs joined into (start, end, members) reads."""
    start = end = None
    members: list[tuple[int, int]] = []
    for offset, length in rows:
        if members and (offset - end > max_gap or offset + length - start > max_bytes):
            yield start, end, members
            members = []
        if not members:
            start = offset
        end = offset + length
        members.append((offset, length))
    if members:
        yield start, end, members


def read_records(
    index: DataFrame, max_gap: int = MAX_GAP, block_bytes: int = BYTES_PER_TASK, payloads: bool = True
) -> DataFrame:
    """The records that the rows of ``index`` point at (any selection of a written index).

    A file is cut into blocks by offset, so that one large archive is read by
    many tasks; the number of tasks follows the bytes selected. With ``payloads`` false the
    text is checked against its digest but not returned.
    """
    import pyarrow as pa

    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
    types = [pa.int64() if c.endswith("long") else pa.string() for c in RECORD_SCHEMA.split(", ")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, offsets, lengths = (batch.column(k).to_pylist() for k in range(3))
            for name in dict.fromkeys(files):
                spans = [(o, n) for f, o, n in zip(files, offsets, lengths) if f == name]
                store, path = open_store(name)
                with store.open_input_file(path) as stream:
                    for start, end, members in _ranges(spans, max_gap, block_bytes):
                        stream.seek(start)
                        block = stream.read(end - start)
                        rows = []
                        for o, n in members:
                            got = decode_record(block[o - start : o - start + n])
                            if not payloads:
                                got["payload"] = None
                            rows.append(got | {"file": name, "offset": o, "length": n})
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names=names
                        )

    wanted = index.select("file", "offset", "length", F.floor(F.col("offset") / block_bytes).alias("block"))
    placed = wanted.repartition(tasks_for(wanted, "length", block_bytes), "file", "block")
    return placed.sortWithinPartitions("file", "offset").select("file", "offset", "length").mapInArrow(fetch, RECORD_SCHEMA)


def op1_warc(spark, sf_dir: str) -> DataFrame:
    """A record per page written and read back: who is a response, who revisits which page."""
    index = write_archives(read(spark, sf_dir, "pages"))
    return read_records(index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
