"""WARC archives: writing whole-file gzip streams, normalising them to one gzip member a record, reading.

*Writing* packs rows into WARC/1.1 files, each compressed as one gzip stream (the monolithic form
that cannot be read at random). Of records with equal payloads of at least ``least`` bytes the one
with the smallest identifier is a ``response``; the others are ``revisit`` records that name it and
carry no payload.

*Normalising* inflates such a file once, front to back in bounded pieces, and writes every record
again as a gzip member of its own. A sidecar holds one line a record: offset and length of the
member, record id, type, payload length and digest. With it a single record is one seek and one
small inflation.

*Reading* follows the sidecar; the payload of a response is checked against its digest.

A file is one task's work and is closed at ``FILE_BYTES`` of payload, so tasks stay even. File
names come from the task's partition, and files are moved into place whole: a task that runs twice
leaves one file. Lists of files are tables, never driver lists.

Defined results: a null payload is empty; a null identifier sorts after all others; rows with equal
identifier and payload: the first read is the response; very large payloads get a file of their own.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import numbered, quoted, shuffle_partitions, smallest_of_group
from riskloom.llm.files import fetch, opened, publish
from riskloom.session import scratch_path, written_once

FILE_BYTES = 16 << 20
PIECE = 1 << 20
FILES = "path string, records long"
RECORDS = (
    "record_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "uri string, payload binary"
)


def header(kind: str, number: str, uri: str, fields: list[tuple[str, str]], length: int) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:row:{number}>", f"WARC-Target-URI: {uri}"]
    lines += [f"{k}: {v}" for k, v in fields]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {length}", "", ""]
    return "\r\n".join(lines).encode()


def one_line(text: str | None) -> str:
    """A header value must not hold line breaks; they are written as percent escapes."""
    return (text or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def record(row: dict) -> bytes:
    number = "null" if row["id"] is None else str(row["id"])
    fields = [("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("WARC-Payload-Length", str(row["n_bytes"]))]
    body = b""
    if row["refers_to"] is None:
        body = (row["payload"] or "").encode("utf-8")
        kind = "response"
    else:
        kind = "revisit"
        fields.append(("WARC-Refers-To", f"<urn:row:{row['refers_to']}>"))
    return header(kind, number, one_line(row["uri"]), fields, len(body)) + body + b"\r\n\r\n"


def write_monolithic(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``rows`` (id, uri, payload, digest, n_bytes, refers_to) as whole-file gzip streams: (path, records)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        stream, out, size, count = zlib.compressobj(6, zlib.DEFLATED, 31), [], 0, 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    data = record(row)
                    out.append(stream.compress(data))
                    size, count = size + len(data), count + 1
                    if size >= FILE_BYTES:
                        path = f"{folder}/{part:06d}-{number:05d}.warc.gz"
                        publish(path, b"".join([*out, stream.flush()]))
                        yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})
                        stream, out, size, count = zlib.compressobj(6, zlib.DEFLATED, 31), [], 0, 0
                        number += 1
        if count:
            path = f"{folder}/{part:06d}-{number:05d}.warc.gz"
            publish(path, b"".join([*out, stream.flush()]))
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    return rows.mapInArrow(work, FILES)


def inflated(path: str) -> Iterator[bytes]:
    """The file's content in bounded pieces. Files of several members are read through as well."""
    store, name = opened(path)
    with store.open_input_stream(name, compression=None) as source:
        inflater = zlib.decompressobj(31)
        while piece := source.read(PIECE):
            while piece:
                yield inflater.decompress(piece, PIECE)
                piece = inflater.unconsumed_tail
                if inflater.eof:
                    piece = inflater.unused_data
                    inflater = zlib.decompressobj(31)
        yield inflater.flush()


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict, bytes, bytes]]:
    """(header fields, head, body) of each record of an inflated archive."""
    held = bytearray()
    head, fields, need = None, {}, 0
    for piece in pieces:
        held += piece
        at = 0
        while True:
            if head is None:
                end = held.find(b"\r\n\r\n", at)
                if end < 0:
                    break
                head = bytes(held[at : end + 4])
                lines = head.decode("utf-8").split("\r\n")
                fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
                need, at = int(fields["Content-Length"]), end + 4
            if len(held) - at < need + 4:
                break
            yield fields, head, bytes(held[at : at + need])
            at += need + 4
            head = None
        del held[:at]
    if head is not None or bytes(held).strip():
        raise ValueError("the archive ends inside a record")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite every archive of ``files`` (path) with a member a record and a sidecar: (path, records)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                target = f"{folder}/{path.rpartition('/')[2]}"
                out, lines, offset = [], [], 0
                for fields, head, body in parsed(inflated(path)):
                    stream = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = stream.compress(head + body + b"\r\n\r\n") + stream.flush()
                    lines.append(
                        json.dumps(
                            {
                                "offset": offset,
                                "length": len(member),
                                "record": fields["WARC-Record-ID"],
                                "type": fields["WARC-Type"],
                                "payload_bytes": int(fields.get("WARC-Payload-Length", len(body))),
                                "digest": fields.get("WARC-Payload-Digest"),
                            }
                        )
                    )
                    out.append(member)
                    offset += len(member)
                publish(f"{target}.index", "\n".join(lines).encode())
                publish(target, b"".join(out))
                yield pa.RecordBatch.from_pydict({"path": [target], "records": [len(lines)]})

    return files.mapInArrow(work, FILES)


def number_of(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:row:").removesuffix(">")
    return None if text in ("", "null") else int(text)


def read_record(store, path: str, offset: int, length: int) -> tuple[dict, bytes]:
    """One record by its place, without touching the rest of the file."""
    with store.open_input_file(path) as source:
        source.seek(offset)
        data = zlib.decompress(source.read(length), 31)
    fields, _, body = next(parsed(iter([data])))
    return fields, body


def read_normalised(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Every record of the normalised archives of ``files`` (path), found by their sidecars."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                data = memoryview(fetch(path))
                rows = []
                for line in fetch(f"{path}.index").decode().splitlines():
                    entry = json.loads(line)
                    member = data[entry["offset"] : entry["offset"] + entry["length"]]
                    fields, _, body = next(parsed(iter([zlib.decompress(member, 31)])))
                    size, digest = int(fields["WARC-Payload-Length"]), fields["WARC-Payload-Digest"][7:]
                    if fields["WARC-Type"] == "response":
                        size, found = len(body), hashlib.sha256(body).hexdigest()
                        if found != digest:
                            raise ValueError(f"a payload in {path} does not match its digest")
                    uri = fields["WARC-Target-URI"].replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")
                    kept = body if payloads and fields["WARC-Type"] == "response" else None
                    rows.append(
                        (number_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"],
                         number_of(fields.get("WARC-Refers-To")), uri, kept)
                    )
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return files.mapInArrow(work, RECORDS)


def with_roles(df: DataFrame, id_col: str, uri_col: str, payload_col: str, least: int) -> DataFrame:
    """Rows ready to be written: id, uri, payload, digest, n_bytes, refers_to."""
    payload = F.coalesce(quoted(payload_col).cast("string"), F.lit(""))
    rows = numbered(
        df.select(
            quoted(id_col).alias("id"),
            quoted(uri_col).alias("uri"),
            payload.alias("payload"),
            F.sha2(payload, 256).alias("digest"),
            F.octet_length(payload).alias("n_bytes"),
        ),
        "pages",
    )
    narrow = rows.where(F.col("n_bytes") >= least).select("row", "id", "digest")
    grouped = smallest_of_group(narrow, ["digest"], ["id", "row"], shuffle_partitions(df.sparkSession))
    copies = grouped.where("row <> best.row").select("row", F.col("best.id").alias("refers_to"))
    # Written first, so that Spark knows their size: few copies are broadcast under its own limit
    # and the payloads stay where they are; many are joined by a shuffle.
    copies = written_once(copies, "copies")
    return rows.join(copies, "row", "left").drop("row")


def archive(
    df: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least: int = 100
) -> DataFrame:
    """Write ``df`` as monolithic archives and normalise them: the table of normalised files (path, records)."""
    folder = scratch_path(df.sparkSession, "warc")
    whole = written_once(write_monolithic(with_roles(df, id_col, uri_col, payload_col, least), f"{folder}/whole"), "warc-files")
    tasks = shuffle_partitions(df.sparkSession)
    return written_once(normalise(whole.repartition(tasks), f"{folder}/members"), "warc-files")
