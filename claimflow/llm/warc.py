"""WARC archives of pages: writing, normalising monolithic gzip, and reading by offset.

* ``write_monolithic`` writes each partition's records as archives that are
  one gzip stream as a whole, the form in which such files often arrive.
* ``normalise`` inflates every archive once, as a stream, and rewrites each
  record as its own gzip member; a sidecar file lists the members' offsets.
* ``read_indexed`` reads single records at the offsets of the sidecars.

Archives and sidecars lie in the shared folder and are opened through the file
system that its address names. Every task attempt writes files of its own
name, and only the names that successful tasks return are read on, so lost
executors leave no wrong file behind.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import shared_path, stored

#: Payload bytes after which a new archive is begun; bytes that a stream is read by; files of one wave of tasks.
ARCHIVE_BYTES, READ_BYTES, MAX_TASKS = 64 << 20, 1 << 20, 4096
_GZIP = 16 + zlib.MAX_WBITS


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value: control characters and non-ASCII bytes percent-encoded."""
    return "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in value.encode("utf-8", "surrogatepass"))


def _urn(page: str | None) -> str:
    """A page's record id; any text of an id comes back whole from :func:`_page`, and null is no text."""
    return "<urn:nil>" if page is None else f"<urn:page:{quote(page, safe='', errors='surrogatepass')}>"


def _page(urn: str) -> str | None:
    return None if urn == "<urn:nil>" else unquote(urn[len("<urn:page:") : -1], errors="surrogatepass")


def record(page: str | None, url: str, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or (with ``refers_to``) a revisit record, which keeps the HTTP headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_urn(page)}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: {_urn(refers_to)}")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers_of(raw: bytes) -> dict[str, str]:
    """Headers of a record by lower-case name."""
    lines = raw.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def parse(raw: bytes) -> dict:
    """Page, payload length and digest, type and referred page of one record; a wrong digest is an error."""
    head, _, block = raw.partition(b"\r\n\r\n")
    h = headers_of(head)
    block = block[: int(h["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(headers_of(http)["content-length"])
    digest = h["warc-payload-digest"].removeprefix("sha1:")
    if h["warc-type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged payload in {h['warc-record-id']}")
    refers = h.get("warc-refers-to")
    return {
        "page": _page(h["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": h["warc-type"],
        "refers": None if refers is None else _page(refers),
    }


def _open(folder_or_file: str):
    """File system and path of an address; Hadoop's names of the S3 scheme are those of S3."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", folder_or_file))


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        out = None
        done: list[tuple[str, int]] = []

        def close() -> None:
            out.write(pack.flush())
            out.close()
            done.append((name, n))

        for batch in batches:
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "html", "refers"))):
                if out is None:
                    name = f"raw-{uuid.uuid4().hex}.warc.gz"
                    out, pack, n, size = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, _GZIP), 0, 0
                rec = record(page, url, html, refers)
                out.write(pack.compress(rec))
                n, size = n + 1, size + len(rec)
                if size >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([f"{folder}/{x}" for x, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["archive", "records"]
        )

    return write


def records_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream, holding one record at a time."""
    chunks = iter(chunks)
    buffer = bytearray()

    def more() -> bool:
        for chunk in chunks:
            buffer.extend(chunk)
            return True
        return False

    while True:
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends inside a record")
                return
        total = end + 4 + int(headers_of(bytes(buffer[:end]))["content-length"]) + 4
        while len(buffer) < total:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield bytes(buffer[:total])
        del buffer[:total]


def _inflated(stream) -> Iterator[bytes]:
    """The content of a gzip file of one or several members, inflated once, piece by piece."""
    unpack = zlib.decompressobj(_GZIP)
    while raw := stream.read(READ_BYTES):
        while raw:
            piece = unpack.decompress(raw, READ_BYTES)
            if piece:
                yield piece
            raw = unpack.unconsumed_tail
            if unpack.eof:
                raw = unpack.unused_data
                unpack = zlib.decompressobj(_GZIP)


def _normaliser(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            made = []
            for archive in batch.column("archive").to_pylist():
                src, path = _open(archive)
                name = f"warc-{uuid.uuid4().hex}.warc.gz"
                at = n = 0
                with (
                    src.open_input_stream(path, compression=None) as stream,
                    fs.open_output_stream(f"{base}/{name}", compression=None) as out,
                    fs.open_output_stream(f"{base}/{name}.idx", compression=None) as index,
                ):
                    for rec in records_of(_inflated(stream)):
                        pack = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
                        member = pack.compress(rec) + pack.flush()
                        out.write(member)
                        ident = headers_of(rec[: rec.index(b"\r\n\r\n")])["warc-record-id"]
                        index.write(json.dumps({"offset": at, "length": len(member), "id": ident}).encode() + b"\n")
                        at, n = at + len(member), n + 1
                made.append((f"{folder}/{name}", n))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in made], pa.string()), pa.array([k for _, k in made], pa.int64())], ["archive", "records"]
            )

    return run


_READ = "page string, payload_bytes long, payload_digest string, record_type string, refers string, archive string, offset long, length long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every record named in the sidecars of the archives, read at its offset; up to 1000 results at a time."""
    names = [x.split()[0] for x in _READ.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _READ.split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds)], names)

    rows: list[dict] = []
    for batch in batches:
        for archive in batch.column("archive").to_pylist():
            fs, path = _open(archive)
            with fs.open_input_file(path) as file, fs.open_input_stream(f"{path}.idx", compression=None) as index:
                for line in _lines(index):
                    at = json.loads(line)
                    file.seek(at["offset"])
                    raw = zlib.decompress(file.read(at["length"]), _GZIP)
                    rows.append(parse(raw) | {"archive": archive, "offset": at["offset"], "length": at["length"]})
                    if len(rows) >= 1000:
                        yield batch_of(rows)
                        rows = []
    yield batch_of(rows)


def _lines(stream) -> Iterator[bytes]:
    rest = b""
    while chunk := stream.read(READ_BYTES):
        *whole, rest = (rest + chunk).split(b"\n")
        yield from whole
    if rest:
        yield rest


def revisits(pages: DataFrame, id_col: str = "page_id", text_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(``page``, ``digest``, ``refers``) of the pages whose payload, of ``least_bytes`` or more, a smaller id already has.

    Payloads are equal by SHA-1, SHA-256 and length. The smallest id of a payload is
    found by a combined aggregate, so a payload on a third of all pages is no
    hot task; the join back is on narrow rows.
    """
    payload = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = [F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size")]
    rows = pages.select(F.col(id_col).alias("page"), *key).where(F.col("size") >= least_bytes)
    first = rows.groupBy("digest", "size").agg(F.min("page").alias("refers"))
    found = rows.join(first, ["digest", "size"]).where("page != refers")
    return found.select("page", "digest", "refers").distinct()


def _spread(files: DataFrame) -> DataFrame:
    """One task per file, as far as MAX_TASKS go."""
    return files.repartition(max(1, min(files.count(), MAX_TASKS)), "archive")


def write_monolithic(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the pages' records; a stored table of ``archive`` names and numbers of ``records``."""
    payload = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("page"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("html"), F.sha2(payload, 256).alias("digest")
    )
    marked = rows.join(revisits(pages, id_col, text_col, least_bytes), ["page", "digest"], "left")
    out = marked.select(F.col("page").cast("string").alias("page"), "url", "html", F.col("refers").cast("string").alias("refers"))
    _make(pages, folder)
    return stored(out.mapInArrow(_writer(folder), "archive string, records long"), "warc-raw")


def _make(df: DataFrame, folder: str) -> None:
    """Create the folder for archives."""
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite the archives with a gzip member per record and a sidecar each; a stored table of the new ``archive`` names."""
    return stored(_spread(archives).mapInArrow(_normaliser(folder), "archive string, records long"), "warc-members")


def read_indexed(archives: DataFrame) -> DataFrame:
    """One row per record of the normalised archives, with its place."""
    return _spread(archives).mapInArrow(_read, _READ)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back; one row per page with its record.

    A null text is an empty payload, a null url an empty one; rows that
    repeat the responding page's id are responses too, and a null id is kept as
    null (never referred to while the payload has another id). Equal payloads
    of ``least_bytes`` or more have one response, that of the smallest id. An
    empty table gives an empty result; other columns are not written.
    """
    folder = shared_path(pages.sparkSession, "warc")
    raw = write_monolithic(pages, folder, id_col, url_col, text_col, least_bytes)
    found = read_indexed(normalise(raw, folder))
    kind = pages.schema[id_col].dataType
    back = lambda c: F.col(c).cast(kind)
    return found.select(
        back("page").alias(id_col), "payload_bytes", "payload_digest", "record_type", back("refers").alias("refers_to"), "archive", "offset", "length"
    )

