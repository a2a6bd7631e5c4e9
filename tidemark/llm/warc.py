"""WARC archives: writing pages as records, and a sequential reader.

Writer: one gzip member per record, in ``.warc.gz`` files in a shared folder.
Each task writes files under new names and reports them in a manifest that
Spark commits, so files of lost or repeated attempts are never read.

Reader: files are read front to back in small pieces.  Every gzip member is
decompressed incrementally, must hold exactly one record framed by its
Content-Length, and payload and block digests are verified while streaming;
a payload is never needed whole.

Defined results: null html is an empty payload; a null url is an empty target;
a null page id is written as ``null`` and ranks below all ids; among equal
payloads every row with the largest id is a response (so exact repeats of that
row are responses too); urls of any length are written and read; empty tables
give no archives and no rows; further columns are ignored.  Damaged archives
raise an error that names file and record.

Foreign archives: ids are text (``record_id``, ``refers_to_id``), and page ids
where they have the writer's form; a payload's length is what the block holds,
for a revisit what its HTTP header says, else null; digests that are missing, of
another algorithm, or of a body with a transfer coding are not compared; records
of other types are read over.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import group_top, shared_folder, stored

ARCHIVE_BYTES = 512 << 20
READ_BYTES = 1 << 18
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long, bytes long"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "target_uri string, record_id string, refers_to_id string, path string, record_no long, payload binary")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32, from the hex digits five (20 bits) at a time."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_record_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: response); equal payloads of ``least_bytes`` revisit."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "utf-8")
    rows = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
            .withColumn("digest", base32_sha1(F.col("payload"))))
    typed = group_top(rows, ["digest"], F.col("page_id"), F.struct("page_id"))
    revisit = (F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("top"))
    return typed.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("top")).alias("refers_to"))


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _base32(digest) -> str:
    return base64.b32encode(digest).decode()


def _uri(text: str) -> str:
    """Control characters and spaces may not stand in a header line."""
    return "".join(c if ord(c) > 32 and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def page_record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = "null" if page_id is None else page_id
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", DATE),
              ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Block-Digest", f"sha1:{_base32(hashlib.sha1(block).digest())}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    return _record(fields, block)


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``with_record_types`` rows; returns the stored manifest (path, records, bytes)."""
    folder = folder or shared_folder(pages.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        out, path, records, size = None, "", 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                if out is None:
                    path, records = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(path, compression=None)
                    size = out.write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                              ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                size += out.write(page_record(*row))
                records += 1
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    manifest = pages.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(write, MANIFEST)
    # the folder as a URI is kept for readers, the path is the file system's own
    return stored(manifest.withColumn("folder", F.lit(folder)), "warc-manifest")


class Member:
    """One gzip member of a stream, decompressed in pieces; ``rest`` is what follows it."""

    def __init__(self, first: bytes, more):
        self.inflate, self.more, self.buffer = zlib.decompressobj(31), more, b""
        self._feed(first)

    def _feed(self, data: bytes) -> None:
        self.buffer += self.inflate.decompress(data, READ_BYTES)

    def _fill(self) -> bool:
        """More decompressed bytes, or False at the member's end."""
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.more()
            if not data:
                raise ValueError("the archive ends inside a member")
            had = len(self.buffer)
            self._feed(data)
            if len(self.buffer) > had:
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """What stands before the mark; as long as the writer made it."""
        head, at = bytearray(self.buffer), self.buffer.find(mark)
        while at < 0:
            had = len(head)
            self.buffer = b""
            if not self._fill():
                raise ValueError(f"no end of header within {had} bytes")
            head += self.buffer
            at = head.find(mark, max(0, had - len(mark) + 1))
        self.buffer = bytes(head[at + len(mark):])
        return bytes(head[:at])

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self._fill():
                raise ValueError(f"the record is {n} bytes shorter than its Content-Length")
            piece, self.buffer = self.buffer[:n], self.buffer[n:]
            n -= len(piece)
            yield piece

    def end(self) -> bytes:
        """Checks the record's end and returns the bytes after the member."""
        while self._fill():
            if len(self.buffer) > 4:
                break
        if self.buffer != b"\r\n\r\n" or not self.inflate.eof:
            raise ValueError("the member goes on after its record")
        return self.inflate.unused_data


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        out[k.strip().lower()] = v.strip()
    return out


def _page(name: str | None) -> int | None:
    """The page id in a record id of the writer's form."""
    number = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if name and name.startswith("<urn:page:") and number != "null" else None


class _Body:
    """A record's block as it comes: the HTTP header apart where there is one, digests and length of the rest."""

    def __init__(self, is_http: bool, keep: bool):
        self.block, self.payload, self.n, self.kept = hashlib.sha1(), hashlib.sha1(), 0, [] if keep else None
        self.http: dict[str, str] | None = None if is_http else {}
        self.head = bytearray()

    def add(self, piece: bytes) -> None:
        self.block.update(piece)
        if self.http is None:
            had = len(self.head)
            self.head += piece
            at = self.head.find(b"\r\n\r\n", max(0, had - 3))
            if at < 0:
                return
            self.http, piece = _fields(bytes(self.head[:at])), bytes(self.head[at + 4:])
        self.payload.update(piece)
        self.n += len(piece)
        if self.kept is not None:
            self.kept.append(piece)


def read_records(more, keep_payload: bool = False) -> Iterator[dict]:
    """Records of one archive; ``more()`` gives its next bytes, b"" at the end."""
    rest, no = more(), 0
    while rest or (rest := more()):
        try:
            member = Member(rest, more)
            head = member.until(b"\r\n\r\n")
            if not head.startswith(b"WARC/1."):
                raise ValueError("no WARC version line")
            warc = _fields(head)
            kind = warc["warc-type"]
            wanted = kind in ("response", "revisit")
            body = _Body(wanted and warc.get("content-type", "").replace(" ", "").startswith("application/http"), wanted and keep_payload and kind == "response")
            for piece in member.exactly(int(warc["content-length"])):
                body.add(piece)
            rest = member.end()
            if warc.get("warc-block-digest", "").startswith("sha1:") and warc["warc-block-digest"] != f"sha1:{_base32(body.block.digest())}":
                raise ValueError("the block digest does not hold")
            if not wanted:
                continue
            http, said = body.http or {}, warc.get("warc-payload-digest", "")
            length = http.get("content-length", "")
            told = int(length) if length.isdigit() else None
            if kind == "response" and "transfer-encoding" not in http:
                if said.startswith("sha1:") and said != f"sha1:{_base32(body.payload.digest())}" or told not in (None, body.n):
                    raise ValueError("the payload digest or length does not hold")
            name, refers = warc.get("warc-record-id"), warc.get("warc-refers-to")
            digest = said.removeprefix("sha1:") if said.startswith("sha1:") else _base32(body.payload.digest()) if kind == "response" else said or None
            yield {"page_id": _page(name), "payload_bytes": body.n if kind == "response" else told, "payload_digest": digest, "record_type": kind, "refers_to": _page(refers),
                   "target_uri": warc.get("warc-target-uri", "").removeprefix("<").removesuffix(">"), "record_id": name, "refers_to_id": refers, "record_no": no,
                   "payload": b"".join(body.kept) if body.kept is not None else None}
            no += 1
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"record {no}: {e}") from e


def read_archives(manifest: DataFrame, keep_payload: bool = False, batch_records: int = 4096, batch_bytes: int = 16 << 20) -> DataFrame:
    """Page records of the archives in a manifest, one task per archive or so."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("target_uri", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()), ("path", pa.string()), ("record_no", pa.int64()), ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, path in zip(batch.column("folder").to_pylist(), batch.column("path").to_pylist(), strict=True):
                fs, _ = FileSystem.from_uri(folder)
                rows, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    try:
                        for r in read_records(lambda s=stream: s.read(READ_BYTES), keep_payload):
                            rows.append(r | {"path": path})
                            held += len(r["payload"] or b"")
                            if len(rows) >= batch_records or held >= batch_bytes:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows, held = [], 0
                    except ValueError as e:
                        raise ValueError(f"{path}, {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    n = max(1, manifest.count())
    return manifest.repartition(n, "path").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, **kw) -> DataFrame:
    """Write all pages to archives in the shared folder and read the records back."""
    return read_archives(write_archives(with_record_types(pages, **kw)))


def load(spark: SparkSession, uri: str, **kw) -> DataFrame:
    """Records of foreign or earlier archives: every ``*.warc.gz`` directly in a folder."""
    fs, base = FileSystem.from_uri(uri)
    from pyarrow.fs import FileSelector

    paths = [(f.path, 0, f.size, uri) for f in fs.get_file_info(FileSelector(base)) if f.path.endswith(".warc.gz")]
    return read_archives(spark.createDataFrame(paths, MANIFEST + ", folder string"), **kw)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
k AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(1 + ((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM k"""
