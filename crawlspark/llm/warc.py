"""WARC archives written from pages and read back as a chunked record table.

One archive per write task, one gzip member per record. Payloads pass through in chunks:
writing compresses and hashes them piece by piece, reading yields (record, chunk number)
rows that carry the SHA-1 and length so far. No record is put together in memory.

Null html is an empty payload, a null url an empty target. Pages with equal payloads: the
largest page_id is the response, others are revisits of it; equal page_ids and a group
without any page_id are all responses. An empty table writes no archive and reads back
no rows. Other columns are ignored.
"""

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlspark.llm.shared import arrow_rows, attach, kept, scratch_folder

CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = ("page_id bigint, record_type string, refers_to bigint, record_id string, target string, chunk bigint, "
          "data binary, payload_bytes bigint, payload_digest string, declared_digest string, last boolean")
CHUNK_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
    ("target", pa.string()), ("chunk", pa.int64()), ("data", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("declared_digest", pa.string()), ("last", pa.bool_())])


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """`page_id`, `url`, `html`, and `response_id`: the page that a revisit refers to, null for responses.

    Only payload hashes are grouped. Pages whose payload is unlike all others
    meet nothing in the join.
    """
    sha = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    hashed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", sha.alias("sha"))
    groups = (hashed.where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
              .groupBy("sha").agg(F.count("*").alias("n"), F.max("page_id").alias("largest"))
              .where("n > 1 and largest is not null").select("sha", "largest"))
    joined = attach(hashed, kept(groups), ["sha"], F.lit(96))
    revisit = F.col("page_id").isNull() | (F.col("page_id") < F.col("largest"))
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("largest")).alias("response_id"))


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _head(page_id, url: bytes, response_id, payload: memoryview) -> bytes:
    digest = hashlib.sha1()
    for start in range(0, len(payload), CHUNK):
        digest.update(payload[start:start + CHUNK])
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    length = len(http) + (len(payload) if response_id is None else 0)
    target = b"".join((url or b"").split())
    lines = [b"WARC/1.1", b"WARC-Type: " + (b"response" if response_id is None else b"revisit"),
             f"WARC-Record-ID: {_record_id(page_id)}".encode(), f"WARC-Date: {DATE}".encode(),
             b"WARC-Target-URI: " + target, f"WARC-Payload-Digest: sha1:{base32(digest.digest())}".encode()]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}".encode())
    if response_id is not None:
        lines += [f"WARC-Refers-To: {_record_id(response_id)}".encode(), f"X-Refers-To-Page-ID: {response_id}".encode(),
                  f"WARC-Profile: {PROFILE}".encode()]
    lines += [b"Content-Type: application/http; msgtype=response", f"Content-Length: {length}".encode()]
    return b"\r\n".join(lines) + b"\r\n\r\n" + http


def write_archives(typed: DataFrame, folder: str, level: int = 5) -> DataFrame:
    """Writes one archive per task below `folder`, a URI that pyarrow opens; `path`, `records` per archive.

    A task writes under a name of its own, so a repeated task never touches the
    file of another; only the paths of tasks that ended are in the result.
    """

    def write(rows):
        first = next(rows, None)
        if first is None:
            return
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name, records = f"{uuid.uuid4().hex}.warc.gz", 0
        with files.open_output_stream(f"{root}/{name}", compression=None) as out:
            row = first
            while row is not None:
                page_id, url, html, response_id = row
                payload = memoryview(html or b"")
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(packer.compress(_head(page_id, url, response_id, payload)))
                if response_id is None:
                    for start in range(0, len(payload), CHUNK):
                        out.write(packer.compress(payload[start:start + CHUNK]))
                out.write(packer.compress(b"\r\n\r\n") + packer.flush())
                records += 1
                row = next(rows, None)
        yield f"{folder}/{name}", records

    work = arrow_rows(write, pa.schema([("path", pa.string()), ("records", pa.int64())]))
    return kept(typed.mapInArrow(work, "path string, records bigint"))


class _Reader:
    """Reads lines and bounded pieces from a stream."""

    def __init__(self, stream):
        self.stream = stream

    def head(self) -> dict[str, str] | None:
        line = self.stream.readline()
        while line in (b"\r\n", b"\n"):
            line = self.stream.readline()
        if not line:
            return None
        fields = {"": line.decode().strip()}
        while (line := self.stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        return fields

    def pieces(self, length: int) -> Iterator[bytes]:
        while length:
            piece = self.stream.read(min(length, CHUNK))
            if not piece:
                raise ValueError("an archive ends within a record")
            length -= len(piece)
            yield piece


def record_chunks(stream, with_data: bool) -> Iterator[tuple]:
    """Rows of CHUNK_SCHEMA for every record of an uncompressed WARC stream, in order."""
    reader = _Reader(stream)
    while (fields := reader.head()) is not None:
        length = int(fields["content-length"])
        block = reader.stream
        http_length, taken = None, 0
        while (line := block.readline()) not in (b"\r\n", b"\n", b""):
            taken += len(line)
            if line.lower().startswith(b"content-length:"):
                http_length = int(line.split(b":", 1)[1])
        taken += len(line)
        page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
        declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        base = (int(page) if page else None, fields["warc-type"], int(refers) if refers else None,
                fields["warc-record-id"], fields.get("warc-target-uri"))
        if fields["warc-type"] == "revisit":
            # The payload is in the record referred to; its length and digest are declared here.
            for _ in reader.pieces(length - taken):
                pass
            yield *base, 0, None, http_length, declared, declared, True
            continue
        digest, size, chunk, left = hashlib.sha1(), 0, 0, length - taken
        if not left:
            yield *base, 0, b"" if with_data else None, 0, base32(digest.digest()), declared, True
        for piece in reader.pieces(left):
            digest.update(piece)
            size += len(piece)
            yield (*base, chunk, piece if with_data else None, size, base32(digest.copy().digest()), declared,
                   size == left)
            chunk += 1


def read_archives(archives: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in `path`: one row per record and chunk.

    `payload_bytes` and `payload_digest` run along with the chunks; the row marked
    `last` has those of the whole payload.
    """

    def read(rows):
        for path, in rows:
            files, name = pyarrow.fs.FileSystem.from_uri(path.decode())
            with files.open_input_stream(name, compression=None, buffer_size=CHUNK) as packed:
                with gzip.GzipFile(fileobj=packed, mode="rb") as stream:
                    yield from record_chunks(stream, with_data)

    # With data, at most 16 chunks are held before they leave as a batch.
    work = arrow_rows(read, CHUNK_SCHEMA, flush_rows=16 if with_data else 5_000)
    return archives.select("path").mapInArrow(work, CHUNKS)


def archive_folder(pages: DataFrame) -> str:
    folder = f"{scratch_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    return folder if "://" in folder else folder.replace("file:", "", 1)


def round_trip(pages: DataFrame, folder: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Per page what its record says once written and read back."""
    archives = write_archives(with_record_types(pages, min_bytes), folder or archive_folder(pages))
    # One archive per task; the list of archives is small.
    count = max(1, archives.count())
    return read_archives(archives.repartition(count, "path"), with_data=False).where("last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
