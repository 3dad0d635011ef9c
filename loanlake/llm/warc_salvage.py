"""WARC archives: a writer that stores repeated payloads once, and a salvage reader.

Writer: one gzip member per record in files of the shared folder. A file's name holds the task
attempt, and only files that a finished task reports are listed in the manifest, so a lost
executor leaves at most unlisted files.

Salvage reader: archives are read member by member (gzip) or record by record (plain). A record
counts only if every check holds: gzip checksum, version line, header syntax, Content-Length, the
closing blank lines and, if present, the SHA-1 digests of block and payload. After a failed check
the reader searches for the next gzip magic or version line from which a whole record passes,
resumes there, and reports the bytes between as a quarantined gap. Headers have no size limit: one ends at its
blank line, or is given up at the next version line or the archive's end. Folded header lines and SHA-1
digests in base32 or hex, in any case, are read as they are meant. Memory is one record.

The manifest says how many records each archive holds; ``check_counts`` holds it against what was read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlake.llm.common import byte_column, shared_path, stored

# Fixed values of the WARC and gzip formats.
VERSION = b"WARC/1.1"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_HEAD_END = re.compile(rb"\r\n\r\n|\nWARC/1\.[01]\r\n")
MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ROLL_BYTES = 64 << 20
CHUNK = 1 << 18
READ_TASKS = 20_000  # at most; further archives share tasks
HOT_SALTS = 16


def digest32(data: bytes) -> bytes:
    return base64.b32encode(hashlib.sha1(data).digest())


def page_record(page_id: int | None, url: bytes, payload: bytes, digest: bytes,
                revisit: bool, refers_to: int | None) -> bytes:
    """One WARC record. A revisit has the HTTP header of the page (with its length), no payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
            % len(payload))
    block = http if revisit else http + payload
    target = re.sub(rb"[\x00-\x20\x7f]", lambda m: b"%%%02X" % m[0][0], url) or b"urn:none"
    head = [VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"),
            b"WARC-Record-ID: <urn:page:%s>" % _id(page_id),
            b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Target-URI: " + target,
            b"WARC-Payload-Digest: sha1:" + digest, b"WARC-Block-Digest: sha1:" + digest32(block)]
    if revisit:
        head += [b"WARC-Profile: " + REVISIT_PROFILE, b"WARC-Refers-To: <urn:page:%s>" % _id(refers_to)]
    head += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % len(block)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def _id(page_id: int | None) -> bytes:
    return b"null" if page_id is None else b"%d" % page_id


def gzip_member(record: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


class Source:
    """Bytes of an archive by offset, through one moving window."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.window = file, size, 0, b""

    def read(self, offset: int, n: int) -> bytes:
        n = max(0, min(n, self.size - offset))
        if not (self.at <= offset and offset + n <= self.at + len(self.window)):
            self.file.seek(offset)
            self.at, self.window = offset, self.file.read(max(n, min(CHUNK, self.size - offset)))
        return self.window[offset - self.at:offset - self.at + n]


def _headers(head: bytes) -> dict[bytes, bytes] | None:
    """Headers by lower-case name, folded lines joined by a space; None if a line is neither."""
    out: dict[bytes, bytes] = {}
    name = b""
    for line in head.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name:
            out[name.lower()] = (out[name.lower()] + b" " + line.strip()).strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            return None
        out[name.lower()] = value.strip()
    return out


def sha1_of(digest: bytes) -> bytes | None:
    """The 20 bytes that a labelled SHA-1 digest (base32 or hex, any case) names; None for others."""
    label, _, value = digest.partition(b":")
    try:
        if label.strip().lower() == b"sha1":
            value = value.strip()
            return base64.b32decode(value, casefold=True) if len(value) == 32 else bytes.fromhex(value.decode())
    except ValueError:
        pass
    return None


def _checked(headers: dict[bytes, bytes], block: bytes) -> tuple[dict[bytes, bytes], bytes] | str:
    """(headers, payload) of a record, or the check that failed."""
    want = sha1_of(headers.get(b"warc-block-digest", b""))
    if want is not None and want != hashlib.sha1(block).digest():
        return "block digest"
    payload = block
    if headers.get(b"content-type", b"").startswith(b"application/http"):
        http, found, payload = block.partition(b"\r\n\r\n")
        if not found:
            return "http header"
        headers |= {b"http:" + k: v for k, v in (_headers(http) or {}).items()}
    want = sha1_of(headers.get(b"warc-payload-digest", b""))
    if headers.get(b"warc-type") != b"revisit" and want is not None and want != hashlib.sha1(payload).digest():
        return "payload digest"
    return headers, payload


def _plain_record(read, offset: int):
    """((headers, payload), end) of the uncompressed record at ``offset``, or the failed check."""
    head, step, seen = bytearray(), 4096, 0
    while (found := _HEAD_END.search(head, seen)) is None:
        more = read(offset + len(head), step)
        if not more:
            return "truncated header"
        seen = max(0, len(head) - 12)
        head += more
        if not VERSION_LINE.match(head[:10]):
            return "version line"
        step = min(step * 2, 1 << 24)
    if found[0] != b"\r\n\r\n":
        return "truncated header"
    head = bytes(head[:found.start()])
    headers = _headers(head)
    length = (headers or {}).get(b"content-length", b"")
    if headers is not None and not re.fullmatch(rb"\d{1,18}", length):
        return "content length"
    if headers is None:
        return "header syntax"
    start, n = offset + len(head) + 4, int(length)
    tail = read(start + n, 4)
    if tail != b"\r\n\r\n":
        return "record end"
    got = _checked(headers, read(start, n))
    return got if isinstance(got, str) else (got, start + n + 4)


def _gzip_member(source: Source, offset: int):
    z, data, at = zlib.decompressobj(31), [], offset
    try:
        while not z.eof:
            chunk = source.read(at, CHUNK)
            if not chunk:
                return "truncated member"
            data.append(z.decompress(chunk))
            at += len(chunk)
            if len(data) == 1 and not VERSION_LINE.match(data[0][:10]):
                return "version line"
    except zlib.error:
        return "gzip checksum"
    text, end = b"".join(data), at - len(z.unused_data)
    got = _plain_record(lambda o, n: text[o:o + n], 0)
    if isinstance(got, str):
        return got
    return (got[0], end) if got[1] == len(text) else "record end"


def _record_at(source: Source, offset: int):
    start = source.read(offset, 10)
    if start.startswith(MAGIC):
        return _gzip_member(source, offset)
    if VERSION_LINE.match(start):
        return _plain_record(source.read, offset)
    return "no record start"


_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")


def _next_start(source: Source, offset: int) -> int:
    """Offset of the next gzip magic or version line, or the archive's end."""
    while offset < source.size:
        part = source.read(offset, CHUNK)
        m = _START.search(part)
        if m:
            return offset + m.start()
        if offset + len(part) >= source.size:
            break
        offset += len(part) - 9
    return source.size


def salvage(file, size: int) -> Iterator[tuple]:
    """('record', offset, length, headers, payload) of each whole record and ('gap', offset,
    length, reason) of each quarantined run of bytes, in order; together they cover the archive."""
    source, at = Source(file, size), 0
    bad, reason = None, ""
    while at < size:
        got = _record_at(source, at)
        if isinstance(got, str):
            if bad is None:
                bad, reason = at, got
            at = _next_start(source, at + 1)
            continue
        if bad is not None:
            yield "gap", bad, at - bad, reason
            bad = None
        (headers, payload), end = got
        yield "record", at, end - at, headers, payload
        at = end
    if bad is not None:
        yield "gap", bad, size - bad, reason


def _write_files(batches: Iterator[pa.RecordBatch], root: str, level: int):
    from pyarrow import fs
    where, folder = fs.FileSystem.from_uri(root)
    where.create_dir(folder, recursive=True)
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    out, names, sizes, counts = None, [], [], []
    for batch in batches:
        get = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        ids, refers = get["page_id"].to_pylist(), get["refers_to"].to_pylist()
        urls, payloads, shas = (byte_column(batch, c) for c in ("url", "payload", "sha"))
        for i, page in enumerate(ids):
            if out is None:
                names.append(f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz")
                sizes.append(0)
                counts.append(0)
                out = where.open_output_stream(f"{folder}/{names[-1]}", compression=None)
            digest = base64.b32encode(bytes.fromhex(shas[i].decode()))
            member = gzip_member(page_record(page, urls[i], payloads[i], digest,
                                             refers[i] is not None, refers[i]), level)
            out.write(member)
            sizes[-1] += len(member)
            counts[-1] += 1
            if sizes[-1] >= ROLL_BYTES:
                out.close()
                out = None
    if out is not None:
        out.close()
    yield pa.RecordBatch.from_pydict({"path": [f"{root}/{n}" for n in names],
                                      "size": pa.array(sizes, pa.int64()),
                                      "records": pa.array(counts, pa.int64())})


def write_archives(pages: DataFrame, root: str, page_id: str = "page_id", url: str | None = "url",
                   html: str = "html", level: int = 1) -> DataFrame:
    """Write a record per page below ``root`` (a folder all executors share) and return the manifest
    (path, size, records).

    Of pages with equal payloads (SHA-1 of the UTF-8 html; null: empty) the one with the smallest id
    is written as response, the others as revisits of it. Rows that repeat that id are responses
    too. Null ids come after all others; if all are null each is a response.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b"").cast("binary"))
    link = F.coalesce(F.col(url).cast("string"), F.lit("")) if url else F.lit("")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), link.alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("sha"))
    first = (rows.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1 and first is not null")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(HOT_SALTS - 1)))).drop("n"))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(HOT_SALTS)).cast("int")
    decided = (rows.withColumn("salt", salt).join(first, ["sha", "salt"], "left")
               .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
               .select("page_id", "url", "sha", "refers_to", "payload"))
    files = decided.mapInArrow(functools.partial(_write_files, root=root, level=level),
                               "path string, size long, records long")
    return stored(files, "warc-manifest")


def _read_files(batches: Iterator[pa.RecordBatch]):
    from pyarrow import fs
    kinds = pa.schema([("kind", pa.string()), ("path", pa.string()), ("offset", pa.int64()),
                       ("length", pa.int64()), ("reason", pa.string()), ("record_id", pa.string()),
                       ("record_type", pa.string()), ("target_uri", pa.string()),
                       ("refers_to", pa.string()), ("payload_digest", pa.string()),
                       ("payload_bytes", pa.int64()), ("payload", pa.binary())])
    rows, held = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            where, name = fs.FileSystem.from_uri(path)
            with where.open_input_file(name) as file:
                for found in salvage(file, file.size()):
                    rows.append(_row(path, found))
                    held += len(rows[-1]["payload"] or b"") + 500
                    if held > (4 << 20):
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                        rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=kinds)


def _text(value: bytes | None) -> str | None:
    return None if value is None else value.decode("utf-8", "replace")


def _row(path: str, found: tuple) -> dict:
    row = {"kind": found[0], "path": path, "offset": found[1], "length": found[2], "reason": None,
           "record_id": None, "record_type": None, "target_uri": None, "refers_to": None,
           "payload_digest": None, "payload_bytes": None, "payload": None}
    if found[0] == "gap":
        return row | {"reason": found[3]}
    headers, payload = found[3], found[4]
    kind = headers.get(b"warc-type", b"")
    if kind == b"revisit":
        digest = headers.get(b"warc-payload-digest", b"")
        sha = sha1_of(digest)
        digest = digest if sha is None else base64.b32encode(sha)
        n = headers.get(b"http:content-length", b"")
        size, payload = (int(n) if n.isdigit() else None), None
    else:
        digest, size = digest32(payload), len(payload)
    return row | {"record_id": _text(headers.get(b"warc-record-id")), "record_type": _text(kind),
                  "target_uri": _text(headers.get(b"warc-target-uri")),
                  "refers_to": _text(headers.get(b"warc-refers-to")), "payload_digest": _text(digest),
                  "payload_bytes": size, "payload": payload}


READ_SCHEMA = ("kind string, path string, offset long, length long, reason string, record_id string, "
               "record_type string, target_uri string, refers_to string, payload_digest string, "
               "payload_bytes long, payload binary")


def read_archives(paths: DataFrame) -> DataFrame:
    """Salvage every archive named in the first column of ``paths`` (URIs that pyarrow opens): rows
    of kind ``record`` or ``gap``. Empty archives give no row; a damaged one gives its whole
    records and its gaps. Paths are counted first: up to ``READ_TASKS`` archives have a task each, which an
    explicit number of ranges keeps apart (adaptive execution would merge these few bytes into one task)."""
    named = paths.select(F.col(paths.columns[0]).alias("path")).where("path is not null")
    n = min(max(1, named.count()), READ_TASKS)
    return named.repartitionByRange(n, "path").mapInArrow(_read_files, READ_SCHEMA)


def check_counts(manifest: DataFrame, records: DataFrame) -> None:
    """Raise if an archive of the manifest gave fewer or more records than were written."""
    read = records.where("kind = 'record'").groupBy("path").agg(F.count(F.lit(1)).alias("found"))
    wrong = manifest.join(read, "path", "left").where("coalesce(found, 0) <> records").select("path", "records", "found")
    first = wrong.first()
    if first is not None:
        raise RuntimeError(f"{first['path']}: {first['records']} records written, {first['found'] or 0} read")


def page_number(column: str):
    """Id of a ``<urn:page:ID>`` reference; null for others."""
    return F.nullif(F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1), F.lit("")).cast("long")


def round_trip(pages: DataFrame, name: str = "warc", payloads: bool = True) -> DataFrame:
    """Write the pages, read the archives back, check that each gave its records: the reader's rows, with or
    without their payloads, as a stored table."""
    manifest = write_archives(pages, shared_path(pages.sparkSession, name),
                              url="url" if "url" in pages.columns else None)
    records = read_archives(manifest.select("path"))
    records = stored(records if payloads else records.drop("payload"), "warc-records")
    check_counts(manifest, records)
    return records
