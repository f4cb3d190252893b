"""WARC archives: one gzip member a record, and a sequential reader that verifies them.

Writing: of records with equal payloads of at least ``min_revisit_bytes`` the one with the
largest page id is a ``response``, the others are ``revisit`` records that refer to it. Payloads
are compared by SHA-1 and length. Each task writes one ``.warc.gz`` file into the shared folder,
first under a name of its own, then renamed. The name that counts is the one that the task returns, and
holds its attempt, so a repeated or speculative task neither replaces nor mixes with another's file.

Reading: a file streams through an incremental decompressor in small pieces; at each member's
start the header block is framed by its blank line and the content block by Content-Length; the
block digest, and for responses the payload digest and length, must hold. A payload is hashed as
it passes and never kept whole. Any break of the format raises ``WarcError``, and so does a revisit
whose target isn't a response with the same payload digest and length.

Null and odd cases: null html is an empty payload; a null page id is smaller than every other
and reads back as null; repeated rows (same id and payload) are each a record, all responses if
their id is the group's largest; a null url is left out; an empty table writes no file and reads
back as no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import scratch, utf8, written

#: All records carry one date, so that equal input gives equal archives.
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
PIECE = 1 << 16
#: Parts into which a group of equal payloads is dealt, so that none stays in one task.
SALTS = 64
ROW = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, record_offset long"


class WarcError(ValueError):
    """An archive that doesn't follow the format, or whose digests don't hold."""


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def decide(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, refers_to (null for responses)."""
    rows = pages.select("page_id", "url", utf8("html").alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int"))
    narrow = rows.where(F.octet_length("payload") >= min_revisit_bytes).select("page_id", "digest")
    groups = narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
    shared = groups.where((F.col("n") > 1) & F.col("first").isNotNull()).select(
        F.col("digest").alias("g"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")
    )
    joined = rows.join(shared, (F.col("digest") == F.col("g")) & (F.col("salt") == F.col("s")), "left")
    older = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.octet_length("payload") >= min_revisit_bytes)
    return joined.select("page_id", "url", "payload", "digest", F.when(older, F.col("first")).alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None) -> bytes:
    """One uncompressed record."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else " ".join(url.split())),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(digest)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(hashlib.sha1(block).digest())}"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("WARC-Refers-To", None if refers_to is None else f"<{ID}{refers_to}>"),
        ("Content-Length", str(len(block))),
    ]
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _write(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    batches = (b for b in batches if b.num_rows)
    first = next(batches, None)
    if first is None:
        return
    fs, folder = _filesystem(uri)
    name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
    mine = f"{folder}/_{name}"
    n = 0
    with fs.open_output_stream(mine, compression=None) as out:
        for batch in itertools.chain([first], batches):
            for row in zip(*(batch[c] for c in ("page_id", "url", "payload", "digest", "refers_to")), strict=True):
                out.write(member(record(*(x.as_py() for x in row))))
                n += 1
    fs.move(mine, f"{folder}/{name}")
    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["name", "records"])


def write_archives(decided: DataFrame, uri: str) -> list[tuple[str, int]]:
    """Write the rows of ``decide``; the files' names and their numbers of records, one a task."""
    fs, folder = _filesystem(uri)
    fs.create_dir(folder, recursive=True)
    done = decided.mapInArrow(lambda it: _write(it, uri), "name string, records long").collect()
    return sorted((r["name"], r["records"]) for r in done)


class _Member:
    """The bytes of one gzip member, as they are decompressed."""

    def __init__(self, refill: Callable[[], bytes], start: bytes):
        self.z, self.refill, self.raw, self.buf = zlib.decompressobj(31), refill, start, b""

    def more(self) -> bool:
        """Decompress a little; False at the member's end."""
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail or self.raw or self.refill()
        self.raw = b""
        if not data:
            raise WarcError("the archive ends inside a record")
        try:
            self.buf += self.z.decompress(data, PIECE)
        except zlib.error as e:
            raise WarcError(f"broken gzip member: {e}") from e
        return True

    def until(self, mark: bytes) -> bytes:
        """The bytes up to the mark, however many; the header holds a url of any length."""
        held, start = bytearray(self.buf), 0
        while (at := held.find(mark, start)) < 0:
            start, self.buf = max(0, len(held) - len(mark) + 1), b""
            if not self.more():
                raise WarcError("a header block has no end")
            held += self.buf
        self.buf = bytes(held[at + len(mark) :])
        return bytes(held[:at])

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buf and not self.more():
                raise WarcError("a content block is shorter than its Content-Length")
            out, self.buf = self.buf[:n], self.buf[n:]
            n -= len(out)
            yield out

    def finish(self) -> bytes:
        """Check that only the record's end follows; what comes after the member."""
        while self.more():
            if len(self.buf) > 4:
                break
        if self.buf != b"\r\n\r\n":
            raise WarcError("a content block is longer than its Content-Length")
        return self.z.unused_data


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])} | {"": lines[0]}


def _page(ref: str) -> int | None:
    digits = ref.strip("<>").removeprefix(ID)
    return int(digits) if digits else None


def read_records(read: Callable[[int], bytes]) -> Iterator[tuple]:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, offset of each record."""
    raw, offset = read(PIECE), 0
    while raw:
        taken = [len(raw)]

        def refill() -> bytes:
            data = read(PIECE)
            taken[0] += len(data)
            return data

        m = _Member(refill, raw)
        head = _fields(m.until(b"\r\n\r\n"))
        if not head[""].startswith("WARC/"):
            raise WarcError("no WARC version line")
        try:
            length, kind = int(head["content-length"]), head["warc-type"]
            block_sha, sha, size = hashlib.sha1(), hashlib.sha1(), 0
            http, body = b"", False
            for data in m.exactly(length):
                block_sha.update(data)
                if not body:
                    http += data
                    if (at := http.find(b"\r\n\r\n")) < 0:
                        continue
                    body, data, http = True, http[at + 4 :], http[:at]
                sha.update(data)
                size += len(data)
            declared = int(_fields(http)["content-length"])
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            if head["warc-block-digest"] != f"sha1:{base32_sha1(block_sha.digest())}":
                raise WarcError("a block digest doesn't hold")
            if kind == "response" and (size != declared or base32_sha1(sha.digest()) != digest):
                raise WarcError("a payload digest or length doesn't hold")
            refers = _page(head["warc-refers-to"]) if kind == "revisit" else None
            page = _page(head["warc-record-id"])
        except KeyError as e:
            raise WarcError(f"a record has no field {e}") from e
        rest = m.finish()
        yield page, declared, digest, kind, refers, offset
        offset += taken[0] - len(rest)
        raw = rest or read(PIECE)


def _read(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[pa.RecordBatch]:
    fs, folder = _filesystem(uri)
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in ROW.split(", ")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        for name in batch["name"].to_pylist():
            with fs.open_input_stream(f"{folder}/{name}", compression=None) as f:
                rows = ((*r[:5], name, r[5]) for r in read_records(f.read))
                while chunk := list(itertools.islice(rows, 4096)):
                    yield packed(chunk)


def read_archives(spark, uri: str, names: list[str]) -> DataFrame:
    """The records of the named files below ``uri``, one file at a time in a task."""
    if not names:
        return spark.createDataFrame([], ROW)
    files = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    return files.repartitionById(len(names), F.col("i")).select("name").mapInArrow(lambda it: _read(it, uri), ROW)


def dangling(records: DataFrame) -> DataFrame:
    """Revisits whose target is no response of the same payload: refers_to, payload_digest, payload_bytes.

    Revisits of one target fold before the join, so a payload of very many pages is one row.
    """
    same = ["refers_to", "payload_digest", "payload_bytes"]
    asked = records.where(F.col("record_type") == "revisit").select(*same).distinct()
    given = records.where(F.col("record_type") == "response").select(F.col("page_id").alias("refers_to"), *same[1:])
    return asked.join(given, same, "left_anti")


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write all pages to archives in the shared folder and read every record back; a revisit without
    its response is an error."""
    spark = pages.sparkSession
    uri = scratch(spark, "warc")
    files = write_archives(decide(pages, min_revisit_bytes), uri)
    records = written(read_archives(spark, uri, [name for name, _ in files]), "warc-records")
    if lost := dangling(records).limit(3).collect():
        raise WarcError(f"revisits without their response: {lost}")
    return records
