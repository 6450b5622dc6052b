"""WARC writing and a splittable WARC reader.

Each record is a gzip member of its own. The reader deals byte ranges of the
archives to tasks; a task scans its range for gzip magic, takes a place as a
member only if it decodes to a WARC header and is followed by another member or
the end, and reads the records that start inside its range, whatever their end.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .scratch import new_path, persist
from .token_files import open_path
from .units import trim

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range that one task reads.
SPLIT = 8 << 20
ARCHIVE_BYTES = 64 << 20
READ = 1 << 20
#: Rows of one payload are dealt over so many tasks where they meet its first row.
SALTS = 64
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member; a revisit has the digest and length of the payload and no body."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}").urn
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", "WARC-Date: 2024-01-01T00:00:00Z",
            "WARC-Target-URI: " + "".join(c for c in (url or "") if c.isprintable()), f"WARC-Payload-Digest: sha1:{digest32(payload)}",
            f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}').urn}>", f"X-Refers-To-Page: {refers_to}"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + c.flush()


MANIFEST = "path string, bytes long, records long"


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 0) -> DataFrame:
    """Write every row as a record and return the manifest of archives.

    Of rows with equal payloads of at least ``least`` bytes the one with the
    smallest id is the response and the others revisit it; rows that repeat that
    id are responses too, and a null id is larger than any and never referred to.
    Null html is an empty payload. Payloads of any length are one record; other
    columns, whatever their names, are not read; an empty table writes nothing.
    A retried task writes other files; only those of the manifest count.
    """
    ship(pages.sparkSession)
    body = F.coalesce(F.col(html_col).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("key", F.sha2("body", 256)).withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    # min() is summed up before the shuffle, so a payload of a third of all pages costs SALTS rows a task.
    parts = rows.groupBy("key", "salt").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = parts.groupBy("key").agg(F.min("first").alias("first"), F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).filter("n > 1")
    joined = rows.join(first.select("key", "first", F.explode("salts").alias("salt")), ["key", "salt"], "left")
    refers = F.when((F.octet_length("body") >= least) & ((F.col("id") > F.col("first")) | F.col("id").isNull()), F.col("first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, to, size, n = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([to]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    to = f"{folder}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:8]}.warc.gz"
                    out, size, n = open_path(to, "w"), 0, 0
                member = record(*row)
                out.write(member)
                size, n = size + len(member), n + 1
                if size >= ARCHIVE_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()
        trim()

    return persist(joined.select("id", "url", "body", refers.alias("refers")).mapInArrow(work, MANIFEST), "warc-manifest")


class Members:
    """The gzip members that start in [start, end) of a file, decoded one by one.

    Members follow each other without gaps. So where one ends another must decode,
    or the file end, and the first must start with the file; the member behind the
    range is looked at too, as the next range can't tell its start. Anything else
    raises ValueError, unless not ``strict``: then it is passed over.
    """

    def __init__(self, file, start: int, end: int, strict: bool = True):
        self.file, self.at, self.end, self.strict = file, start, end, strict
        self.base, self.held = 0, b""

    def _read(self, at: int, n: int) -> bytes:
        """Bytes from a place on, read once for neighbouring places: at least one if the file has any there."""
        i = at - self.base
        if not 0 <= i < len(self.held) or (i + n > len(self.held) and n <= 64):
            self.file.seek(at)
            self.base, self.held, i = at, self.file.read(READ), 0
        return self.held[i : i + n]

    def _decode(self, at: int) -> tuple[bytes, int] | None:
        """The member at a place and the place behind it; None if it is none."""
        d, parts, first, pos = zlib.decompressobj(31), [], True, at
        while not d.eof:
            data = self._read(pos, 1 << 14 if first else 1 << 18)
            if not data:
                return None
            pos += len(data)
            try:
                parts.append(d.decompress(data))
            except zlib.error:
                return None
            if first:
                head = parts[0]
                if len(head) >= 7 and not head.startswith(b"WARC/1."):
                    return None
                first = len(head) < 7
        behind = pos - len(d.unused_data)
        return (b"".join(parts), behind) if self._read(behind, 3) in (MAGIC, b"") else None

    def __iter__(self) -> Iterator[bytes]:
        at, due = self.at, self.strict and self.at == 0
        while due or at < self.end:
            if due:
                if not self._read(at, 1):
                    return
                if not (member := self._decode(at)):
                    raise ValueError(f"no whole record at byte {at}: the archive is damaged or cut")
                if at >= self.end:
                    return
                yield member[0]
                at = member[1]
                continue
            data = self._read(at, min(READ, self.end - at + 2))
            if len(data) < 3:
                return
            i = data.find(MAGIC)
            if i < 0:
                at += len(data) - 2
            elif at + i >= self.end:
                return
            elif member := self._decode(at + i):
                yield member[0]
                at, due = member[1], self.strict
            else:
                at += i + 1


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block; of an HTTP message its body."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    fields = {k.strip().lower(): v.strip() for k, colon, v in lines if colon}
    size = fields.get("content-length", "")
    block = rest[: int(size)] if size.isdigit() else rest.removesuffix(b"\r\n\r\n")
    if fields.get("content-type", "").startswith("application/http") and fields.get("warc-type") == "response":
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


FIELDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(manifest: DataFrame, with_payload: bool = True, split: int = SPLIT, strict: bool = True) -> DataFrame:
    """Records of all archives of a manifest: ``FIELDS`` and, with ``with_payload``, ``payload binary`` (null in revisits).

    Fields that a record doesn't say are null; archives of other writers have no
    page_id and no refers_to. An empty manifest gives an empty table, and an archive
    of no bytes no rows. A damaged or cut record fails the read, unless not
    ``strict``; then the others are read.
    """
    ship(manifest.sparkSession)
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long"))
    ranges = manifest.select("path", F.explode(starts).alias("start"))
    n = max(1, min(1_000_000, int(manifest.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1)))
    schema = FIELDS + ", payload binary" * with_payload

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(to: str, start: int):
            with open_path(to, "r") as f:
                for member in Members(f, start, start + split, strict):
                    h, body = parse(member)
                    kind, ref = h.get("warc-type"), _number(h.get("x-refers-to-page"))
                    # Of a revisit, what its header says of the full payload; else from the body itself.
                    size, sha = (len(body), digest32(body)) if kind != "revisit" else (_number(h.get("x-payload-length")), h.get("warc-payload-digest", "").removeprefix("sha1:") or None)
                    yield _number(h.get("x-page-id")), h.get("warc-target-uri"), size, sha, kind, ref, body if kind != "revisit" else None

        def batch(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            k = len(names) - (not with_payload)
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(cols[i], kinds[i]) for i in range(k)], names=names[:k])

        for b in batches:
            for to, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held, size = [], 0
                for r in rows_of(to, start):
                    held.append(r)
                    size += len(r[6] or b"") if with_payload else 0
                    if len(held) >= 2000 or size >= 8 << 20:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)
        trim()

    return ranges.repartition(n, "path", "start").mapInArrow(work, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """The pages as archives and back: a row for each row, by the rules of ``write_warc`` for nulls, long payloads, ties, repeats and other columns; an empty table gives an empty one."""
    return read_warc(write_warc(pages, new_path(pages.sparkSession, "warc")), with_payload=False).drop("url")
