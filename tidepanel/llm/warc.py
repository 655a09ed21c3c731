"""WARC archives: a writer with revisit records and a splittable reader.

An archive is a folder of ``*.warc.gz`` files in which every record is a gzip
member of its own.  The reader needs no index: a task gets a byte range of a
file, looks for the gzip magic in it, and takes a place for the start of a
record only if the member there decodes to a WARC header.  It owns the records
that *start* in its range and reads past the range's end to finish the last
one, so each record is read once however the ranges fall.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, slices

MAGIC = b"\x1f\x8b\x08"
URN = "urn:page:"
#: Salts for the first-of-its-payload lookup: a payload that a third of the rows share is spread this far.
SALTS = 256
CHUNK = 1 << 16


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file as Spark names it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # 20 bytes: no padding


def member(fields: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    """One WARC record as a gzip member."""
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields], f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()


def record(page: str | None, url: str | None, payload: bytes, sha: str, refers: str | None, date: str, level: int) -> bytes:
    name = lambda i: f"<{URN}{'' if i is None else quote(i, safe='')}>"
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url) if url else name(page)[1:-1]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", name(page)),
              ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{sha}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers is None:
        return member(fields, http + payload, level)
    fields += [("WARC-Refers-To", name(refers)),
               ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return member(fields, http, level)


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add ``sha`` (hex) and ``refers`` (id of the record that holds the payload; null: this row does).

    ``pages`` has columns ``d`` (id) and ``h`` (payload).  Of rows with equal
    payloads of at least ``min_bytes`` bytes that with the smallest id holds
    the payload; rows that repeat this id too hold it as well.  Rows of null
    id refer to it like any other, and if a payload has no id at all, each of
    its rows holds it.  A hot payload is looked up by (payload, salt).
    """
    p = pages.withColumn("sha", F.sha1(F.encode("h", "UTF-8"))).withColumn("salt", F.pmod(F.xxhash64("d", "u"), F.lit(SALTS)))
    some = p.groupBy("sha", "salt").agg(F.min("d").alias("lo"))
    first = some.groupBy(F.col("sha").alias("s2")).agg(F.min("lo").alias("first"))
    look = some.join(first, F.col("sha") == F.col("s2")).select("sha", "salt", "first")
    holds = (F.octet_length("h") < min_bytes) | F.col("first").isNull() | F.coalesce(F.col("d") == F.col("first"), F.lit(False))
    return p.join(look, ["sha", "salt"]).select("d", "u", "h", F.when(~holds, F.col("first")).alias("refers"))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_revisit_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", level: int = 4) -> None:
    """Write a record per row into ``path`` (a folder all executors share).

    A null html is an empty payload, a null url becomes the record's own urn.
    Each task writes one file under a temporary name and renames it when
    complete, so a lost or repeated task leaves no half file; tasks without
    rows write none.  ``path/_manifest`` lists file, records and bytes.
    """
    ship_package(pages.sparkSession)
    marked = mark_revisits(pages.select(
        F.col(id_col).alias("d"), F.col(url_col).cast("string").alias("u"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("h")), min_revisit_bytes)
    rows = marked.select(F.col("d").cast("string"), "u", F.col("refers").cast("string"), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_fs(path)
        name = f"part-{TaskContext.get().partitionId():06d}.warc.gz"
        tmp, out, n = f"{folder}/.{name}.{uuid.uuid4().hex}", None, 0
        for b in slices(batches, 3):
            if out is None and b.num_rows:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(tmp)
                out.write(member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{name}>"), ("WARC-Date", date),
                                  ("WARC-Filename", name), ("Content-Type", "application/warc-fields")],
                                 b"format: WARC File Format 1.1\r\n", level))
            for d, u, r, h in zip(*[c.to_pylist() for c in b.columns], strict=True):
                payload = h.encode()
                out.write(record(d, u, payload, digest(payload), r, date, level))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            fs.move(tmp, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n], "bytes": [size]})

    rows.mapInArrow(run, "file string, records long, bytes long").write.parquet(f"{path}/_manifest")


class _Range:
    """Bytes of a file from ``start`` on, fetched as needed."""

    def __init__(self, handle, start: int, end: int, length: int):
        self.handle, self.start, self.length = handle, start, length
        # two more bytes: a magic that begins on the last byte is seen whole
        self.data = handle.read_at(min(end + len(MAGIC) - 1, length) - start, start)

    def piece(self, at: int, size: int) -> bytes:
        """Up to ``size`` bytes at a place of the file (empty at its end)."""
        at -= self.start
        if at >= len(self.data):
            more = self.length - self.start - at
            return self.handle.read_at(min(size, more), self.start + at) if more > 0 else b""
        return self.data[at:at + size]


def read_member(src: _Range, at: int) -> tuple[bytes, int] | None:
    """The record whose member starts at ``at`` and where it ends; None if no record starts there.

    The first bytes must decode to a WARC version line.  A record that begins
    so and then breaks off or fails its checksum raises.
    """
    z, out, pos, seen = zlib.decompressobj(31), [], at, b""
    while not z.eof:
        chunk = src.piece(pos, 512 if pos == at else CHUNK)
        try:
            got = z.decompress(chunk)
        except zlib.error as e:
            if not seen.startswith(b"WARC/"):
                return None
            raise ValueError(f"broken record at byte {at}") from e
        out.append(got)
        if len(seen) < 5:
            seen += got[:5]
            if not b"WARC/".startswith(seen[:5]):
                return None
        if not chunk:
            if not seen.startswith(b"WARC/"):
                return None
            raise ValueError(f"record at byte {at} breaks off")
        pos += len(chunk)
    if not seen.startswith(b"WARC/"):
        return None
    return b"".join(out), pos - len(z.unused_data)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    size = int(fields.get("content-length", -1))
    if size < 0 or size > len(rest):
        raise ValueError("record without its whole block")
    return fields, rest[:size]


def records_in(src: _Range, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Records that start in [start, end): offset, header fields, block."""
    pos = start
    while True:
        i = src.data.find(MAGIC, pos - src.start)
        if i < 0 or src.start + i >= end:
            return
        pos = src.start + i
        found = read_member(src, pos)
        if found is None:
            pos += 1
            continue
        yield pos, *parse(found[0])
        pos = found[1]
        if pos >= end:
            return


SCHEMA = ("file string, offset long, record_id string, record_type string, target_uri string, date string, "
          "payload_digest string, refers_to string, payload_bytes long, payload binary")


def read_archive(spark: SparkSession, path: str, range_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """Records of every ``*.warc.gz`` in ``path`` (warcinfo and other types too).

    ``payload`` is the block after its HTTP header; of revisits it is null and
    ``payload_bytes`` comes from that header.  ``payload_digest`` is that of
    the bytes read, or for revisits the header's.  ``payloads=False`` leaves
    the bytes out.  Ids are the record's urn without the brackets.  A folder
    without archives gives no rows.
    """
    ship_package(spark)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
             .select("path", "length").filter("length > 0"))
    ranges = (files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
              .repartition("path", "start"))

    def rows(uri: str, length: int, start: int) -> Iterator[tuple]:
        fs, file = open_fs(uri)
        end = min(start + range_bytes, length)
        with fs.open_input_file(file) as handle:
            for at, f, block in records_in(_Range(handle, start, end, length), start, end):
                kind, sha = f.get("warc-type", ""), f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                http, payload, size = block.startswith(b"HTTP/"), block, len(block)
                if http:
                    head, _, payload = block.partition(b"\r\n\r\n")
                    said = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
                    size = len(payload) if kind != "revisit" or not said else int(said[1])
                if kind == "revisit":
                    payload = None
                elif http:
                    sha = digest(payload)
                strip = lambda k: (v[1:-1] if (v := f.get(k)) and v[:1] == "<" else v)
                yield (uri, at, strip("warc-record-id"), kind, strip("warc-target-uri"), f.get("warc-date"), sha,
                       strip("warc-refers-to"), size, payload if payloads else None)

    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = pa.schema([(n, pa.int64() if t == "long" else pa.binary() if t == "binary" else pa.string())
                       for n, t in (c.split() for c in SCHEMA.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, size = [], 0
        for b in batches:
            for uri, length, start in zip(*[c.to_pylist() for c in b.columns], strict=True):
                for r in rows(uri, length, start):
                    batch.append(r)
                    size += 200 + len(r[-1] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*batch, strict=True), strict=True)), kinds)
                        batch, size = [], 0
        if batch:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*batch, strict=True), strict=True)), kinds)

    return ranges.mapInArrow(run, SCHEMA)


def page_of(urn: str | None) -> str | None:
    """The id that :func:`record` put into a urn."""
    return unquote(urn.removeprefix(URN)) or None if urn and urn.startswith(URN) else None


def archive_report(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Per page record of an archive: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    r = read_archive(spark, path, payloads=False).filter(F.col("record_type").isin("response", "revisit"))
    # ids of an integer type hold nothing that was escaped
    page = lambda c: F.nullif(F.expr(f"substring({c}, {len(URN) + 1})"), F.lit("")).cast(id_type)
    return r.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to").alias("refers_to"))
