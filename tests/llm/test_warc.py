import gzip
import hashlib
import base64
import os

import pytest

from tidepanel.llm import warc
from tidepanel.llm.common import scratch_path

ROWS = [(1, "http://a/1", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://a/3\r\nX: y", "é漢😀" * 50), (4, "http://a/4", None),
        (5, "u", ""), (6, "u", "<p>one</p>"), (7, "u", "WARC/1.1\r\n\r\n" * 20), (None, "u", "<p>one</p>"), (None, "u", "only null"),
        (9, "u", "z" * 200_000), (9, "u", "z" * 200_000), (10, "u", "z" * 200_000)]


def want(rows, least=0):
    out = []
    for d, _, h in rows:
        p = (h or "").encode()
        ids = [x for x, _, y in rows if (y or "").encode() == p and x is not None]
        first = min(ids, default=None)
        holds = len(p) < least or first is None or d == first
        out.append((d, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if holds else "revisit", None if holds else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_written_and_read_in_small_ranges(spark, least):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, sha string, salt int").repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write_archive(df, path, min_revisit_bytes=least)
    assert sorted(map(tuple, warc.archive_report(spark, path).collect()), key=str) == want(ROWS, least)
    # however the ranges fall, each record is read once, with its payload
    whole = sorted((r["record_id"], r["record_type"], bytes(r["payload"] or b"")) for r in warc.read_archive(spark, path).collect())
    for size in (97, 1000):
        assert sorted((r["record_id"], r["record_type"], bytes(r["payload"] or b"")) for r in warc.read_archive(spark, path, size).collect()) == whole
    pages = {warc.page_of(a): p for a, k, p in whole if k == "response"}
    assert pages["3"] == ("é漢😀" * 50).encode() and pages["9"] == b"z" * 200_000
    # any gzip reader can read the files, and no temporary file stays
    folder = path.removeprefix("file:")
    files = [f for f in os.listdir(folder) if f.endswith(".warc.gz")]
    text = b"".join(gzip.open(os.path.join(folder, f)).read() for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: re") == len(ROWS) and b"\r\nX: y" not in text
    assert not [f for f in os.listdir(folder) if f.startswith(".part") and not f.endswith(".crc")]


def test_false_magic_and_broken_records(tmp_path):
    good = warc.record("1", "u", b"payload", warc.digest(b"payload"), None, "2000-01-01T00:00:00Z", 6)
    junk = b"\x1f\x8b\x08garbage" + gzip.compress(b"not a record")
    f = tmp_path / "a.warc.gz"
    f.write_bytes(junk + good + junk + good)
    size = f.stat().st_size
    with open(f, "rb") as raw:
        class Handle:
            def read_at(self, n, at):
                raw.seek(at)
                return raw.read(n)
        seen = []
        for lo in range(0, size, 7):
            end = min(lo + 7, size)
            seen += [at for at, _, _ in warc.records_in(warc._Range(Handle(), lo, end, size), lo, end)]
        assert seen == [len(junk), 2 * len(junk) + len(good)]
    f.write_bytes(good[:-6])
    with open(f, "rb") as raw, pytest.raises(ValueError):
        class Handle2:
            def read_at(self, n, at):
                raw.seek(at)
                return raw.read(n)
        n = f.stat().st_size
        list(warc.records_in(warc._Range(Handle2(), 0, n, n), 0, n))


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.archive_report(spark, path).collect() == []
