"""op7 with its production lengths (400-byte strings, 160-byte anchors) against a plain count of all strings."""
import hashlib
from collections import Counter

from tidepanel.llm import queries
from conftest import SF2


def brute(rows, n=400):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter()
    for _, b in texts:
        seen.update(hash(b[i:i + n]) for i in range(len(b) - n + 1))
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[hash(b[i:i + n])] > 1:
                gone[i:i + n] = b"\x01" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_production_lengths_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF2}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.op7_repeats(spark, SF2).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == brute(rows) and sum(r[2] > 0 for r in got) > 50
