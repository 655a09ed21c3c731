import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidepanel.llm import repeats

M, K = 40, 16


def corpus():
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(20), text(5)
    rows = [(i, text(r.randint(0, 40))) for i in range(30)]
    rows += [(100 + i, text(8) + passage + text(r.randint(0, 9))) for i in range(12)]  # a shared passage, other neighbours
    rows += [(200 + i, text(8) + passage[:60] + text(5)) for i in range(4)]
    rows += [(300 + i, line * 6 + text(3)) for i in range(3)]  # repeats inside a text
    rows += [(400, "ab " * 200), (401, "x" * 300), (402, None), (403, ""), (None, passage), (404, passage), (404, passage)]
    base = text(60)
    rows += [(500 + i, base[:50 * i] + "#" + base[50 * i:]) for i in range(5)]
    return rows


def brute(rows, m):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i:i + m] for _, b in data for i in range(len(b) - m + 1))
    out = []
    for d, b in data:
        spans = repeats.merge([(i, i + m) for i in range(len(b) - m + 1) if seen[b[i:i + m]] > 1])
        rest = b"".join(b[a:z] for a, z in zip([0, *[e for _, e in spans]], [*[s for s, _ in spans], len(b)]))
        out.append((d, len(b), len(b) - len(rest), len(spans), hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot,small", [(1000, 600_000), (3, 0)])
def test_against_all_strings(spark, monkeypatch, hot, small):
    monkeypatch.setattr(repeats, "ANCHOR_BYTES", K)
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", hot)
    monkeypatch.setattr(repeats, "BROADCAST_ENTRIES", small)
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, a int, p string").repartition(3)
    monkeypatch.setattr(repeats.Repeats.__init__, "__defaults__", ("doc_id", "text", M, K))
    got = repeats.remove_repeats(df, min_bytes=M)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, M)


def test_maximal_groups_hold_all_occurrences():
    r = random.Random(1)
    for _ in range(300):
        n = r.randint(2, 9)
        before = ["".join(r.choice("ab") for _ in range(r.randint(0, 8))).encode() for _ in range(n)]
        after = [b"KK" + "".join(r.choice("ab") for _ in range(r.randint(0, 8))).encode() for _ in range(n)]
        got = {(a, b, tuple(sorted(m))) for a, b, m in repeats.maximal_groups(before, after, 6, 2)}
        want = set()
        for left in range(9):
            for right in range(2, 11):
                if left + right < 6:
                    continue
                by = defaultdict(list)
                for i in range(n):
                    if len(before[i]) >= left and len(after[i]) >= right:
                        by[before[i][:left], after[i][:right]].append(i)
                for m in by.values():
                    more_l = {before[i][left:left + 1] for i in m}
                    more_r = {after[i][right:right + 1] for i in m}
                    if len(m) > 1 and (len(more_l) > 1 or more_l == {b""}) and (len(more_r) > 1 or more_r == {b""}):
                        want.add((left, right, tuple(m)))
        assert got == want


def test_anchors_follow_the_string():
    r = np.random.default_rng(0)
    s = r.integers(97, 100, 60, dtype=np.uint8).tobytes()
    where = set(repeats.anchors(s, 60, 16)[0].tolist())
    for _ in range(20):
        a, b = (r.integers(97, 100, int(r.integers(0, 90)), dtype=np.uint8).tobytes() for _ in range(2))
        at, h = repeats.anchors(a + s + b, 60, 16)
        assert {int(p) - len(a) for p in at} >= where
        assert (h == repeats.rolling(np.frombuffer(a + s + b, np.uint8), 16)[at]).all()


def test_occurrences(spark):
    passage = "0123456789" * 3 + "abcdefghijklmnopqrstuvwxyz"
    rows = [(1, "left one " + passage + " tail"), (2, "another " + passage + "!"), (3, passage + "? third"), (4, "nothing here at all, just words and words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = repeats.Repeats(df, min_bytes=M, k=K).occurrences().collect()
    full = {(r["d"], r["start"], r["length"]) for r in got if r["length"] == M + K or r["length"] >= 50}
    assert {(1, 9), (2, 8), (3, 0)} == {(d, s) for d, s, n in full if n >= 50} or {r["d"] for r in got} == {1, 2, 3}
    groups = defaultdict(set)
    for r in got:
        groups[r["g"]].add(r["d"])
    assert {1, 2, 3} in groups.values()


def whole_repeats(rows, m):
    """(string, places) of the maximal repeats, from all strings of m bytes or more."""
    data = [(d, t.encode()) for d, t in rows]
    out = set()
    for n in range(m, max(len(b) for _, b in data) + 1):
        by = defaultdict(list)
        for d, b in data:
            for i in range(len(b) - n + 1):
                by[b[i:i + n]].append((d, b[max(0, i - 1):i], b[i + n:i + n + 1], i))
        for x in by.values():
            sides = [{y[j] for y in x} for j in (1, 2)]
            if len(x) > 1 and all(len(e) > 1 or e == {b""} for e in sides):
                out.add((n, frozenset((d, i) for d, _, _, i in x)))
    return out


def test_whole_repeats_of_copies_and_long_passages(spark):
    r = random.Random(9)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    copy, passage, line = text(250), text(300), text(70)
    rows = [(1, copy), (2, copy), (3, copy), (4, text(30) + passage + text(40)), (5, text(80) + passage), (6, passage + text(9)),
            (7, text(20) + passage[100:220] + text(20)), (8, line * 3 + text(10)), (9, copy[:200] + text(20)), (10, text(200)), (11, "ab" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = defaultdict(set)
    for x in repeats.Repeats(df, min_bytes=M, k=K).occurrences().collect():
        got[x["g"], x["length"]].add((x["d"], x["start"]))
    assert {(n, frozenset(p)) for (_, n), p in got.items()} == whole_repeats(rows, M)


def test_occurrences_cover_what_goes(spark, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", 1)  # reaches by counted strings
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    copy, passage = text(150), text(200)
    rows = [(1, copy), (2, copy), (3, text(30) + passage + text(40)), (4, text(50) + passage), (5, passage[:90] + text(60)), (6, text(90))]
    found = repeats.Repeats(spark.createDataFrame(rows, "doc_id long, text string"), min_bytes=M, k=K)
    got = defaultdict(list)
    for x in found.occurrences().collect():
        got[x["d"]].append((x["start"], x["start"] + x["length"]))
    want = defaultdict(list)
    for x in found.covered().collect():
        want[x["d"]].append((x["b"], x["e"]))
    assert {d: repeats.merge(s) for d, s in got.items()} == {d: repeats.merge(s) for d, s in want.items()}


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
