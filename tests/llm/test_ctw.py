import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import ctw

ROWS = [(1, "the cat sat on the mat"), (2, "The cat SAT"), (3, None), (4, ""), (5, "été à la mer"), (5, "été à la mer"),
        (None, "on the mat"), (7, "unseen \x0b words\tzz"), (8, "a\x00b"), (9, "ab " * 3000), (10, "no break\x1cstays")]
HELD = {2, 7}


def brute(rows, depth):
    """Direct recursion over a dictionary of nodes."""
    data = [(d, (t or "").encode().lower()) for d, t in rows]
    grams = lambda t: [s[i:i + depth + 1] for s in [b"\xff" * depth + t + b"\xff"] for i in range(len(s) - depth)]
    count = Counter(g for d, t in data if d not in HELD for g in grams(t))
    nodes, kids = {}, {}
    for g, n in count.items():
        for d in range(depth + 1):
            for i in range(8):
                nodes.setdefault((g[depth - d:depth], (1 << i) | (g[-1] >> (8 - i))), [0, 0])[(g[-1] >> (7 - i)) & 1] += n
    for c, q in nodes:
        if c:
            kids.setdefault((c[1:], q), []).append((c, q))
    lg = math.lgamma
    kt = {k: lg(a + .5) + lg(b + .5) - lg(a + b + 1) - math.log(math.pi) for k, (a, b) in nodes.items()}
    lw, split = {}, {}
    for k in sorted(nodes, key=lambda k: -len(k[0])):
        if len(k[0]) == depth:
            lw[k] = kt[k]
        else:
            split[k] = sum(lw[x] for x in kids[k])
            m = max(split[k], kt[k])
            lw[k] = m + math.log(math.exp(split[k] - m) + math.exp(kt[k] - m)) - math.log(2)

    def one(g, q, d):
        k = (g[depth - d:depth], q)
        if k not in nodes:
            return .5
        a, b = nodes[k]
        p = (b + .5) / (a + b + 1)
        if d == depth:
            return p
        w = 1 / (1 + math.exp(min(700, split[k] - kt[k])))
        return w * p + (1 - w) * one(g, q, d + 1)

    words = Counter()
    for d, t in data:
        if d not in HELD:
            words.update([*t.split(), b" end"])
    n, v = sum(words.values()), len(words)
    out = []
    for d, t in data:
        tokens = [*t.split(), b" end"]
        lp = 0.0
        for g in grams(t):
            for i in range(8):
                p = one(g, (1 << i) | (g[-1] >> (8 - i)), 0)
                lp += math.log10(p if (g[-1] >> (7 - i)) & 1 else 1 - p)
        out.append((d, d in HELD, len(tokens), sum(words[w] > 0 for w in tokens), n, sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens), lp))
    return out


@pytest.mark.parametrize("shared", [True, False])
def test_against_direct_recursion(spark, monkeypatch, shared):
    if not shared:
        monkeypatch.setattr(ctw, "BROADCAST_STRINGS", 0)
    df = spark.createDataFrame([(*r, 1, "x") for r in ROWS], "doc_id long, text string, b int, g string").repartition(3)
    got = ctw.score_texts(df, F.col("doc_id").isin(*HELD), depth=3, block_rows=2).collect()
    key = lambda r: (str(r[0]), r[6])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(brute(ROWS, 3), key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in ctw.score_texts(df, F.lit(True)).collect()}
    assert got[1]["score"] == pytest.approx(3 * 8 * math.log10(.5)) and got[2]["score"] == pytest.approx(8 * math.log10(.5))
    assert got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0 and got[1]["base_score"] == 0.0
    assert ctw.score_texts(df.limit(0)).collect() == []


def test_prediction_sums_to_one(spark):
    """The probabilities of all next bytes after a context add up to one."""
    strings = [((97 << 16) | (98 << 8) | s, 5 if s == 99 else 0) for s in range(256)]
    df = spark.createDataFrame(strings, "g long, n long")
    assert sum(10 ** r["lp"] for r in ctw.string_probabilities(df, 2).collect()) == pytest.approx(1)


def test_fold(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "doc_id long")
    got = {r[0]: r[1] for r in df.select("doc_id", ctw.fold_held_out("doc_id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(50)}
