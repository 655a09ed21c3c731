import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidepanel.llm import pair_search, queries
from conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k=50):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for q, t in items:
        asked.setdefault(q, set()).update(terms(t))
    out = []
    for q, ts in asked.items():
        scores = []
        for d, b in bags:
            m = 100 - 50 + (50 * sum(b.values()) * n_docs) // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 20 * m)) for t in ts if b[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(q, r + 1, None if nul else d, -s) for r, (s, nul, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def result(docs, items, **kw):
    return sorted(map(tuple, pair_search.search(docs, items, **kw).collect()), key=str)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    assert sorted(map(tuple, queries.op13_pair_search(spark, SF).collect()), key=str) == brute(docs, items)


@pytest.mark.parametrize("k, pass_terms", [(50, 10**6), (3, 10), (2000, 5)])
def test_ties_nulls_repeats_and_passes(spark, monkeypatch, k, pass_terms):
    rnd = random.Random(3)
    vocabulary = ["a", "B", "c-d", "é", "9x", "zz", "q", "w"]
    docs = [(rnd.choice([i, i, None, i // 2]), " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 9, 30]))) if rnd.random() < .95 else None)
            for i in range(600)] + [(5000, "zz " * 20_000)]
    items = [(i if i else None, " ".join(rnd.sample(vocabulary, rnd.choice([0, 1, 2, 3, 5, 7])))) for i in range(12)]
    items += [(3, "unknown words"), (5, None), (3, "ZZ")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as q", "2 as d", "3 as `x.y`")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as term", "2 as q")
    assert result(d, q, k=k, pass_terms=pass_terms) == brute(docs, items, k)


def test_no_rows(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert pair_search.search(docs.limit(0), items).collect() == []
    assert pair_search.search(docs, items.limit(0)).collect() == []


def test_block_search_skips_and_stays_exact():
    """Whatever the threshold, all documents that reach it are found with their scores; pair bounds let documents be left out
    that term maxima alone could not."""
    rnd = np.random.default_rng(5)
    n, v = 400, 12
    held = rnd.random((n, v)) < np.linspace(.02, .6, v)
    held[:, 1] = ~held[:, 0] & (rnd.random(n) < .03)  # never with term 0
    at, ids = np.nonzero(held)
    tfs = rnd.integers(1, 6, len(at))
    weights = np.linspace(9000, 500, v).astype(np.int64)
    pairs, (mine,) = pair_search._pairs_of([np.arange(v)], weights)
    some = np.flatnonzero(held.any(1))
    sizes = held[some].sum(1)
    length = rnd.integers(20, 400, len(some))
    block = pair_search._Block(some, length, sizes, ids.astype(np.int32), tfs, weights, n, n * 100, pairs)
    true = np.zeros(len(some), np.int64)
    np.add.at(true, block.at, block.impact)
    assert block.joint[0] == max(block.most[0], block.most[1]) < block.most[0] + block.most[1]
    for threshold in [1, *np.quantile(true, [.1, .5, .9, .99]).astype(np.int64).tolist(), int(true.max()), int(true.max()) + 1]:
        docs, score = block.search(pairs, mine, threshold)
        assert docs.tolist() == np.flatnonzero(true >= threshold).tolist() and (score == true[docs]).all()
