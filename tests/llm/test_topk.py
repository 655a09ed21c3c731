import math
import random

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import topk

SCHEMA = "vec_id long, embedding array<double>, cls int, score string"


def brute(rows, k, every):
    ok = {}
    for v, x in rows:
        if v is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        x = [math.floor(c * 256) for c in x]
        ok[v] = min(ok.get(v, x), x)
    out = []
    for q, x in ok.items():
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in ok.items() if v != q)
            out += [(q, i + 1, v, -n) for i, (n, v) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, k=5, every=7, **how):
    df = spark.createDataFrame([(v, x, 1, "s") for v, x in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, topk.top_inner_products(df, F.col("v") % every == 0, k=k, **how).collect()))


@pytest.mark.parametrize("block_rows", [None, 16])
def test_against_all_products(spark, block_rows):
    r = random.Random(3)
    rows = [(i, [r.gauss(0, 1) * (1 + i % 5) for _ in range(12)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 12) for i in range(60)]  # copies: ties go to the smaller id
    rows += [(400, None), (401, [1.0, None] + [0.0] * 10), (402, [float("nan")] * 12), (403, [float("inf")] + [0.0] * 11), (None, [1.0] * 12),
             (404, [0.0] * 12), (405, [-1.0] * 12), (7, [0.0] * 12), (406, [2.0, 3.0]), (407, [])]
    assert run(spark, rows, block_rows=block_rows) == brute(rows, 5, 7)


def test_products_beyond_doubles_and_few_rows(spark):
    rows = [(0, [3e9, 1.0]), (1, [3e9, 2.0]), (2, [3e9, 3.0])]
    got = run(spark, rows, every=1)
    assert [x[:3] for x in got if x[0] == 0] == [(0, 1, 2), (0, 2, 1)]
    assert run(spark, [(0, [1.0])], every=1) == [] and run(spark, [], every=1) == []


def test_products_under_and_over_a_long(spark):
    """Ranks follow the whole products, also where the scores shown are the ends of a long."""
    r = random.Random(8)
    rows = [(i, [r.choice([-1, 1]) * r.randrange(1, 10) * 10.0 ** r.choice([0, 3, 7, 7.3, 8, 9]) + 1 / 256 * r.randrange(256) for _ in range(3)]) for i in range(150)]
    rows += [(200, [1e9, 1e9, 1e9]), (201, [1e9, 1e9, 1e9]), (203, [-1e9, -1e9, -1e9]), (210, [1e9, 1e9, 1e9 + 1 / 256])]
    ends = (-(1 << 63), (1 << 63) - 1)
    for block_rows, k in ((None, 5), (8, 5), (16, 200)):
        got = run(spark, rows, k=k, block_rows=block_rows)
        want = [(q, n, v, min(max(s, ends[0]), ends[1])) for q, n, v, s in brute(rows, k, 7)]
        assert got == want and any(x[3] in ends for x in got) and any(abs(x[3]) < 2**53 for x in got)
