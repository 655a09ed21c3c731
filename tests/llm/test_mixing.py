import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepanel.llm import mixing

SCHEMA = "doc_id long, source string, text string, quota int, cut string, weight string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "w") for r in rows], SCHEMA).repartition(3)


def test_repetition_limit_and_whole_coverage(spark):
    rows = [(i, "big" if i < 800 else "mid" if i < 1000 else "small", "w " * (1 + i % 7)) for i in range(1100)]
    out = mixing.mix_sources(table(spark, rows), max_repeats=2.0).collect()
    copies = Counter(r["doc_id"] for r in out)
    assert set(copies) == {r[0] for r in rows}  # nothing is dropped
    tokens = Counter()
    for r in out:
        tokens[r["source"]] += len(r["text"].split())
    own = Counter()
    for _, s, t in rows:
        own[s] += len(t.split())
    rep = {s: tokens[s] / own[s] for s in own}
    assert rep["big"] == 1 and 1 < rep["mid"] < rep["small"] <= 2 and rep["small"] == pytest.approx(2, abs=0.02)
    assert max(copies.values()) <= 2
    # within a pass the documents of a source stand in permuted blocks, another permutation in each pass
    first = [r["doc_id"] for r in sorted(out, key=lambda r: r["mix_place"]) if r["mix_epoch"] == 0 and r["source"] == "small"]
    second = [r["doc_id"] for r in sorted(out, key=lambda r: r["mix_place"]) if r["mix_epoch"] == 1 and r["source"] == "small"]
    assert first != sorted(first) and [x for x in first if x in second] != second


@pytest.mark.parametrize("budget", [50, 1000, 2500])
def test_budget_is_met_from_below(spark, budget):
    rows = [(i, "ab"[i % 5 == 0], "w " * (1 + i % 9)) for i in range(300)]
    out = mixing.mix_sources(table(spark, rows), max_repeats=3.0, budget_tokens=budget).collect()
    total = sum(len(r["text"].split()) for r in out)
    assert budget - 2 * 10 <= total <= budget


def test_entropy_target(spark):
    sh = spark.createDataFrame([("a", 900, 0.9), ("b", 90, 0.09), ("c", 10, 0.01)], "_mix_s string, n long, p double")
    a = mixing.exponent(sh, target_entropy=0.9)
    q = [p ** a for p in (0.9, 0.09, 0.01)]
    w = [x / sum(q) for x in q]
    assert -sum(x * math.log(x) for x in w) == pytest.approx(0.9, abs=1e-9)
    assert mixing.exponent(sh, target_entropy=5.0) == 0.0


def test_edge_rows(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, "x y"), (3, None, "x y"), (None, "a", "z"), (4, "none", None), (5, "a", "w " * 30000)]
    out = mixing.mix_sources(table(spark, rows), max_repeats=2.0)
    assert {"quota", "cut", "weight"} <= set(out.columns)
    copies = Counter((r["doc_id"], r["source"]) for r in out.collect())
    assert copies[(4, "none")] == 1 and all(copies[(d, s)] >= 1 for d, s, _ in rows) and copies[(3, None)] in (2, 4)
    assert mixing.mix_sources(table(spark, rows).limit(0)).collect() == []


def test_many_sources_are_joined_without_broadcast(spark, monkeypatch):
    rows = [(i, f"s{i % 40}", "w " * (1 + i % 3)) for i in range(400)]
    want = sorted((r["doc_id"], r["mix_epoch"], r["mix_place"]) for r in mixing.mix_sources(table(spark, rows)).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert sorted((r["doc_id"], r["mix_epoch"], r["mix_place"]) for r in mixing.mix_sources(table(spark, rows)).collect()) == want


def test_default_budget_drops_nothing_of_huge_sources(spark):
    n = 3022305636327115  # n * 3 / 3 is n - 1/2 in doubles
    rows = [(1, "a", n - 5), (2, "a", 5), (3, "b", n - 9), (4, "c", n - 11)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    got = mixing.mix_sources(df, tokens=F.col("n")).collect()
    assert {r["doc_id"] for r in got} == {1, 2, 3, 4}
