import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import graph, order_minhash as omh


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        new = [0]
        for j, b in enumerate(y):
            new.append(row[j] + 1 if a == b else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def alike(x, y, s=0.8):
    c = lcs(x, y)
    return c * (1 + s) >= s * (len(x) + len(y)) - 1e-9 and bool(len(x)) and bool(len(y))


def near_copies(r, n=40):
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for g in range(6):
        base = [r.choice(words) for _ in range(r.choice([60, 90, 150]))]
        for _ in range(n // 6):
            t = list(base)
            for _ in range(r.randint(0, 5)):
                k, p = r.randint(0, 2), r.randrange(len(t))
                t[p:p + (k != 1)] = [] if k == 0 else [r.choice(words)]
            rows.append((i, " ".join(t)))
            i += 1
        rows.append((i, " ".join(base[len(base) // 2:] + base[:len(base) // 2])))  # the same words, moved
        i += 1
    return rows


def classes_of(rows):
    seqs = {i: omh.shingles(t).tolist() for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, a in rows:
        for j, b in rows:
            if i < j and ((a or "") == (b or "") or alike(seqs[i], seqs[j])):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i, _ in rows}


def test_alignment_against_the_full_table():
    r = random.Random(5)
    for _ in range(400):
        x = [r.randrange(30) for _ in range(r.randint(1, 40))]
        y = [v for v in x if r.random() > 0.08]
        for _ in range(r.randint(0, 4)):
            y.insert(r.randint(0, len(y)), r.randrange(30))
        if y:
            assert omh.similar(x, y) == alike(x, y)


def test_shingles_are_labelled_and_in_order():
    a = omh.shingles("a b c d e a b c d e")
    assert len(a) == 6 and len(set(a.tolist())) == 6
    assert omh.shingles("A  b\nc d e").tolist() == a[:1].tolist()
    assert len(omh.shingles("two words")) == 1 and len(omh.shingles("")) == 0 and len(omh.shingles(None)) == 0


def test_sketch_sees_order():
    """Moving halves keeps nearly all shingles but few ordered sketches."""
    r = random.Random(0)
    words = [f"w{i}" for i in range(300)]
    r.shuffle(words)
    x, y = omh.shingles(" ".join(words)), omh.shingles(" ".join(words[150:] + words[:150]))
    z = omh.shingles(" ".join(words[:150] + ["new"] + words[150:]))
    same = lambda p, q: sum(a == b for a, b in zip(omh.sketch(p, 200), omh.sketch(q, 200)))
    assert len(set(x.tolist()) & set(y.tolist())) > 290
    assert same(x, z) > 150 and same(x, y) < 60


def test_classes_against_all_pairs(spark):
    rows = near_copies(random.Random(7))
    rows += [(500, rows[0][1]), (501, rows[0][1]), (502, None), (503, ""), (504, "short text"), (505, "Short  text"), (506, "of one"),
             (507, "big " * 3 + " ".join(f"x{i}" for i in range(20000))), (508, " ".join(f"x{i}" for i in range(20000)))]
    df = spark.createDataFrame([(*x, 1, "s") for x in rows], "doc_id long, text string, lead int, h string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in omh.near_duplicate_classes(df).collect()}
    want = classes_of([x for x in rows if x[0] < 507])
    want |= {507: 507, 508: 507}
    assert got == want
    kept = {r["doc_id"] for r in omh.deduplicate(df).collect()}
    assert kept == set(want.values())


@pytest.mark.parametrize("stars", [0, 1, 2])
def test_large_groups_give_the_same_classes(spark, monkeypatch, stars):
    rows = near_copies(random.Random(9), 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r["doc_id"]: r["class_id"] for r in omh.near_duplicate_classes(df).collect()}
    assert want == classes_of(rows)
    monkeypatch.setattr(omh, "BLOCK_TEXTS", 3)
    monkeypatch.setattr(omh, "STARS", stars)
    assert {r["doc_id"]: r["class_id"] for r in omh.near_duplicate_classes(df).collect()} == want


def test_a_passage_in_most_texts(spark, monkeypatch):
    """Texts that share a long passage meet under one leader; chains of near copies among them stay connected."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(2000)]
    passage = [r.choice(words) for _ in range(60)]
    rows = []
    for g in range(12):
        own = [r.choice(words) for _ in range(60)]
        for step in range(6):  # each step is near the one before, the last far from the first
            at = r.randrange(len(own) - 4)
            own = own[:at] + [r.choice(words) for _ in range(3)] + own[at + 3:]
            rows.append((len(rows), " ".join(passage + own)))
    rows += [(len(rows) + i, " ".join(passage + [r.choice(words) for _ in range(i % 9)])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(omh, "BLOCK_TEXTS", 4)
    assert {x["doc_id"]: x["class_id"] for x in omh.near_duplicate_classes(df).collect()} == classes_of(rows)


def test_similar_texts_share_a_prefix_shingle():
    r = np.random.default_rng(4)
    for _ in range(300):
        x = np.unique(r.integers(0, 2 ** 31, r.integers(1, 80), dtype=np.uint32))
        y = np.unique(np.concatenate([x[r.random(len(x)) > 0.1], r.integers(0, 2 ** 31, r.integers(0, 8), dtype=np.uint32)]))
        last = np.unique(np.concatenate([x[r.random(len(x)) > 0.5], y[r.random(len(y)) > 0.5]]))
        if len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)):
            assert set(omh.prefix(x, last).tolist()) & set(omh.prefix(y, last).tolist())


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text), (1, text), (None, text), (None, "only here and nowhere else at all"), (2, "else"), (2, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = omh.near_duplicate_classes(df).collect()
    assert len(got) == 6 and sorted(str(r["class_id"]) for r in got) == ["1", "1", "1", "2", "2", "None"]
    kept = sorted((str(r["doc_id"]), r["text"]) for r in omh.deduplicate(df).collect())
    assert kept == [("1", text), ("2", "else"), ("2", "other words"), ("None", "only here and nowhere else at all")]
    assert omh.near_duplicate_classes(df.limit(0)).collect() == [] and omh.deduplicate(df.limit(0)).collect() == []


def test_group_links_connect_what_pairs_connect():
    r = np.random.default_rng(1)
    base = r.integers(0, 2 ** 31, 100, dtype=np.uint32)
    seqs = []
    for _ in range(30):
        x = base.copy()
        x[r.integers(0, 100, r.integers(0, 25))] = r.integers(0, 2 ** 31)
        seqs.append(np.unique(x)[np.argsort(np.unique(x, return_index=True)[1])])
    links = omh.group_links(np.arange(30), seqs)
    nodes = {i: i for i in range(30)}
    for a, b in links:
        assert alike(seqs[a].tolist(), seqs[b].tolist())
        old, new = nodes[a], nodes[b]
        nodes = {k: new if v == old else v for k, v in nodes.items()}
    for i in range(30):
        for j in range(i):
            if alike(seqs[i].tolist(), seqs[j].tolist()):
                assert nodes[i] == nodes[j]
    assert len(links) < 30


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(40)] + [(900, x) for x in range(901, 960)]
    df = spark.createDataFrame(links, "u long, v long")
    root = {}
    for a, b in links:
        root.setdefault(a, {a}), root.setdefault(b, {b})
        s = root[a] | root[b]
        for x in s:
            root[x] = s
    got = {x["node"]: x["root"] for x in graph.components(df).collect()}
    assert got == {x: min(s) for x, s in root.items() if len(s) > 1}
    assert graph.components(df.filter(F.lit(False))).collect() == []


def test_group_minimum_of_a_hot_key(spark):
    df = spark.createDataFrame([("hot", i) for i in range(500, 1000)] + [("a", 3), ("a", None), ("n", None)], "k string, v long")
    got = {(r["k"], r["m"]) for r in graph.with_group_min(df, "k", "v", "m", "v").collect()}
    assert got == {("hot", 500), ("a", 3), ("n", None)}
