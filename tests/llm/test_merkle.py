import hashlib
import random
import zlib

import pytest

from tidepanel.llm import merkle, queries
from conftest import SF


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lower(t):
    return t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def tree(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][k:k + fanout])) for k in range(0, len(levels[-1]), fanout)])
    return levels


def way(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        out.append((i % fanout, level[i - i % fanout:i - i % fanout + fanout]))
        i //= fanout
    return out


def brute(rows, fanout=8, tampered=True):
    """rows: (doc_id, source, lang, n_chars, text)"""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted(((r[0] is not None, r[0] or 0, leaf_of(r), r) for r in rows if r[2] == g), key=lambda x: x[:3]) for g in langs}
    trees = {g: tree([x[2] for x in rows], fanout) for g, rows in groups.items()}
    top = tree([trees[g][-1][0] for g in langs], fanout)
    out = []
    for k, g in enumerate(langs):
        for i, (_, _, leaf, r) in enumerate(groups[g]):
            steps = way(trees[g], i, fanout) + way(top, k, fanout)
            hit = tampered and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            seen = leaf_of((*r[:4], lower(r[4]))) if hit else leaf
            for at, run in steps:
                seen = H("".join([*run[:at], seen, *run[at + 1:]]))
            out.append((r[0], leaf, trees[g][-1][0], top[-1][0], H("".join("".join([*run[:at], *run[at + 1:]]) for at, run in steps)),
                        seen, seen == top[-1][0]))
    return sorted(out, key=str)


def awkward(n, seed):
    rnd = random.Random(seed)
    rows = [(i if rnd.random() < .9 else None, None if i % 5 == 0 else "s", rnd.choice([None, "a", "b", "", "é", "z"]) if i % 3 else "hot", i if i % 7 else None,
             rnd.choice(["A", "Bb", "", None, "É Ünder", "x" * 50_000])) for i in range(n)]
    return rows + rows[:n // 10]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_query_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*merkle.COLUMNS)
    assert sorted(map(tuple, queries.op11_merkle(spark, SF).collect()), key=str) == brute(list(map(tuple, docs.collect())))


@pytest.mark.parametrize("fanout, levels, n", [(8, 4, 300), (2, 1, 90), (3, 1, 250)])
def test_rounds_short_runs_nulls_and_repeats(spark, fanout, levels, n):
    """Blocks of few leaves make several rounds, with last subtrees shorter than the others."""
    rows = awkward(n, fanout)
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as g", "2 as leaf", "3 as `a.b`")
    hit = merkle.F.crc32(merkle.F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    seen = [*[merkle.F.col(c) for c in merkle.COLUMNS[:-1]],
            merkle.F.when(hit, merkle.lower_ascii(merkle.F.col("text"))).otherwise(merkle.F.col("text"))]
    m = merkle.build_manifest(docs, "doc_id", "lang", merkle.COLUMNS, seen, fanout=fanout, block_levels=levels)
    want = brute(rows, fanout)
    assert sorted(map(tuple, m.check().collect()), key=str) == want
    assert m.root() == want[0][3]


def test_proofs_of_some_rows_lead_to_the_root(spark):
    rows = [(i, "s", "l", 1, str(i)) for i in range(100)]
    m = merkle.build_manifest(spark.createDataFrame(rows, SCHEMA), "doc_id", "lang", merkle.COLUMNS, fanout=4, block_levels=1)
    got = m.proofs(spark.createDataFrame([(3,), (99,), (3,), (1000,)], "id long")).collect()
    assert sorted(r["id"] for r in got) == [3, 99]
    for r in got:
        node = leaf_of(rows[r["id"]])
        assert node == r["leaf"]
        for s in r["steps"]:
            node = H("".join([*s["run"][:s["at"]], node, *s["run"][s["at"] + 1:]]))
        assert node == r["root"]


def test_no_rows_one_row(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.tamper_report(none).collect() == []
    assert merkle.build_manifest(none, "doc_id", "lang", merkle.COLUMNS).root() is None
    one = [(None, None, None, None, None)]
    assert list(map(tuple, merkle.tamper_report(spark.createDataFrame(one, SCHEMA)).collect())) == brute(one)
