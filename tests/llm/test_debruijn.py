import hashlib
import random
import re

import pytest

from tidepanel.llm import debruijn, queries
from conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, span=13):
    def rank(d):
        return (d is None, d or 0)
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - span + 1):
            k = tuple(w[i:i + span])
            first[k] = min(first.get(k, rank(d)), rank(d))
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for i in range(len(w) - span + 1):
            if first[tuple(w[i:i + span])] < rank(d):
                gone[i:i + span] = [True] * span
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def result(docs, **kw):
    return sorted(map(tuple, debruijn.remove_earlier(docs, **kw).collect()), key=str)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = sorted(map(tuple, queries.op12_debruijn(spark, SF).collect()), key=str)
    assert got == brute(list(map(tuple, docs.collect()))) and any(r[2] for r in got)


@pytest.mark.parametrize("span, piece, letters", [(13, 6, "ab"), (5, 2, "ab"), (3, 3, "abc"), (2, 1, "abcdefgh")])
def test_branching_texts(spark, span, piece, letters):
    """Few words make many branches, loops and periodic runs; ids are null, repeated and out of order."""
    rnd = random.Random(span)
    rows = [(rnd.choice([i, i, 300 - i, None, i // 2]), " ".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 8, 30, 60])))
             if rnd.random() < .95 else None) for i in range(200)]
    rows += [*rows[:20], (7, "x " * 3000), (9, "x " * 2999), (-1, "  y\x0bz\x0c  y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as r", "2 as t", "3 as anchors", "4 as d")
    assert result(docs, span=span, piece=piece) == brute(rows, span)


def test_passage_of_fifty_words_and_kept_text(spark):
    rnd = random.Random(1)

    def words(n):
        return [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage, own = words(50), [words(40) for _ in range(30)]
    rows = [(i, " ".join(own[i][:20] + passage + own[i][20:])) for i in range(30)] + [(100, " ".join(own[0] + words(5))), (101, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in debruijn.remove_earlier(docs, keep_text=True).collect()}
    assert got[0]["n_removed"] == 0 and got[101]["n_words"] == 0
    assert all(got[i]["n_removed"] == 50 and got[i]["kept"] == " ".join(own[i]) for i in range(1, 30))
    assert got[100]["n_removed"] == 40


def test_spans_are_whole_paths(spark):
    """A passage of three documents is one path, with one span in each later one."""
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, " ".join([f"a{i}", f"b{i}", *passage, f"c{i}"])) for i in range(3)]
    got = {r["doc_id"]: r["spans"] for r in debruijn.list_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == [] and all([tuple(s) for s in got[i]] == [(2, 60, 0)] for i in (1, 2))


def test_texts_are_not_shuffled(spark):
    """The slices' texts come from the bucketed table: every exchange is of anchors, edges or paths."""
    df = debruijn.remove_earlier(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffled and "Bucketed: true" in plan
    for block in plan.split("Exchange")[1:]:
        assert "FileScan parquet [slice" not in block.splitlines()[1]


def test_no_rows(spark):
    assert debruijn.remove_earlier(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert result(spark.createDataFrame([(None, None), (1, "")], "doc_id long, text string")) == brute([(None, None), (1, "")])


def test_words_of_any_length():
    long = [b"x" * n for n in (1, 2, (1 << 16) - 1, 1 << 16, (1 << 16) + 1, (1 << 20) + 5, 3 << 20)]
    words = [b"ab", *long, b"ab", b"\xc3\xa9", b"ba", *long[::-1], b"a", b"a\x00", b"ab"]
    data = b"  " + b" \t\x0b".join(words) + b"\n"
    first, h = debruijn._words(data)
    assert [data[f:f + len(w)] for f, w in zip(first, words)] == words and len(first) == len(words)
    for i, a in enumerate(words):
        assert [int(x) == int(h[i]) for x in h] == [a == b for b in words]
