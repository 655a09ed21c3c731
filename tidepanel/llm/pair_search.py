"""Ranked lexical search with maxima of term pairs (MaxScore with pair bounds).

Documents are read in blocks of some thousand.  A block's index holds, for each
term that a query has, its documents and impacts (the term's share of their scores)
with the largest one, and for each term pair of a query an intersection list: the
documents with both terms, and the largest joint impact.  A document of a block has
at most ``joint`` from a pair if it is on the pair's list, and at most ``single``,
the larger of the two maxima, if it is not.

Per query and block, pairs are taken in the order of what they can add.  As long as
the sum of joint bounds stays below the query's threshold (the score of its k-th best
so far), no document has to be looked up for them.  Then, as long as the sum with
``single`` bounds stays below it, only the documents on the pairs' lists have to be.
All postings are read only of the pairs beyond.  With term maxima alone the second
step would end where the sum of both maxima reaches the threshold.  Documents found
are summed up pair by pair, and dropped once what is left cannot bring them to the
threshold.

The threshold starts from a pilot, a fixed share of the documents scored first, whose
k-th best can only be lower than that of all; so it never changes a result.  A task
keeps the k best of each query and hands on those; ties go to the smaller id throughout.

Defined results: a null text has no terms; a query without known terms has no rows; rows of
equal document ids are all ranked, each with the counts of its own text; null ids come
last among ties; a query id that repeats is one query of all its terms; a null query id
is a query like any other; N, L and df count rows.  Other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path, ship_package, slices

TOP = 50
#: Query terms that are read at a time (with repeats in other queries); queries beyond are a further pass over the index.
PASS_TERMS = 500_000
PILOT = 32  # one in so many documents
BLOCK = 4096
SALTS = 16
SLICE_BYTES = 8 << 20
#: Bytes of terms: ASCII digits and letters and all of UTF-8 beyond ASCII; A-Z is lower-cased, everything else parts terms.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def weight(n_docs: Column, df: Column) -> Column:
    """Weight of a term that ``df`` of ``n_docs`` documents hold."""
    return F.floor(1000 * F.log((2 * n_docs + 2) / (2 * df + 1).cast("double"))).cast("long")


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(q, term): each term of each query once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], 1, SLICE_BYTES):
                at, found = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    new = sorted(set(terms(text)))
                    at += [k] * len(new)
                    found += new
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.binary()).cast(pa.string())], names=["q", "term"])

    kind = queries.schema[id_col].dataType.simpleString()
    return queries.select(F.col(f"`{id_col}`").alias("q"), F.col(f"`{text_col}`").alias("t")).mapInArrow(run, f"q {kind}, term string").distinct()


def postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: Sequence[bytes], path: str) -> None:
    """Write the terms of every document that are in ``vocabulary``: kind 0 and (of the pilot) 2: (d, n, ids, tfs), of those that have any;
    kind 1, of a slice: documents with terms (d), terms (n), and for each known term (ids) the documents with it (tfs)."""
    known = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            for part in slices([batch], 1, SLICE_BYTES):
                df, some, total, rows = Counter(), 0, 0, []
                for d, text, pilot in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    words = terms(text)
                    some += bool(words)
                    total += len(words)
                    tf = Counter(filter(None.__ne__, map(number.get, words)))
                    if tf:
                        df.update(tf.keys())
                        rows.append((2 if pilot else 0, d, len(words), list(tf.keys()), list(tf.values())))
                rows.append((1, some, total, list(df.keys()), list(df.values())))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)],
                                                 names=["kind", "d", "n", "ids", "tfs"])

    d = F.col(f"`{id_col}`").cast("long")
    text = F.col(f"`{text_col}`").alias("t")
    in_pilot = F.pmod(F.xxhash64(d), F.lit(PILOT)) == 0
    (docs.select(d.alias("d"), text, F.coalesce(in_pilot, F.lit(False)).alias("p"))
     .mapInArrow(run, "kind byte, d long, n long, ids array<int>, tfs array<long>").write.partitionBy("kind").parquet(path))


_KINDS = (pa.int8(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))


class _Block:
    """Index of a block: postings and impacts by term, and the intersection lists of the asked pairs."""

    def __init__(self, d: np.ndarray, n: np.ndarray, sizes: np.ndarray, ids: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, n_docs: int, n_terms: int, pairs: np.ndarray):
        self.d = d
        m = 50 + (50 * n * n_docs) // n_terms
        at = np.repeat(np.arange(len(d)), sizes)
        impact = weights[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m[at]))
        order = np.argsort(ids, kind="stable")
        self.at, self.impact = at[order], impact[order]
        self.start = np.searchsorted(ids[order], np.arange(len(weights) + 1))
        have = np.flatnonzero(np.diff(self.start))
        self.most = np.zeros(len(weights), np.int64)
        self.most[have] = np.maximum.reduceat(self.impact, self.start[have]) if len(have) else 0
        self.lists, self.single, self.joint = [], np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        for k, (a, b) in enumerate(pairs):
            self.single[k] = max(self.most[a], self.most[b] if b >= 0 else 0)
            both, joint = self._both(a, b)
            self.lists.append(both)
            self.joint[k] = max(self.single[k], joint)

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.start[term], self.start[term + 1]
        return self.at[lo:hi], self.impact[lo:hi]

    def _both(self, a: int, b: int) -> tuple[np.ndarray, int]:
        if b < 0 or not self.most[a] or not self.most[b]:
            return self.at[:0], 0
        (at_a, x), (at_b, y) = self.of(a), self.of(b)
        if len(at_a) > len(at_b):
            (at_a, x), (at_b, y) = (at_b, y), (at_a, x)
        place = np.minimum(np.searchsorted(at_b, at_a), len(at_b) - 1)
        hit = at_b[place] == at_a
        return at_a[hit], int((x[hit] + y[place[hit]]).max(initial=0))

    def search(self, pairs: np.ndarray, members: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents' places, scores) of all that can score ``threshold`` (1 at least) or more, with exact scores.

        ``pairs``: all pairs' terms; ``members``: this query's pairs.
        """
        members = members[self.joint[members] > 0]
        members = members[np.argsort(self.joint[members], kind="stable")]
        joint, single = self.joint[members], self.single[members]
        upto = np.concatenate([[0], np.cumsum(joint)])
        if upto[-1] < threshold:
            return self.at[:0], self.impact[:0]
        free = int(np.searchsorted(upto, threshold, "left")) - 1  # pairs that need no look-up
        some = upto[free] + np.cumsum(single[free:])
        listed = free + int(np.searchsorted(some, threshold, "left"))  # up to here, only documents with both terms
        found = np.zeros(len(self.d), bool)
        for k in members[free:listed]:
            found[self.lists[k]] = True
        for k in members[listed:]:
            for t in pairs[k]:
                if t >= 0:
                    found[self.of(t)[0]] = True
        docs = np.flatnonzero(found)
        score = np.zeros(len(docs), np.int64)
        for step in range(len(members) - 1, -1, -1):
            if not len(docs):
                break
            for t in pairs[members[step]]:
                if t >= 0 and self.most[t]:
                    at, x = self.of(t)
                    place = np.minimum(np.searchsorted(at, docs), len(at) - 1)
                    score += np.where(at[place] == docs, x[place], 0)
            stay = score + upto[step] >= threshold
            if not stay.all():
                docs, score = docs[stay], score[stay]
        return docs, score


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(d, null d, n, sizes, ids, tfs) of up to BLOCK documents."""
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK):
            d, n, ids, tfs = batch.slice(lo, BLOCK).columns
            yield (pa.compute.fill_null(d, 0).to_numpy(zero_copy_only=False), d.is_null().to_numpy(zero_copy_only=False), n.to_numpy(zero_copy_only=False),
                   np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy(), tfs.flatten().to_numpy())


def _best(score: np.ndarray, d: np.ndarray, nul: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best: higher score, then smaller id, null ids last."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
        return some[_best(score[some], d[some], nul[some], k)] if len(some) < len(score) else np.lexsort((d, nul, -score))[:k]
    return np.lexsort((d, nul, -score))[:k]


def _scan(index: DataFrame, task: dict, k: int, floor: dict[int, int]) -> DataFrame:
    """(q, nul, d, score): each task's ``k`` best of every query, of those that reach the query's ``floor``."""
    sent = index.sparkSession.sparkContext.broadcast((task, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, floor = sent.value
        pairs, members = t["pairs"], t["members"]
        best = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)] * len(members)
        least = [max(1, floor.get(q, 1)) for q in range(len(members))]
        for d, nul, n, sizes, ids, tfs in _blocks(batches):
            block = _Block(d, n, sizes, ids, tfs, t["weights"], t["n_docs"], t["n_terms"], pairs)
            for q, mine in enumerate(members):
                at, score = block.search(pairs, mine, least[q])
                if len(at):
                    s, i, z = (np.concatenate(x) for x in zip(best[q], (score, d[at], nul[at]), strict=True))
                    top = _best(s, i, z, k)
                    best[q] = (s[top], i[top], z[top])
                    if len(top) == k:
                        least[q] = max(least[q], int(s[top[-1]]))
        for q, (s, i, z) in enumerate(best):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), q, np.int32)), pa.array(z), pa.array(i), pa.array(s)], names=["q", "nul", "d", "score"])

    return index.mapInArrow(run, "q int, nul boolean, d long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query, over salts first, with ``rank``."""
    order = [F.desc("score"), F.asc("nul"), F.asc("d")]
    some = found.withColumn("_s", F.pmod(F.xxhash64("d"), F.lit(SALTS)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("q", "_s").orderBy(*order))).filter(F.col("rank") <= k)
    return some.drop("_s").withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= k)


def _pairs_of(queries: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Term pairs, (t, -1) for a term alone, and each query's: neighbours in the order of weight."""
    number: dict[tuple[int, int], int] = {}
    members = []
    for q in queries:
        q = q[weights[q] > 0]
        q = q[np.lexsort((q, -weights[q]))].tolist()
        mine = [(a, b) for a, b in zip(q[::2], [*q[1::2], *[-1] * (len(q) % 2)], strict=True)]
        members.append(np.array([number.setdefault(p, len(number)) for p in mine], np.int64))
    return np.array(list(number), np.int64).reshape(-1, 2), members


def search(docs: DataFrame, queries: DataFrame, k: int = TOP, doc_id: str = "doc_id", doc_text: str = "text",
           query_id: str = "item_id", query_text: str = "text", pass_terms: int = PASS_TERMS) -> DataFrame:
    """(query id, rank, doc_id, score): each query's ``k`` best documents with a score above 0.

    All documents are ranked.  Queries are dealt by a hash of their id into passes of about ``pass_terms`` terms,
    whose terms are sent to all tasks; each pass reads the documents anew.
    """
    spark = docs.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "search-queries")
    query_terms(queries, query_id, query_text).write.parquet(path)
    asked = spark.read.parquet(path)
    passes = max(1, -(-asked.count() // pass_terms))
    out = None
    for p in range(passes):
        rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(passes)) == p)
        found = _pass(docs, rows, k, doc_id, doc_text)
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("q").alias(query_id), "rank", F.col("d").alias(doc_id), "score")


def _pass(docs: DataFrame, rows: DataFrame, k: int, doc_id: str, doc_text: str) -> DataFrame:
    spark = docs.sparkSession
    asked = rows.groupBy("q").agg(F.collect_list("term").alias("terms")).collect()  # bounded by pass_terms
    vocabulary = sorted({t for row in asked for t in row["terms"]})
    path = scratch_path(spark, "search-postings")
    postings(docs, doc_id, doc_text, [t.encode() for t in vocabulary], path)
    table = spark.read.schema("d long, n long, ids array<int>, tfs array<long>, kind int").parquet(path)
    counts = table.filter("kind = 1")
    n_docs, n_terms = counts.agg(F.coalesce(F.sum("d"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    held = counts.select(F.explode(F.arrays_zip("ids", "tfs")).alias("x")).groupBy("x.ids").agg(F.sum("x.tfs").alias("df"))
    for t, w in held.select("ids", weight(F.lit(n_docs), F.col("df"))).collect():  # at most a row for each query term
        weights[t] = w
    number = {t: i for i, t in enumerate(vocabulary)}
    pairs, members = _pairs_of([np.array([number[t] for t in row["terms"]], np.int64) for row in asked], weights)
    task = {"pairs": pairs, "members": members, "weights": weights, "n_docs": n_docs, "n_terms": max(n_terms, 1)}
    index = table.select("d", "n", "ids", "tfs")
    pilot = _ranked(_scan(index.filter("kind = 2"), task, k, {}), k).filter(F.col("rank") == k)
    floor = {r["q"]: r["score"] for r in pilot.select("q", "score").collect()}
    best = _ranked(_scan(index.filter("kind in (0, 2)"), task, k, floor), k)
    kind = rows.schema["q"].dataType.simpleString()
    names = spark.createDataFrame([(i, row["q"]) for i, row in enumerate(asked)], f"_i int, q {kind}")
    return best.withColumn("d", F.when(F.col("nul"), F.lit(None)).otherwise(F.col("d"))).withColumnRenamed("q", "_q").join(
        names, F.col("_q") == F.col("_i")).select("q", "rank", "d", "score")


import pyarrow.compute  # noqa: E402,F401  (pa.compute is loaded on import)
