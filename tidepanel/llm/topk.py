"""Exact top-k inner products by descending length.

Candidates are cut into blocks of like length (norm), longest first.  The
longest block gives each query a first threshold: its k-th best score.  A
query then only goes to blocks where (block's length) x (query's length) can
still reach it.  Inside a block, vectors are rotated to the main axes of the
data (SVD of a sample), so a partial sum over the first axes holds most of a
product; what the other axes can add is bounded by Cauchy-Schwarz from the
residual lengths.  Pairs whose bound is under the threshold are dropped, the
others are scored exactly in integers.  Nothing is approximate: rotation and
blocks change the work, not the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import cut_lineage, ship_package

#: Length classes per doubling of the squared norm (a class is about 9 % wide; there are under 600 in all).
CLASSES = 4
#: Rows the rotation is fitted on, about.
SAMPLE_ROWS = 8192
EXACT = float(1 << 53)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """(v, x): id and floor(scale * component) as longs; rows with a null id, a null vector or a null or non-finite component go.

    Of rows that repeat an id the one with the smallest vector stays.
    """
    fine = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine).groupBy(F.col(id_col).alias("v")).agg(F.min(x).alias("x"))


def squared_norm(x: str) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))


def rotation(sample: np.ndarray) -> np.ndarray:
    """Axes of the sample by falling singular value, as columns."""
    return np.linalg.svd(sample.T @ sample)[0]


class Block:
    """Candidates of one block, longest first, ready to be scored against queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray, first: int):
        self.length = np.sqrt((x * x).sum(1))
        order = np.lexsort((ids, -self.length))
        self.ids, self.x, self.length = ids[order], x[order], self.length[order]
        turned = self.x @ axes
        self.head, self.rest = turned[:, :first], np.sqrt((turned[:, first:] ** 2).sum(1))
        self.first, self.axes = first, axes
        self.largest = float(np.abs(x).max(initial=0))

    def top(self, q_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, chunk: int = 1024) -> tuple[np.ndarray, ...]:
        """(query position, id, score) of the k best per query among those of at least its ``floor``; scores are Python integers
        where a product may be beyond 2**53."""
        turned = q @ self.axes
        head, rest, length = turned[:, :self.first], np.sqrt((turned[:, self.first:] ** 2).sum(1)), np.sqrt((q * q).sum(1))
        # whatever rounding the bounds carry is far below this
        slack = 1e-9 * length * (self.length[0] if len(self.length) else 0) + 1e-6
        exact = float(np.abs(q).max(initial=0)) * self.largest * max(1, q.shape[1]) < EXACT
        # a threshold beyond 2**53 may have been rounded up; so may a score where it becomes one
        thr = floor = np.where(np.abs(floor) >= EXACT, np.nextafter(floor, -np.inf), floor)
        none = np.zeros(0, np.int64)
        at, ids, score = none, none, none if exact else none.astype(object)
        for s in range(0, len(self.ids), chunk):
            part = slice(s, s + chunk)
            if (length * self.length[s] + slack < thr).all():
                break
            bound = head @ self.head[part].T + rest[:, None] * self.rest[None, part] + slack[:, None]
            keep = (bound >= thr[:, None]) & (q_ids[:, None] != self.ids[None, part])
            qi, xi = np.nonzero(keep)
            if not len(qi):
                continue
            if not exact:
                new = np.empty(len(qi), object)
                new[:] = [sum(int(a) * int(b) for a, b in zip(q[i], self.x[s + j], strict=True)) for i, j in zip(qi, xi, strict=True)]
            elif len(qi) * 4 > keep.size:
                new = (q @ self.x[part].T)[qi, xi].astype(np.int64)
            else:
                new = np.concatenate([np.einsum("ij,ij->i", q[qi[i:i + 65536]], self.x[s + xi[i:i + 65536]]) for i in range(0, len(qi), 65536)]).astype(np.int64)
            at, ids, score = np.concatenate([at, qi]), np.concatenate([ids, self.ids[s + xi]]), np.concatenate([score, new])
            order = np.lexsort((ids, -score, at))
            at, ids, score = at[order], ids[order], score[order]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            stay = rank < k
            at, ids, score = at[stay], ids[stay], score[stay]
            full = rank[stay] == k - 1
            thr = thr.copy()
            thr[at[full]] = np.maximum(thr[at[full]], np.nextafter(score[full].astype(np.float64), -np.inf))
        good = score >= floor[at] if len(at) else np.zeros(0, bool)
        return at[good], ids[good], score[good]


def _scan(cands: DataFrame, queries: DataFrame, axes: np.ndarray, first: int, k: int) -> DataFrame:
    """Best ``k`` of each (block, query): ``cands`` (cls, sub, v, x), ``queries`` (cls, sub, v, x, thr).

    A partition holds whole blocks; in each the candidates come first and
    stay, the queries stream past in batches.
    """
    d = len(axes)
    rows = (cands.select("cls", "sub", F.lit(0).alias("kind"), "v", "x", F.lit(None).cast("long").alias("thr"))
            .unionByName(queries.select("cls", "sub", F.lit(1).alias("kind"), "v", "x", "thr"))
            .repartition("cls", "sub").sortWithinPartitions("cls", "sub", "kind"))

    def matrix(col: pa.Array) -> np.ndarray:
        out = np.zeros((len(col), d))
        flat, off = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()
        if len(col) and (np.diff(off) == d).all():
            return flat[off[0]:off[-1]].reshape(len(col), d).astype(np.float64)
        for i in range(len(col)):  # shorter vectors: zeros behind
            out[i, :off[i + 1] - off[i]] = flat[off[i]:off[i + 1]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, xs, block = None, [], [], None
        for b in batches:
            cls, sub, kind = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            change = np.flatnonzero((np.diff(cls) != 0) | (np.diff(sub) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *change], [*change, len(cls)], strict=True):
                if lo == hi:
                    continue
                if (cls[lo], sub[lo]) != key:
                    key, ids, xs, block = (cls[lo], sub[lo]), [], [], None
                v, x = b.column(3).slice(lo, hi - lo).to_numpy(zero_copy_only=False), matrix(b.column(4).slice(lo, hi - lo))
                if kind[lo] == 0:
                    ids.append(v)
                    xs.append(x)
                    continue
                if block is None:
                    if not ids:
                        continue
                    block = Block(np.concatenate(ids), np.concatenate(xs), axes, first)
                thr = b.column(5).slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                thr = np.nan_to_num(thr.astype(np.float64), nan=-np.inf, neginf=-np.inf)
                for s in range(0, hi - lo, 1024):
                    at, found, score = block.top(v[s:s + 1024], x[s:s + 1024], thr[s:s + 1024], k)
                    held, beyond = _as_longs(score)
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(v[s:s + 1024][at], pa.int64()), "vec_id": pa.array(found, pa.int64()),
                                                      "score": held, "beyond": beyond})

    return rows.mapInArrow(run, "query_id long, vec_id long, score long, beyond string")


def _as_longs(score: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Scores held at the ends of a long, and for those at an end the whole number as text that sorts like it."""
    if score.dtype != object:
        return pa.array(score, pa.int64()), pa.nulls(len(score), pa.string())
    held = [min(max(s, -(1 << 63)), (1 << 63) - 1) for s in score]
    return pa.array(held, pa.int64()), pa.array([f"{(1 << 190) + s:048x}" if h in (-(1 << 63), (1 << 63) - 1) else None
                                                 for s, h in zip(score, held, strict=True)], pa.string())


def _rank(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                       scale: int = 256, block_rows: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query with every other row.

    ``is_query`` is a condition on the id column ``v``.  Ties go to the
    smaller id; with fewer than ``k`` other rows all come.  Vectors shorter
    than the longest count as padded with zeros.  Ids are integers; rows that
    take no part: see :func:`integer_vectors`.  Products beyond 2**53 are
    computed and ranked as whole Python integers; ``score`` shows the end of a
    long for those that do not fit.
    ``block_rows`` bounds a block (default: a 64th of the rows, between 1,024
    and 65,536); every block of a length class is a hashed part of it, so
    copies of one vector spread over blocks.
    """
    ship_package(vectors.sparkSession)
    base = (integer_vectors(vectors, id_col, vec_col, scale).withColumn("v", F.col("v").cast("long"))
            .withColumn("n2", squared_norm("x")).withColumn("cls", F.floor(F.log2(F.col("n2") + 1) * CLASSES).cast("int")))
    base = cut_lineage(base, "vectors")
    # at most 600 classes, whatever the input
    classes = sorted(((r["cls"], r["count"], r["d"]) for r in base.groupBy("cls").agg(F.count("*").alias("count"), F.max(F.size("x")).alias("d")).collect()), reverse=True)
    total, d = sum(c[1] for c in classes), max([1, *[c[2] for c in classes]])
    block_rows = block_rows or max(1024, min(65536, total // 64))
    step = max(1, total // SAMPLE_ROWS)
    sample = [r["x"] for r in base.filter(F.pmod(F.xxhash64("v"), F.lit(step)) == 0).select("x").limit(4 * SAMPLE_ROWS).collect()]
    axes = rotation(np.array([[*x, *[0] * (d - len(x))] for x in sample], np.float64).reshape(-1, d)) if sample else np.eye(d)
    first = max(1, d // 4)

    spark = base.sparkSession
    subs = spark.createDataFrame([(c, -(-n // block_rows)) for c, n, _ in classes] or [(-1, 1)], "cls int, subs int")
    seen, head = 0, -1
    for c, n, _ in classes:
        seen, head = seen + n, c
        if seen >= max(512, k + 1):
            break
    cands = (base.join(F.broadcast(subs), "cls").withColumn("sub", F.pmod(F.xxhash64("v"), F.col("subs")).cast("int"))
             .select("cls", "sub", "v", "x"))
    queries = base.filter(is_query).select("v", "x", "n2")

    def sent(q: DataFrame, which: Column) -> DataFrame:
        """Queries to the blocks of their classes ``lo`` and up that ``which`` takes."""
        low, high = (classes[-1][0], classes[0][0]) if classes else (0, 0)
        return (q.withColumn("cls", F.explode(F.sequence(F.greatest(F.col("lo"), F.lit(low)), F.lit(high + 1)))).filter(which)
                .join(F.broadcast(subs), "cls").withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
                .select("cls", "sub", "v", "x", "thr"))

    is_head = F.col("cls") >= head
    begun = cut_lineage(_rank(_scan(cands.filter(is_head), sent(queries.withColumn("lo", F.lit(head)).withColumn("thr", F.lit(None).cast("long")), is_head), axes, first, k), k), "topk-head")
    # a score held at the lower end of a long is no threshold: the true one lies below it
    thr = begun.filter((F.col("rank") == k) & (F.col("score") > -(1 << 63))).select(F.col("query_id").alias("v"), F.col("score").alias("thr"))
    # a class reaches a threshold t > 0 if its longest norm times the query's does; a hair lower for rounding
    reach = F.col("thr") / F.sqrt("n2") * (1 - 1e-9)
    lo = F.when(F.col("thr") > 0, F.floor(F.log2(reach * reach + 1) * CLASSES).cast("int") - 1).otherwise(F.lit(-1))
    later = _scan(cands.filter(~is_head), sent(queries.join(thr, "v", "left").withColumn("lo", F.coalesce(lo, F.lit(-1))), ~is_head), axes, first, k)
    done = _rank(begun.select("query_id", "vec_id", "score", "beyond").unionByName(later), k)
    return done.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
