"""Passages of words that an earlier document holds, by a compacted De Bruijn graph.

A window is SPAN consecutive words of one text; it is an edge from the node of
its first SPAN - 1 words to that of its last.  Only edges that start in two
documents or more are kept.  An edge continues another if every occurrence of
either stands next to one of the other, so a nonbranching path has the same
occurrences all along and is found whole wherever its first edge is.  Edges
are compacted to paths by a join of each one (first of those under one anchor) with the
one before it, and by the coordinates of their earliest occurrence, which follow each
other along a path.  Occurrences of a path's first edge give its spans in all documents;
a span counts only if it has the checksum of the windows along the path's source
coordinates.

To keep the bulk of the windows out of the graph, each window has an *anchor*,
the smallest hash among its PIECE-word strings: equal windows have equal anchors,
neighbours mostly share theirs and travel together, and a window whose anchor no
other document has is no edge.  The rows are first written in slices of some
megabytes of text, in a table bucketed by slice.  A slice names each of its anchors,
and each run of windows, once, however many of its documents hold it, so a passage in
a third of all documents is a row a slice.  What comes back to a slice, the anchors
and the paths it holds, meets its texts in the bucketed table; texts are never
shuffled.

Defined results: a null text has no words; a text of fewer than SPAN words
keeps all; rows of equal ids are documents of the same rank, none before the
other; a null id ranks after all others; repeated rows are each returned.
Columns other than the id and the text play no part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut_lineage, scratch_path, ship_package, slices

SPAN, PIECE = 13, 7
LAST = (1 << 63) - 1  # rank of a null id
SLICE_BYTES = 8 << 20
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


#: Bytes that are hashed together; a word beyond LONG bytes is hashed by itself.
STRETCH, LONG = 1 << 20, 1 << 16
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_POWERS = np.multiply.accumulate(np.full(STRETCH + LONG, _M1, np.uint64))
_BACK = np.multiply.accumulate(np.full(STRETCH + LONG, pow(int(_M1), -1, 1 << 64), np.uint64))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of every word of ``data``: sums of its bytes times powers of an odd number, by place in the word."""
    byte = np.frombuffer(data, np.uint8)
    white = np.concatenate([[True], _WHITE[byte], [True]])
    first = np.flatnonzero(white[:-1] & ~white[1:])
    end = np.flatnonzero(~white[:-1] & white[1:])
    out = np.zeros(len(first), np.uint64)
    k = 0
    while k < len(first):
        upto = max(int(np.searchsorted(first, first[k] + STRETCH)), k + 1)
        lo, hi = int(first[k]), int(min(end[upto - 1], first[k] + STRETCH + LONG))  # what is beyond belongs to a long word
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((byte[lo:hi] + np.uint64(1)) * _POWERS[:hi - lo], out=sums[1:])
        out[k:upto] = (sums[np.minimum(end[k:upto], hi) - lo] - sums[first[k:upto] - lo]) * _BACK[first[k:upto] - lo]
        k = upto
    for k in np.flatnonzero(end - first > LONG).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[first[k]:end[k]])
    return first, _mixed(out).view(np.uint64)


def _joined(a: np.ndarray, b: np.ndarray, k: int, behind: int) -> np.ndarray:
    """Hashes of strings from those of their first part ``a`` and of their last ``k`` entries, ``behind`` entries on, ``b``."""
    m = max(len(b) - behind, 0)
    return a[:m] * np.uint64(pow(int(_M1), k, 1 << 64)) + b[behind:behind + m]


def _strings(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive entries of ``h``: by doubling, and the rest from the powers of two in ``k``."""
    power, width, out, done = h, 1, None, 0
    while True:
        if k & width:
            out = power if out is None else _joined(out, power, width, done)
            done += width
        if done == k:
            return out
        power, width = _joined(power, power, width, width), 2 * width


def _mixed(a: np.ndarray) -> np.ndarray:
    """Hashes with their bits stirred, never 0, as Spark's longs."""
    a = (a ^ (a >> np.uint64(29))) * _M2
    a ^= a >> np.uint64(32)
    return np.maximum(a, np.uint64(1)).view(np.int64)


def _least(a: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every ``k`` consecutive entries of ``a``."""
    width = 1
    while width < k:
        step = min(width, k - width)
        a = np.minimum(a[:-step], a[step:]) if len(a) > step else a[:0]
        width += step
    return a


class _Slice:
    """The windows of a slice's texts, as places in the row of all their words.

    ``at``: places at which a window starts, ``doc`` the text of each; ``run``: the windows (of ``at``) at which a run of one
    text's windows with one ``anchor`` starts, and at last their number; ``node``: hash of the string of span - 1 words
    from a place on (of meaning only inside a text).
    """

    def __init__(self, texts: list[str | None], span: int, piece: int):
        self.texts = [text.encode() if text else b"" for text in texts]
        first, h = _words(b" ".join(self.texts))
        self.start = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in self.texts)]))
        windows = np.maximum(np.diff(self.start) - span + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), windows)
        self.last = self.start[:-1] + windows - 1  # of each text
        before = np.cumsum(windows) - windows
        self.at = np.arange(len(self.doc)) - before[self.doc] + self.start[self.doc]
        if not len(self.at):
            return
        self.node = _mixed(_strings(h, span - 1))
        anchor = _least(_mixed(_strings(h, piece)), span - piece + 1)[self.at]
        new = _changes(anchor, self.doc)
        self.anchor, self.run = anchor[new], np.append(new, len(anchor))

    def ends(self, first: np.ndarray, last: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Node before the window at ``first`` and node behind that at ``last`` (0 at the ends of the text)."""
        before = np.where(first > self.start[doc], self.node[np.maximum(first - 1, 0)], 0)
        after = np.where(last < self.last[doc], self.node[np.minimum(last + 2, len(self.node) - 1)], 0)
        return before, after

    def under(self, anchors: np.ndarray) -> np.ndarray:
        """Which runs have one of ``anchors``."""
        asked = np.unique(anchors)
        if not len(asked):
            return asked
        return np.flatnonzero(asked[np.minimum(np.searchsorted(asked, self.anchor), len(asked) - 1)] == self.anchor)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of ``columns`` (not empty) is not what it was before; the first place counts."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], 0)
    return np.flatnonzero(new)


def _table(spark, df: DataFrame, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in buckets by ``slice``, and read back; only files stay behind, no table name."""
    name = f"dbg_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "slice").sortBy("slice").option("path", scratch_path(spark, "dbg-slices")).format("parquet").saveAsTable(name)
    back = spark.table(name)
    back.schema  # resolved before the name goes
    spark.sql(f"DROP TABLE {name}")
    return back


def _sliced(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Table (slice, d, nul, t): rank and text of every row, in slices of at most SLICE_BYTES of text (or one text)."""
    i, t = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices([batch], 2, SLICE_BYTES):
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, number)), *part.columns], names=["slice", "d", "nul", "t"])

    rows = docs.select(F.coalesce(i, F.lit(LAST)).alias("d"), i.isNull().alias("nul"), t.alias("t"))
    spark = docs.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return _table(spark, rows.mapInArrow(run, "slice long, d long, nul boolean, t string"), min(most, 2 * max(rows.rdd.getNumPartitions(), 4)))


def _shared_anchors(texts: DataFrame, span: int, piece: int) -> DataFrame:
    """(slice, a): the anchors of each slice that two documents or more have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], 2, SLICE_BYTES):
                number, ranks = (c.to_numpy(zero_copy_only=False) for c in part.columns[:2])
                cuts = [*_changes(number).tolist(), part.num_rows]
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    x = _Slice(part.column(2).slice(lo, hi - lo).to_pylist(), span, piece)
                    if not len(x.at):
                        continue
                    order = np.argsort(x.anchor)
                    a, rank = x.anchor[order], ranks[lo + x.doc[x.run[:-1][order]]]
                    first = _changes(a)
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a[first], np.full(len(first), number[lo]), np.minimum.reduceat(rank, first),
                                                                            np.maximum.reduceat(rank, first))], names=["a", "slice", "lo", "hi"])

    named = texts.select("slice", "d", "t").mapInArrow(run, "a long, slice long, lo long, hi long")
    by = W.partitionBy("a")
    return (named.withColumn("_lo", F.min("lo").over(by)).withColumn("_hi", F.max("hi").over(by))
            .filter("_lo < _hi").select("slice", "a"))


def _runs(texts: DataFrame, known: DataFrame, span: int, piece: int) -> DataFrame:
    """Runs of windows with one known anchor ``a``, each once a slice: earliest place (d, h, pos), latest rank ``hi``,
    and ``nodes``: the first node of the window before, those of the run, the last one of the window behind (0 at text ends).

    ``h`` is a hash of the text, to tell rows of equal ids apart.
    """
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        out: dict[bytes, list] = {}
        x = _Slice(docs.column("t").to_pylist() if anchors.num_rows else [], span, piece)
        k = x.under(anchors.column("a").to_numpy()) if len(x.at) else x.at
        if len(k):
            ranks = docs.column("d").to_pylist()
            first, last, doc = x.at[x.run[k]], x.at[x.run[k + 1] - 1], x.doc[x.run[k]]
            before, after = (v.tobytes() for v in x.ends(first, last, doc))
            text_of: dict[int, int] = {}
            for k, (lo, hi, i, a, pos) in enumerate(zip(*(v.tolist() for v in (first, last, doc, x.anchor[k], first - x.start[doc])), strict=True)):
                key = before[8 * k:8 * k + 8] + x.node[lo:hi + 2].tobytes() + after[8 * k:8 * k + 8]
                h = text_of.get(i)
                if h is None:
                    h = text_of[i] = xxhash.xxh3_64_intdigest(x.texts[i]) >> 33
                d, seen = ranks[i], out.get(key)
                if seen is None:
                    out[key] = [a, d, h, pos, d]
                else:
                    seen[4] = max(seen[4], d)
                    if (d, h, pos) < tuple(seen[1:4]):
                        seen[1:4] = d, h, pos
        columns = list(zip(*out.values(), strict=True)) or [[]] * 5
        sizes = np.cumsum([0, *(len(k) // 8 for k in out)], dtype=np.int32)
        nodes = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.frombuffer(b"".join(out), np.int64)))
        return pa.table([*(pa.array(c, k) for c, k in zip(columns, _RUN, strict=True)), nodes], names=["a", "d", "h", "pos", "hi", "nodes"])

    return (texts.select("slice", "d", "t").groupBy("slice").cogroup(known.groupBy("slice"))
            .applyInArrow(run, "a long, d long, h int, pos int, hi long, nodes array<long>"))


_RUN = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())


def _turned(x: str, n: str) -> str:
    """SQL: the long ``x``, its bits turned to the left by ``n``."""
    return f"(shiftleft({x}, cast({n} % 64 as int)) | shiftrightunsigned({x}, cast(64 - {n} % 64 as int)))"


def _rotated(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Unsigned ``x``, its bits turned to the left by ``n``."""
    n = (n % 64).astype(np.uint64)
    return np.where(n == 0, x, (x << n) | (x >> ((np.uint64(64) - n) % np.uint64(64))))


def _checksums(nodes: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Checksum of the ``n`` nodes from each ``start`` on: all of them together, each turned by its place behind the start."""
    sums = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(_rotated(nodes.view(np.uint64), np.arange(len(nodes))))])
    return _rotated(sums[start + n] ^ sums[start], -start % 64).view(np.int64)


def _paths(runs: DataFrame) -> DataFrame:
    """Nonbranching paths of edges of two documents or more: first edge (l, r) with its anchor ``a``, ``n`` edges, the first
    document that has it, and the checksum ``x`` along its earliest occurrence."""
    windows = runs.repartition("a").selectExpr(
        "a", "d", "h", "hi", "pos", "inline(transform(sequence(0, size(nodes) - 4), k -> named_struct('k', k, "
        "'before', nodes[k], 'l', nodes[k + 1], 'r', nodes[k + 2], 'after', nodes[k + 3])))")
    edges = (windows.withColumn("pos", F.col("pos") + F.col("k")).groupBy("a", "l", "r").agg(
        F.min(F.struct("d", "h", "pos")).alias("src"), F.max("hi").alias("hi"), F.min("before").alias("b0"), F.max("before").alias("b1"),
        F.min("after").alias("a0"), F.max("after").alias("a1"))
        .filter("src.d < hi")
        .selectExpr("a", "l", "r", "src.d", "src.h", "src.pos", "if(b0 = b1, b0, 0) as b", "if(a0 = a1, a0, 0) as f"))
    # pieces: edges under one anchor, each the only one before the next and the next the only one behind it
    near = W.partitionBy("a", "d", "h").orderBy("pos")
    joined = (F.lag("pos").over(near) == F.col("pos") - 1) & (F.lag("f").over(near) == F.col("r")) & (F.lag("l").over(near) == F.col("b"))
    first = edges.withColumn("head", F.when(joined, 0).otherwise(1))
    numbered = first.withColumn("at", F.last(F.expr("if(head = 1, pos, null)"), ignorenulls=True).over(near.rowsBetween(W.unboundedPreceding, 0)))
    pieces = cut_lineage(
        numbered.groupBy("a", "d", "h", "at").agg(
            F.count("*").cast("int").alias("n"), F.max(F.expr("if(head = 1, struct(l, r, b), null)")).alias("first"),
            F.max_by(F.struct("l", "r", "f"), "pos").alias("last"), F.expr(f"bit_xor({_turned('l', '(pos - at)')})").alias("x"))
        .selectExpr("a", "d", "h", "at as pos", "n", "first.l", "first.r", "first.b", "last.l as tl", "last.r as tr", "last.f as f", "x"), "dbg-pieces")
    before = pieces.filter("f != 0").select(F.col("tl").alias("_tl"), F.col("tr").alias("_tr"), F.col("f").alias("_f"))
    linked = pieces.join(before, (F.col("b") == F.col("_tl")) & (F.col("l") == F.col("_tr")) & (F.col("r") == F.col("_f")), "left")
    along = W.partitionBy("d", "h").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    path = linked.withColumn("at", F.last(F.expr("if(_tl is null, pos, null)"), ignorenulls=True).over(along))
    return (path.groupBy("d", "h", "at").agg(
        F.sum("n").cast("int").alias("n"), F.max(F.expr("if(_tl is null, struct(a, l, r), null)")).alias("first"),
        F.max_by(F.struct("tr", (F.col("pos") + F.col("n") - F.col("at")).alias("k")), "pos").alias("last"),
        F.expr(f"bit_xor({_turned('x', '(pos - at)')})").alias("x"))
        .selectExpr("first.a", "first.l", "first.r", "n", "d as first", f"x ^ {_turned('last.tr', 'last.k')} as x"))


def _heads(texts: DataFrame, known: DataFrame, paths: DataFrame, span: int, piece: int) -> DataFrame:
    """(slice, l, r, n, first, x): the paths whose first edge the slice has."""
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        x = _Slice(docs.column("t").to_pylist() if anchors.num_rows else [], span, piece)
        l = r = once = np.zeros(0, np.int64)
        if len(x.at):
            k = x.under(anchors.column("a").to_numpy())
            size = x.run[k + 1] - x.run[k]
            at = x.at[np.arange(size.sum()) + np.repeat(x.run[k] - np.cumsum(size) + size, size)]
            l, r = x.node[at], x.node[at + 1]
            once = np.unique(l * 31 + r, return_index=True)[1]
        number = docs.column("slice")[0].as_py() if docs.num_rows else 0
        return pa.table([pa.array(np.full(len(once), number, np.int64)), pa.array(l[once]), pa.array(r[once])], names=["slice", "l", "r"])

    asked = known.join(paths.select(F.col("a").alias("_a")).distinct(), F.col("a") == F.col("_a"), "left_semi")
    held = texts.select("slice", "t").groupBy("slice").cogroup(asked.groupBy("slice")).applyInArrow(run, "slice long, l long, r long")
    p = paths.select(F.col("l").alias("_l"), F.col("r").alias("_r"), "n", "first", "x")
    return held.join(p, (F.col("l") == F.col("_l")) & (F.col("r") == F.col("_r"))).select("slice", "l", "r", "n", "first", "x")


def _spans(x: _Slice, ranks: np.ndarray, paths: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, windows, first document) of each of ``paths`` that a text of the slice has and an earlier document too."""
    l, r, n, first, check = (paths.column(c).to_numpy() for c in ("l", "r", "n", "first", "x"))
    order = np.argsort(l)
    l = l[order]
    node = x.node[x.at]
    lo = np.searchsorted(l, node)
    some = np.flatnonzero(l[np.minimum(lo, len(l) - 1)] == node)
    lo = lo[some]
    size = np.searchsorted(l, node[some], "right") - lo  # paths that start in the same node
    hit = np.repeat(some, size)
    path = order[np.arange(len(hit)) + np.repeat(lo - np.cumsum(size) + size, size)]
    place, doc = x.at[hit], x.doc[hit]
    good = (r[path] == x.node[place + 1]) & (first[path] < ranks[doc]) & (place + n[path] - 1 <= x.last[doc])
    place, path = place[good], path[good]
    good = _checksums(x.node, place, n[path].astype(np.int64) + 1) == check[path]
    return place[good], n[path[good]].astype(np.int64), first[path[good]]


def earlier_spans(docs: DataFrame, work, fields: dict[str, tuple[str, pa.DataType]], id_col: str = "doc_id", text_col: str = "text",
                  span: int = SPAN, piece: int = PIECE) -> DataFrame:
    """Every row's id and the values of ``fields`` (name: SQL and Arrow type) that ``work(slice, place, windows, first)`` yields for the
    rows of a slice in turn, from all paths in it that an earlier document (``first``) has."""
    ship_package(docs.sparkSession)
    texts = _sliced(docs, id_col, text_col)
    known = cut_lineage(_shared_anchors(texts, span, piece), "dbg-anchors")
    paths = cut_lineage(_paths(_runs(texts, known, span, piece)), "dbg-paths")
    heads = _heads(texts, known, paths, span, piece)
    kinds = [kind for _, kind in fields.values()]
    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        ranks = rows.column("d").to_numpy()
        x = _Slice(rows.column("t").to_pylist(), span, piece)
        none = np.zeros(0, np.int64)
        spans = _spans(x, ranks, found) if found.num_rows and len(x.at) else (none, none, none)
        columns = list(zip(*work(x, *spans), strict=True)) or [[]] * len(kinds)
        ids = pa.array(ranks, pa.int64(), mask=rows.column("nul").to_numpy(zero_copy_only=False).astype(bool))
        return pa.table([ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=[id_col, *fields])

    schema = ", ".join([f"`{id_col}` long", *(f"{name} {kind}" for name, (kind, _) in fields.items())])
    return texts.groupBy("slice").cogroup(heads.groupBy("slice")).applyInArrow(run, schema)


def list_spans(docs: DataFrame, **kw) -> DataFrame:
    """Each row's id and ``spans``: word place and words of each path that an earlier document has, and the first one that has it."""
    span = kw.get("span", SPAN)

    def work(x: _Slice, place: np.ndarray, n: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], x.start)
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            yield ([{"pos": int(place[i] - x.start[k]), "words": int(n[i]) + span - 1, "first": int(first[i])} for i in order[lo:hi]],)

    kind = pa.list_(pa.struct([("pos", pa.int64()), ("words", pa.int64()), ("first", pa.int64())]))
    return earlier_spans(docs, work, {"spans": ("array<struct<pos: long, words: long, first: long>>", kind)}, **kw)


def remove_earlier(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, piece: int = PIECE,
                   keep_text: bool = False) -> DataFrame:
    """Every row's id, n_words, n_removed and kept_sha256, after removal of each word that a window covers which an
    earlier document has; with ``keep_text`` also the kept words."""
    def work(x: _Slice, place: np.ndarray, n: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        m = x.start[-1] + 1
        stays = np.cumsum(np.bincount(place, minlength=m) - np.bincount(place + n + span - 1, minlength=m))[:-1] == 0
        gone = np.diff(np.concatenate([[0], np.cumsum(~stays)])[x.start])
        for k, text in enumerate(x.texts):
            words = text.split()
            kept = b" ".join(compress(words, stays[x.start[k]:x.start[k + 1]].tolist()) if gone[k] else words)
            values = len(words), int(gone[k]), hashlib.sha256(kept).hexdigest()
            yield (*values, kept.decode()) if keep_text else values

    fields = {"n_words": ("long", pa.int64()), "n_removed": ("long", pa.int64()), "kept_sha256": ("string", pa.string())}
    return earlier_spans(docs, work, fields | ({"kept": ("string", pa.string())} if keep_text else {}), id_col, text_col, span, piece)
