"""Repeated passages across a corpus, by common-prefix intervals of a sparse suffix array.

Every string of MIN_BYTES bytes holds an *anchor*: among its substrings of
ANCHOR_BYTES bytes the one of smallest hash.  Equal strings have equal anchors
at equal places, so repeats can only meet where anchors are equal, and about
one byte in a hundred starts one.  The suffixes (and reversed prefixes) at
equal anchors form a sparse suffix array, a part for each anchor:

* places with the same bytes all around (as far as a string through the anchor
  can reach) are one *context*; a context seen twice is a repeat as it stands;
* different contexts of an anchor are sorted by what follows; a stack scan of
  their common prefixes gives the tree of intervals, and within an interval
  a scan of what precedes them gives the groups that are diverse on the left.
  Each such group that is long enough and cannot be extended on the right is
  a maximal repeat, with all its members.
* an anchor with more contexts than a task should hold is split by the strings
  themselves: its windows are hashed and counted by a shuffle.

The result for a context is how far repeats reach to its left and right; that
holds for every place of the context, and the union over all anchors of a text
is what a repeated string covers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch_path, ship_package, slices
from .order_minhash import salted_lookup

MIN_BYTES, ANCHOR_BYTES = 400, 160
#: Contexts of one anchor (640 bytes each) that are compared in one task; beyond that its strings are counted by a shuffle.
GROUP_CONTEXTS = 20_000
#: Places of a string around its anchor that the counting looks at together first.
OFFSETS = 24
#: Per-document lists of at most so many numbers in all (8 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_ENTRIES = 3_000_000

MULT = np.uint64(0x9E3779B97F4A7C15)
ODD = 0xD6E8FEB86659FD93


def rolling(b: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes at each place: a polynomial, built by doubling, then mixed."""
    whole, at, power, mult = None, b.astype(np.uint64) + np.uint64(1), 1, ODD
    done = 0
    while True:
        if k & power:
            if whole is None:
                whole, done = at, power
            else:
                n = len(b) - done - power + 1
                whole = whole[:n] * np.uint64(mult) + at[done:done + n]
                done += power
        power *= 2
        if power > k:
            break
        half, n = power // 2, len(b) - power + 1
        at = at[:n] * np.uint64(mult) + at[half:half + n]
        mult = mult * mult % (1 << 64)
    whole = (whole ^ (whole >> np.uint64(29))) * MULT
    return whole ^ (whole >> np.uint64(32))


def sliding(x: np.ndarray, w: int, f) -> np.ndarray:
    """f (minimum or maximum) over each window of w elements."""
    have = 1
    while have * 2 <= w:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[:len(x) - (w - have)], x[w - have:]) if w > have else x


def anchors(data: bytes, min_bytes: int = MIN_BYTES, k: int = ANCHOR_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors: every place that is smallest in some window of min_bytes."""
    n = len(data)
    if n < min_bytes:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, w = rolling(np.frombuffer(data, np.uint8), k), min_bytes - k + 1
    low = sliding(h, w, np.minimum)
    # a place is an anchor if it equals the minimum of one of the windows over it
    high = sliding(np.concatenate([np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64)]), w, np.maximum)
    at = np.flatnonzero(h == high)
    return at, h[at]


def common(x: bytes, y: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    d = int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")
    return n - 1 - (d.bit_length() - 1) // 8


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the common-prefix intervals of depth >= least, by one stack scan.

    ``lcp[i]`` belongs to the sorted elements i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, d in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > d:
            depth, first = stack.pop()
            yield depth, first, i
        if d >= least and (not stack or stack[-1][0] < d):
            stack.append((d, first))


class _RangeMin:
    """Minimum of any stretch of a list of numbers, from minima of power-of-two stretches."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        while len(x) > (step := 1 << (len(self.rows) - 1)):
            x = np.minimum(x[:-step], x[step:])
            self.rows.append(x)

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over first .. last, ends included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.rows[k][first[at]], self.rows[k][last[at] - (1 << int(k)) + 1])
        return out


def _sorted_side(side: list[bytes], of) -> tuple[list[int], list[int]]:
    """The elements ``of`` in order of their bytes, and the common prefixes of neighbours."""
    order = sorted(of, key=side.__getitem__)
    return order, [common(side[a], side[b]) for a, b in zip(order, order[1:], strict=False)]


class _Contexts:
    """The contexts of one anchor, both sides sorted once.

    ``before`` holds the bytes before the anchor reversed, ``after`` those from
    it on.  A context whose longest matches on both sides, with anyone, do not
    add up to ``min_bytes`` is in no group and leaves first.
    """

    def __init__(self, before: list[bytes], after: list[bytes], min_bytes: int, k: int):
        self.min_bytes, self.k = min_bytes, k
        order, lcp = _sorted_side(after, range(len(after)))
        other, left_lcp = _sorted_side(before, range(len(before)))
        total = [0] * len(after)
        for side, shared in ((order, lcp), (other, left_lcp)):
            for i, x, y in zip(side, [0, *shared], [*shared, 0], strict=True):
                total[i] += max(x, y)
        able = [i for i, t in enumerate(total) if t >= min_bytes]
        if len(able) < len(after):
            (order, lcp), (other, left_lcp) = _sorted_side(after, able), _sorted_side(before, able)
        self.order, self.lcp = np.array(order, np.int64), np.array(lcp, np.int64)
        left_lcp = np.array(left_lcp, np.int64)
        place = np.empty(len(after), np.int64)
        place[other] = np.arange(len(other))
        self.place = place[self.order]  # of each element in right order, its place in left order
        ends = np.concatenate([[-1], left_lcp, [-1]])
        self.longest = np.maximum(ends[:-1], ends[1:])[self.place] if len(other) else np.zeros(0, np.int64)
        self.left_min = _RangeMin(left_lcp)

    def intervals(self, settled=None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(right, need, members, near) of the common-prefix intervals on the right, deeper ones first.

        Members are places in right order, sorted by what precedes them, and
        only those whose longest match there is at least ``need``, which makes
        up ``min_bytes``; ``near`` are the common prefixes of neighbours among
        them.  Members that are all ``settled`` are passed over.
        """
        if len(self.order) < 2:
            return
        for right, first, last in intervals(self.lcp.tolist(), self.k):
            need = max(0, self.min_bytes - right)
            inside = first + np.flatnonzero(self.longest[first:last + 1] >= need)
            if len(inside) < 2 or settled is not None and settled(inside):
                continue
            inside = inside[np.argsort(self.place[inside])]
            at = self.place[inside]
            near = self.left_min(at[:-1], at[1:] - 1)
            if near.max() >= need:
                yield right, need, inside, near


def maximal_groups(before: list[bytes], after: list[bytes], min_bytes: int, k: int) -> Iterator[tuple[int, int, list[int]]]:
    """(left, right, members) of the maximal repeats through one anchor.

    Members share ``left`` bytes before and ``right`` from the anchor on, at
    least ``min_bytes`` together; no byte more on either side is shared by all
    of them (within the given bytes).
    """
    c = _Contexts(before, after, min_bytes, k)
    right_min = _RangeMin(c.lcp)
    for right, need, inside, near in c.intervals():
        # stretches of neighbours that share enough
        cut = np.flatnonzero(np.diff(np.concatenate([[False], near >= need, [False]]).astype(np.int8)))
        for lo, hi in zip(cut[::2].tolist(), cut[1::2].tolist(), strict=True):
            for left, x, y in intervals(near[lo:hi].tolist(), need):
                ranks = inside[lo + x:lo + y + 1]
                if right_min(ranks.min(keepdims=True), ranks.max(keepdims=True) - 1)[0] == right:  # else a deeper interval holds them all
                    yield left, right, c.order[ranks].tolist()


def _store(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, z, t): id, a hash of the row, its text; together d and z name a row (identical rows share them)."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("d"), F.xxhash64(F.col(id_col), t).alias("z"), t.alias("t"))


def find_anchors(rows: DataFrame, min_bytes: int, k: int) -> DataFrame:
    """(d, z, p, a, c, l, r): each anchor's place, hash, context hash and how far its context reaches."""
    kind = rows.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            owner, p, a, c, ls, rs = [], [], [], [], [], []
            for i, t in enumerate(b.column(2).to_pylist()):
                data = t.encode()
                at, h = anchors(data, min_bytes, k)
                if not len(at):
                    continue
                left, right = np.minimum(at, min_bytes - k), np.minimum(len(data) - at, min_bytes)
                owner.append(np.full(len(at), i))
                p.append(at)
                a.append(h.view(np.int64))
                c.extend(xxhash.xxh3_64_intdigest(data[q - x:q + y], x) for q, x, y in zip(at.tolist(), left.tolist(), right.tolist(), strict=True))
                ls.append(left)
                rs.append(right)
            if owner:
                at = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(np.concatenate(p), pa.int32()), pa.array(np.concatenate(a)),
                     pa.array(np.array(c, np.uint64).view(np.int64)), pa.array(np.concatenate(ls), pa.int32()), pa.array(np.concatenate(rs), pa.int32())],
                    names=["d", "z", "p", "a", "c", "l", "r"])

    return rows.select("d", "z", "t").mapInArrow(run, f"d {kind}, z long, p int, a long, c long, l int, r int")


def _with_lists(rows: DataFrame, lists: DataFrame, col: str, how: str) -> DataFrame:
    """Rows (d, z, t) with their document's list ``col``."""
    if lists.agg(F.coalesce(F.sum(F.size(col) + 4), F.lit(0))).first()[0] <= BROADCAST_ENTRIES:
        lists = F.broadcast(lists)
    right = lists.withColumnRenamed("d", "d2").withColumnRenamed("z", "z2")
    return rows.join(right, (F.col("z") == F.col("z2")) & F.col("d").eqNullSafe(F.col("d2")), how).drop("d2", "z2")


def _contexts(rows: DataFrame, wanted: DataFrame, min_bytes: int, k: int) -> DataFrame:
    """(a, c, before, after): the bytes around the wanted places (d, z, p)."""
    lists = _store(wanted.groupBy("d", "z").agg(F.collect_list("p").alias("w")), "repeat-places")
    src = _with_lists(rows, lists, "w", "inner").select("t", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 0):
            a, c, before, after = [], [], [], []
            for t, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                data, want = t.encode(), set(w)
                for p, h in zip(*[x.tolist() for x in anchors(data, min_bytes, k)], strict=True):
                    if p in want:
                        left = min(p, min_bytes - k)
                        a.append(h)
                        c.append(xxhash.xxh3_64_intdigest(data[p - left:p + min_bytes], left))
                        before.append(data[p - left:p][::-1])
                        after.append(data[p:p + min_bytes])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(c, np.uint64).view(np.int64)),
                                                  pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                                                 names=["a", "c", "before", "after"])

    return src.mapInArrow(run, "a long, c long, before binary, after binary")


def _wide(rows: DataFrame, wanted: DataFrame, min_bytes: int, k: int, bytes_too: bool) -> DataFrame:
    """(d, z, p, a, n, u, v, more) of the wanted places (d, z, p, n), or (d, z, p, a, c, before, after).

    A wide context has one byte more before its anchor than an anchor of a
    string's first ``min_bytes`` can have, and ``n`` bytes from it on; ``u``
    and ``v`` are hashes of both sides, ``more`` tells whether the text goes on.
    """
    lists = _store(wanted.groupBy("d", "z").agg(F.collect_set(F.shiftleft(F.col("n"), 32) + F.col("p")).alias("w")), "repeat-wide-places")
    src = _with_lists(rows, lists, "w", "inner").select("d", "z", "t", "w")
    kind = src.schema["d"].dataType.simpleString()
    digest = lambda x: xxhash.xxh3_64_intdigest(x) - (1 << 63)
    schema = f"d {kind}, z long, p long, a long, " + ("c long, before binary, after binary" if bytes_too else "n long, u long, l int, v long, more boolean")
    types = [pa.int64(), pa.int64(), *([pa.int64(), pa.binary(), pa.binary()] if bytes_too else [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_()])]
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            for i in range(b.num_rows):
                data, out, size = b.column(2)[i].as_py().encode(), [], 0
                at, h = anchors(data, min_bytes, k)
                hash_at = dict(zip(at.tolist(), h.view(np.int64).tolist(), strict=True))

                def flush(i=i, b=b, out=out) -> pa.RecordBatch:
                    same = pa.array(np.full(len(out), i))
                    cols = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
                    out.clear()
                    return pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), *cols], names=names)

                for x in b.column(3)[i].as_py():
                    n, q = x >> 32, x & 0xFFFFFFFF
                    before, after = data[max(0, q - (min_bytes - k) - 1):q][::-1], data[q:q + n]
                    if bytes_too:
                        out.append((q, hash_at[q], digest(len(before).to_bytes(4, "big") + before + after), before, after))
                        size += len(after)
                    else:
                        out.append((q, hash_at[q], n, digest(before), len(before), digest(after), len(data) > q + n))
                    if size > 4_000_000 or len(out) >= 20_000:
                        yield flush()
                        size = 0
                if out:
                    yield flush()

    return src.mapInArrow(run, schema)


def reaches(before: list[bytes], after: list[bytes], min_bytes: int, k: int) -> list[tuple[int, int]]:
    """For each context how far maximal repeats reach before and from its anchor (0, 0: it is in none).

    In an interval the group of a member that reaches furthest before it is
    the innermost on the left, whose depth is its longest match with a
    neighbour there.  A member that has its longest match with anyone is
    settled, as later intervals reach less far behind it.
    """
    if len(after) == 2:  # most anchors: one pair, one possible group
        x, y = common(before[0], before[1]), common(after[0], after[1])
        return [(x, y) if x + y >= min_bytes else (0, 0)] * 2
    c = _Contexts(before, after, min_bytes, k)
    left, right = np.zeros(len(c.order), np.int64), np.zeros(len(c.order), np.int64)
    done = np.zeros(len(c.order), bool)
    for deep, need, inside, near in c.intervals(lambda x: done[x].all()):
        ends = np.concatenate([[-1], near, [-1]])
        best = np.maximum(ends[:-1], ends[1:])
        fine = best >= need
        at, best = inside[fine], best[fine]
        left[at], right[at] = np.maximum(left[at], best), np.maximum(right[at], deep)
        done[at] = left[at] >= c.longest[at]
    out = [(0, 0)] * len(after)
    for i, x, y in zip(c.order.tolist(), left.tolist(), right.tolist(), strict=True):
        out[i] = x, y
    return out


def _by_anchor(contexts: DataFrame, work, schema: str) -> DataFrame:
    """Rows of ``work(a, contexts, befores, afters)`` for each anchor a with all its contexts."""
    rows = contexts.select("a", "c", "before", "after").repartition("a").sortWithinPartitions("a")
    names, kinds = zip(*[(f.split()[0], pa.int64() if f.split()[1] == "long" else pa.int32()) for f in schema.split(", ")], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group, out = None, {}, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names=list(names))

        for b in batches:
            for lo in range(0, b.num_rows, 500):
                for a, c, before, after in zip(*[col.to_pylist() for col in b.slice(lo, 500).columns], strict=True):
                    if a != key:
                        if len(group) > 1:
                            for r in work(key, group):
                                out.append(r)
                                if len(out) >= 20_000:
                                    yield flush()
                        key, group = a, {}
                    group[c] = before, after  # a row that came twice counts once
        if len(group) > 1:
            for r in work(key, group):
                out.append(r)
                if len(out) >= 20_000:
                    yield flush()
        if out:
            yield flush()

    return rows.mapInArrow(run, schema)


def _reaches(contexts: DataFrame, min_bytes: int, k: int) -> DataFrame:
    """(a, c, l, r) of the contexts that share a string of min_bytes with another of their anchor."""
    def work(a: int, group: dict) -> Iterator[tuple]:
        found = reaches([x for x, _ in group.values()], [y for _, y in group.values()], min_bytes, k)
        return ((a, c, left, right) for c, (left, right) in zip(group, found, strict=True) if left + right)

    return _by_anchor(contexts, work, "a long, c long, l int, r int")


def _groups(contexts: DataFrame, min_bytes: int, k: int) -> DataFrame:
    """(a, c, g, l, r): wide context c belongs to maximal repeat g, which reaches l before and r from its anchor on.

    A repeat that reaches further before the anchor than an anchor of its
    first ``min_bytes`` can lie is left to that one.
    """
    def work(a: int, group: dict) -> Iterator[tuple]:
        cs, befores, afters = list(group), [x for x, _ in group.values()], [y for _, y in group.values()]
        for left, right, members in maximal_groups(befores, afters, min_bytes, k):
            if left > min_bytes - k:
                continue
            m = members[0]
            g = xxhash.xxh3_64_intdigest(befores[m][:left][::-1] + afters[m][:right]) - (1 << 63)
            for i in members:
                yield a, cs[i], g, left, right

    return _by_anchor(contexts, work, "a long, c long, g long, l int, r int")


def _seen_twice(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys occur twice (hot keys: the counts are partial sums, the join is split by adaptive execution)."""
    return rows.join(rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), keys)


def _hashes(contexts: DataFrame, work, schema: str) -> DataFrame:
    """Rows of ``work(before, after, extra)`` for each context (a, c, before, after[, extra]), behind a and c."""
    names = ["a", "c", *[f.split()[0] for f in schema.split(", ")]]
    kinds = [pa.int64(), pa.int64(), *[pa.int64() if f.split()[1] == "long" else pa.int32() for f in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                out = [(x[0], x[1], *r) for x in zip(*[col.to_pylist() for col in b.slice(lo, 256).columns], strict=True) for r in work(*x[2:])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return contexts.mapInArrow(run, f"a long, c long, {schema}")


def _hot_groups(contexts: DataFrame, min_bytes: int, k: int) -> DataFrame:
    """As :func:`_groups` by single strings, for anchors of many contexts: strings of min_bytes that two contexts share.

    The strings through an anchor are its windows by how far they begin before
    it, OFFSETS at a time.  What all of these have in common is counted first:
    seen once, none of them can be shared.  Then their union: seen twice, all
    of them are.  Only where neither decides are the windows hashed one by
    one.  Counts are by place too, as contexts of one text may hold the same
    window.
    """
    most = min_bytes - k
    digest = lambda x: xxhash.xxh3_64_intdigest(x) - (1 << 63)
    contexts = _store(contexts.dropDuplicates(["a", "c"]).select("a", "c", "before", "after"), "repeat-hot")

    def coarse(before: bytes, after: bytes) -> Iterator[tuple]:
        for lo in range(0, most + 1, OFFSETS):
            hi = min(lo + OFFSETS - 1, most)
            if len(before) >= lo and len(after) >= min_bytes - hi:
                yield lo, digest(before[:lo][::-1] + b"|" + after[:min_bytes - hi])

    def whole(before: bytes, after: bytes, los: list[int]) -> Iterator[tuple]:
        for lo in los:
            hi = min(lo + OFFSETS - 1, most)
            if len(before) >= hi and len(after) >= min_bytes - lo:
                yield lo, digest(before[:hi][::-1] + b"|" + after[:min_bytes - lo])

    def fine(before: bytes, after: bytes, los: list[int]) -> Iterator[tuple]:
        for lo in los:
            for o in range(lo, min(lo + OFFSETS, most + 1)):
                if len(before) >= o and len(after) >= min_bytes - o:
                    yield digest(before[:o][::-1] + after[:min_bytes - o]), o, min_bytes - o

    def with_los(rows: DataFrame) -> DataFrame:
        return contexts.join(rows.groupBy("a", "c").agg(F.collect_list("lo").alias("los")), ["a", "c"]).select("a", "c", "before", "after", "los")

    maybe = _store(_seen_twice(_hashes(contexts, coarse, "lo int, g long"), ["a", "lo", "g"]).select("a", "c", "lo"), "repeat-maybe")
    sure = _store(_seen_twice(_hashes(with_los(maybe), whole, "lo int, g long"), ["a", "lo", "g"]), "repeat-sure")
    open_ = maybe.join(sure.select("a", "c", "lo"), ["a", "c", "lo"], "left_anti")
    single = _seen_twice(_hashes(with_los(open_), fine, "g long, l int, r int"), ["a", "g", "l"])
    hi = F.least(F.col("lo") + OFFSETS - 1, F.lit(most)).cast("int")
    return (sure.select("a", "c", "g", hi.alias("l"), (min_bytes - F.col("lo")).cast("int").alias("r"))
            .unionByName(single.select("a", "c", "g", "l", "r")))


class Repeats:
    """Tables of one corpus: ``anchors`` (places of anchors seen twice) and ``reach`` (how far repeats reach, by context)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, k: int = ANCHOR_BYTES):
        ship_package(docs.sparkSession)
        self.min_bytes, self.k = min_bytes, k
        self.rows = _keyed(docs, id_col, text_col)
        found = _store(find_anchors(self.rows, min_bytes, k), "repeat-anchors")
        # most anchors are seen once and end here
        again = (found.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).filter("n > 1")
                 .select("a", (F.col("lo") != F.col("hi")).alias("differ")))
        self.anchors = _store(salted_lookup(found, again.withColumnRenamed("a", "a2"), "a", "a2", "d"), "repeat-hits")
        classes = self.anchors.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("d", "z", "p")).alias("one"),
                                                     F.first("l").alias("l"), F.first("r").alias("r"), F.first("differ").alias("differ"))
        classes = _store(classes.select("a", "c", "n", "one.*", "l", "r", "differ"), "repeat-contexts")
        differ = classes.filter("differ")
        many = differ.groupBy("a").agg(F.count("*").alias("m")).filter(F.col("m") > GROUP_CONTEXTS).select("a")
        self.hot = not many.isEmpty()
        cold = differ.join(many, "a", "left_anti") if self.hot else differ
        self.cold_contexts = _contexts(self.rows, cold.select("d", "z", "p"), min_bytes, k)
        reach = _reaches(self.cold_contexts, min_bytes, k)
        if self.hot:
            self.hot_contexts = _contexts(self.rows, differ.join(many, "a", "left_semi").select("d", "z", "p"), min_bytes, k)
            hot = _hot_groups(self.hot_contexts, min_bytes, k)
            reach = reach.unionByName(hot.groupBy("a", "c").agg(F.max("l").alias("l"), F.max("r").alias("r")))
        # a context of several places repeats as a whole
        whole = classes.filter("n > 1").select("a", "c", "l", "r")
        self.reach = _store(whole.unionByName(reach).groupBy("a", "c").agg(F.max("l").alias("l"), F.max("r").alias("r")), "repeat-reach")

    def _places(self) -> DataFrame:
        """(d, z, p, a, c, before, after): the wide contexts of all places of anchors seen twice.

        Bytes from the anchor on double until no two places that agree on all
        of them can be the beginning of one repeat: those whose bytes before
        are the same too, beyond where an anchor of the first ``min_bytes`` can
        lie, are inside of a repeat that an earlier anchor begins.
        """
        most, n = self.min_bytes - self.k, self.min_bytes
        wanted = self.anchors.select("d", "z", F.col("p").cast("long").alias("p"), F.lit(n).cast("long").alias("n")).distinct()
        asked = wanted
        while True:
            wide = _store(_wide(self.rows, wanted, self.min_bytes, self.k, False).filter("more"), "repeat-wide")
            tied = (wide.groupBy("a", "v").agg(F.count("*").alias("m"), F.min("u").alias("lo"), F.max("u").alias("hi"), F.min("l").alias("short"))
                    .filter((F.col("m") > 1) & ((F.col("lo") != F.col("hi")) | (F.col("short") <= most))).select("a", "v"))
            n *= 2
            wanted = _store(wide.join(tied, ["a", "v"]).select("d", "z", "p", F.lit(n).cast("long").alias("n")).distinct(), "repeat-tied")
            if wanted.isEmpty():
                break
            asked = asked.unionByName(wanted)
        asked = asked.groupBy("d", "z", "p").agg(F.max("n").alias("n"))
        return _store(_wide(self.rows, asked, self.min_bytes, self.k, True), "repeat-wide-contexts")

    def _grouped(self) -> tuple[DataFrame, DataFrame]:
        """Places (d, z, p, a, c) and the groups (a, c, g, l, r) of their contexts."""
        places = self._places()
        classes = places.groupBy("a", "c").agg(F.count("*").alias("n"), F.first("before").alias("before"), F.first("after").alias("after"))
        # a context of several places meets itself: two copies stand for all of them
        twice = classes.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(2)).cast("int"))))
        twice = _store(twice.withColumn("e", F.xxhash64("c", "copy")), "repeat-classes")
        found = _groups(twice.select("a", F.col("e").alias("c"), "before", "after"), self.min_bytes, self.k).withColumnRenamed("c", "e")
        groups = found.join(twice.select("a", "e", "c"), ["a", "e"]).select("a", "c", "g", "l", "r").distinct()
        return places.select("d", "z", "p", "a", "c"), groups

    def groups(self) -> DataFrame:
        """(a, c, g, l, r): the contexts of every maximal repeat g, of any length, seen at two places or more.

        The different wide contexts of one anchor meet in one task, however
        many they are: counted strings would give only parts of the repeats.
        """
        return self._grouped()[1]

    def occurrences(self) -> DataFrame:
        """(d, z, start, length, g): every place of every maximal repeat (identical rows of one id share theirs)."""
        at, groups = self._grouped()
        found = at.join(groups, ["a", "c"])
        return found.select("d", "z", (F.col("p") - F.col("l")).alias("start"), (F.col("l") + F.col("r")).alias("length"), "g").distinct()

    def covered(self) -> DataFrame:
        """(d, z, b, e): the maximal covered ranges of each document."""
        found = self.anchors.select("d", "z", "p", "a", "c").join(self.reach, ["a", "c"])
        spans = found.select("d", "z", (F.col("p") - F.col("l")).alias("b"), (F.col("p") + F.col("r")).alias("e"))
        w = W.partitionBy("d", "z").orderBy("b", "e")
        before = F.max("e").over(w.rowsBetween(W.unboundedPreceding, -1))
        begun = F.sum((before.isNull() | (F.col("b") > before)).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))
        return spans.withColumn("run", begun).groupBy("d", "z", "run").agg(F.min("b").alias("b"), F.max("e").alias("e")).drop("run")


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, with overlapping and touching ranges joined."""
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES,
                   kept_text: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes, if asked for).

    Every byte goes that is covered by a string of ``min_bytes`` bytes which
    also starts at another place, of the same or another row; strings are
    judged on the input.  Texts count as UTF-8 bytes, a null text as empty.
    Repeated rows are separate documents (each repeats the other), null ids
    are allowed.  An empty table gives no rows.
    """
    found = Repeats(docs, id_col, text_col, min_bytes)
    # begin and end in one number
    span = F.shiftleft(F.col("b").cast("long"), 32) + F.col("e")
    lists = _store(found.covered().groupBy("d", "z").agg(F.collect_list(span).alias("s")), "repeat-spans")
    src = _with_lists(found.rows, lists, "s", "left").select("d", "t", "s")
    kind = src.schema["d"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            n, gone, runs, sha, kept = [], [], [], [], []
            for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data = t.encode()
                spans = merge([(x >> 32, x & 0xFFFFFFFF) for x in s or []])
                at, parts = 0, []
                for lo, hi in spans:
                    parts.append(data[at:lo])
                    at = hi
                rest = b"".join([*parts, data[at:]])
                n.append(len(data))
                gone.append(len(data) - len(rest))
                runs.append(len(spans))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if kept_text else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                                              pa.array(sha, pa.string()), pa.array(kept, pa.binary())], names=["d", "n", "g", "k", "h", "r"])

    out = src.mapInArrow(run, f"d {kind}, n long, g long, k long, h string, r binary").toDF(
        id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    return out if kept_text else out.drop("kept")
