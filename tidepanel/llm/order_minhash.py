"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its k-word shingles, each labelled with how often
it occurred before.  A sketch takes the LENGTH labelled shingles that are
smallest under one hash function and keeps them in text order, so two texts
agree in a sketch only if they share these shingles in the same order: the
chance follows edit similarity, not just set overlap.  Texts that agree in
one of SKETCHES sketches meet in a bucket.

A bucket is not expanded to pairs.  Its most popular text leads it, and all
texts led by one text form a group in which every pair is compared inside a
task: shared shingles of all pairs come from one matrix product, and a pair
that may reach the threshold is aligned, unless links found before connect it
already.  What comes out is a spanning set of links, at most one per text and
group, from which connected components make the classes.

A group of more than a block is first held against its leader, one alignment
a text.  The texts linked to it are connected and never meet each other.  The
rest is regrouped by shingle prefixes: in an order that puts the leader's
shingles last, two texts that reach the threshold share one of their first
(1 - threshold) n + 1 shingles, so no link is lost.  Linked texts meet those
of the rest that the triangle inequality of the Jaccard distance allows: the
distances of two similar texts from the leader differ by no more than theirs.

Similarity is that of the aligned shingles: L / (n1 + n2 - L) for the longest
common subsequence L.  It never exceeds the Jaccard similarity of the
shingles, and equals it where nothing was moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, together, cut_lineage, ship_package, slices
from .graph import components, with_group_min

WORDS, SKETCHES, LENGTH, THRESHOLD = 5, 20, 4, 0.8
#: A group is compared in pairs of blocks of at most so many texts and shingles.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 2_000_000
#: Groups of more than a block are split by leaders so many times; what is then still larger is compared in pairs of blocks.
STARS = 2
#: Bands of distance from a leader in which linked texts wait for the rest.
BANDS = 4
#: Shingles are compared by 32 bits; distances and prefixes leave room for so large a share of chance equals.
SLACK = 1e-3

MULT = np.uint64(0x9E3779B97F4A7C15)
SALT = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * SALT
    x = (x ^ (x >> np.uint64(29))) * MULT
    return x ^ (x >> np.uint64(32))


SEEDS = _mix(np.arange(1, 257, dtype=np.uint64) * MULT)


class _WordHash(dict):
    def __missing__(self, w: str) -> int:
        if len(self) > 150_000:
            self.clear()
        self[w] = h = xxhash.xxh64_intdigest(w)
        return h


_HASH = _WordHash()


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Hashes of the occurrence-labelled k-word shingles, in text order.

    Words are what white space separates, in lower case.  A text of fewer
    than k words, but at least one, is one shingle.
    """
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([_HASH[w] for w in words], np.uint64)
    k = min(k, len(h))
    n = len(h) - k + 1
    s = np.full(n, k, np.uint64)
    for i in range(k):
        s = _mix(s + h[i:i + n])
    order = np.argsort(s, kind="stable")
    sorted_ = s[order]
    same = np.flatnonzero(sorted_[1:] == sorted_[:-1]) + 1
    if len(same):
        first = np.arange(n)
        first[same] = 0
        nth = np.empty(n, np.uint64)
        nth[order] = (np.arange(n) - np.maximum.accumulate(first)).astype(np.uint64)
        s = np.where(nth > 0, _mix(s + nth * MULT), s)
    return s


def sketch(s: np.ndarray, sketches: int = SKETCHES, length: int = LENGTH) -> list[int]:
    """One number per sketch: its smallest shingles, folded in text order."""
    if not len(s):
        return []
    length = min(length, len(s))
    out = np.zeros(sketches, np.uint64)
    step = max(1, 500_000 // len(s))
    for lo in range(0, sketches, step):
        seeds = SEEDS[lo:min(lo + step, sketches)]
        v = _mix(s[None, :] ^ seeds[:, None])
        at = np.sort(np.argpartition(v, length - 1, axis=1)[:, :length], axis=1) if length < len(s) else np.tile(np.arange(length), (len(seeds), 1))
        fold = seeds.copy()
        for i in range(length):
            fold = _mix(fold + s[at[:, i]])
        out[lo:lo + len(seeds)] = fold
    return out.astype(np.int64).tolist()


def common_subsequence(x: np.ndarray, places: dict[int, int], n2: int, band: int) -> int:
    """Length of the longest common subsequence of x and y using only cells |i - j| <= band.

    ``places`` has for each value of y its positions as bits; a row of the
    alignment is one long integer, so a row costs a few integer operations.
    """
    full = (1 << n2) - 1
    row, window = full, (1 << (2 * band + 1)) - 1
    for i, v in enumerate(x):
        m = places.get(v)
        if m is None:
            continue
        m &= (window << (i - band)) if i >= band else (window >> (band - i))
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return n2 - row.bit_count()


def bits_of(y: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for j, v in enumerate(y):
        out[v] = out.get(v, 0) | (1 << j)
    return out


def similar(x: list[int], y: list[int], threshold: float = THRESHOLD) -> bool:
    """Whether the aligned similarity reaches the threshold.

    Shared ends are matched outright.  An alignment that reaches it leaves at
    most n1 + n2 - 2 L elements unmatched, which is the width of the band.
    """
    need = int(np.ceil(threshold * (len(x) + len(y)) / (1 + threshold) - 1e-9))
    band = len(x) + len(y) - 2 * need
    if need > min(len(x), len(y)):
        return False
    a, m = 0, min(len(x), len(y))
    while a < m and x[a] == y[a]:
        a += 1
    b = 0
    while b < m - a and x[-1 - b] == y[-1 - b]:
        b += 1
    if a + b >= need:
        return True
    x, y = x[a:len(x) - b], y[a:len(y) - b]
    return a + b + common_subsequence(x, bits_of(y), len(y), band) >= need


def group_links(ids: np.ndarray, seqs: list[np.ndarray], side: np.ndarray | None = None,
                threshold: float = THRESHOLD, one: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what the similar pairs of a group connect.

    With ``side`` only pairs of different sides are compared; the texts of
    which ``one`` is true count as connected from the start.  Shared
    shingles of every pair come from a product of the texts-by-shingles
    matrix, built in column chunks from the shingles that occur twice.
    """
    n = len(ids)
    sizes = np.array([len(s) for s in seqs], np.int64)
    flat = np.concatenate(seqs)
    owner = np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    twice = np.cumsum(count > 1) - 1
    keep = count[code] > 1
    owner, code = owner[keep], twice[code[keep]]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    shared = np.zeros((n, n), np.float32)
    width = 2048
    total = int(code[-1]) + 1 if len(code) else 0
    for lo in range(0, total, width):
        i, j = np.searchsorted(code, [lo, lo + width])
        x = np.zeros((n, min(width, total - lo)), np.float32)
        x[owner[i:j], code[i:j] - lo] = 1
        shared += x @ x.T
    least = (threshold * sizes).astype(np.float32)
    may = shared * np.float32(1 + threshold) >= least[:, None] + least[None, :] - np.float32(1e-3 + 1e-6 * sizes.max())
    del shared
    np.fill_diagonal(may, False)
    if side is not None:
        may &= side[:, None] != side[None, :]
    comp, lists, out = np.arange(n), {}, []
    if one is not None and one.any():
        comp[one] = np.flatnonzero(one)[0]
    for i in np.argsort(-may.sum(1), kind="stable"):  # the best connected first
        row = may[i].copy()
        while True:
            js = np.flatnonzero(row & (comp != comp[i]))
            if not len(js):
                break
            j = js[0]
            row[j] = False
            for a in (i, j):
                if a not in lists:
                    lists[a] = seqs[a].tolist()
            if similar(lists[i], lists[j], threshold):
                out.append((int(ids[i]), int(ids[j])))
                comp[comp == comp[j]] = comp[i]
    return out


def sketch_texts(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, sketches: int = SKETCHES,
                 length: int = LENGTH) -> DataFrame:
    """(d, h, n, s): id, text hash, number of shingles, sketches of every row (null text: empty)."""
    src = docs.select(F.col(id_col).alias("d"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("h"),
                      F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            n, s = [], []
            for t in b.column(2).to_pylist():
                x = shingles(t, words)
                n.append(len(x))
                s.append(sketch(x, sketches, length))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.int64()))],
                                             names=["d", "h", "n", "s"])

    return src.mapInArrow(run, f"d {src.schema['d'].dataType.simpleString()}, h string, n long, s array<long>")


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) of groups: ``rows`` has g (group), i, j (pair of blocks), side, one (connected already), r (text), x (shingles)."""
    rows = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")

    def links(ids: list, xs: list, sides: list, ones: list, cross: bool) -> pa.RecordBatch | None:
        at = {r: k for k, r in enumerate(ids)}  # a repeated row counts once
        if len(at) < 2:
            return None
        k = list(at.values())
        got = group_links(np.array(ids)[k], [np.frombuffer(xs[a], "<u4") for a in k], np.array(sides)[k] if cross else None, threshold,
                          np.array(ones)[k])
        return pa.RecordBatch.from_pydict({"u": pa.array([a for a, _ in got], pa.int64()), "v": pa.array([b for _, b in got], pa.int64())}) if got else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, xs, sides, ones = None, [], [], [], []
        for b in batches:
            for g, i, j, side, one, r, x in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (g, i, j) != key:
                    if key is not None and (out := links(ids, xs, sides, ones, key[1] != key[2])) is not None:
                        yield out
                    key, ids, xs, sides, ones = (g, i, j), [], [], [], []
                ids.append(r)
                xs.append(x)
                sides.append(side)
                ones.append(one)
        if key is not None and (out := links(ids, xs, sides, ones, key[1] != key[2])) is not None:
            yield out

    return rows.select("g", "i", "j", "side", "one", "r", "x").mapInArrow(run, "u long, v long")


def prefix(x: np.ndarray, last: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """First shingles of the set ``x`` in the order (is in ``last``, value); similar texts share one of theirs."""
    n = int((1 - threshold + SLACK) * len(x)) + 2
    common = np.isin(x, last, assume_unique=True)
    return np.concatenate([x[~common][:n], x[common]])[:n]


def _stars(dealt: DataFrame, packed: DataFrame, threshold: float) -> DataFrame:
    """(g, lead, chain, r, n, linked, far, keys): every text of a group held against the group's leader.

    ``dealt`` has g, chain (the leaders that led here, this group's last), r,
    n, blocks, side.  A task streams one block of a group past the leader.
    ``far`` is the Jaccard distance from it, ``keys`` the prefix of a text
    that is not linked.
    """
    heads = (dealt.select("g", "chain", "blocks").distinct().withColumn("side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("g", "chain", "side", F.posexplode("chain").alias("place", "r")))
    rows = (heads.withColumn("n", F.lit(0).cast("long"))
            .unionByName(dealt.select("g", "chain", "side", F.lit(None).cast("int").alias("place"), "r", "n"))
            .join(packed, "r").repartition("g", "side").sortWithinPartitions("g", "side", F.asc_nulls_last("place")))
    reach = 1 - threshold + SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leaders = None, []
        for b in slices(batches, 6):
            out = []
            for g, side, chain, place, r, n, x in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if (g, side) != key:
                    key, leaders = (g, side), []
                x = np.frombuffer(x, "<u4")
                if place is not None:
                    leaders.append(x)
                    if len(leaders) == len(chain):
                        head, head_list, last = np.unique(x), x.tolist(), np.unique(np.concatenate(leaders))
                    continue
                u = np.unique(x)
                both = len(np.intersect1d(u, head, assume_unique=True))
                far = 1 - both / (len(u) + len(head) - both)
                linked = r == chain[-1] or (far <= reach and similar(x.tolist(), head_list, threshold))
                out.append((g, chain[-1], chain, r, n, linked, far, None if linked else prefix(u, last, threshold).astype(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    names = ["g", "lead", "chain", "r", "n", "linked", "far", "keys"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.list_(pa.int64())]
    return rows.select("g", "side", "chain", "place", "r", "n", "x").mapInArrow(
        run, "g long, lead long, chain array<long>, r long, n long, linked boolean, far double, keys array<long>")


def _elect(member: DataFrame) -> DataFrame:
    """``member`` (b: bucket, c: its size, r, n, ...) with ``lead``: the most popular of its bucket's texts."""
    popular = member.groupBy("r").agg(F.sum("c").alias("pop")).withColumnRenamed("r", "r2")
    # of equally popular texts the one with the smaller number
    ranked = (member.join(popular, F.col("r") == F.col("r2")).withColumn("rank", F.struct((-F.col("pop")).alias("pop"), F.col("r").alias("lead")))
              .drop("c", "pop", "r2"))
    return with_group_min(ranked, "b", "rank", "first", "r").withColumn("lead", F.col("first.lead")).drop("first", "rank", "b")


def _block_count(texts: str, shingles_: str) -> Column:
    return F.greatest(F.ceil(F.expr(texts) / BLOCK_TEXTS), F.ceil(F.expr(shingles_) / BLOCK_SHINGLES)).cast("int")


def _linked_to_rest(stars: DataFrame, packed: DataFrame, threshold: float) -> DataFrame:
    """Links between the texts linked to a leader and the rest of its group that is near enough.

    Linked texts lie in BANDS + 1 bands by distance from the leader, up to
    that of a link; a text further away meets only the bands from its own
    distance less that of a link.
    """
    reach = 1 - threshold + SLACK
    band = lambda c: F.floor(c * (BANDS / reach)).cast("int")
    bands = F.when(F.col("linked"), F.array(F.least(band(F.col("far")), F.lit(BANDS)))).otherwise(
        F.sequence(F.greatest(band(F.col("far") - reach), F.lit(0)), F.lit(BANDS)))
    met = (stars.filter(F.col("linked") | (F.col("far") <= 2 * reach)).withColumn("band", F.explode(bands))
           .select(F.xxhash64("g", "band").alias("g"), "r", "n", "linked"))
    totals = met.groupBy(F.col("g").alias("g2")).agg(
        _block_count("count_if(not linked)", "sum(if(linked, 0, n))").alias("rest"),
        _block_count("count_if(linked)", "sum(if(linked, n, 0))").alias("blocks")).filter("rest > 0 and blocks > 0")
    # a text of one side meets every block of the other
    own = F.pmod(F.xxhash64("r"), F.when(F.col("linked"), F.col("blocks")).otherwise(F.col("rest"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("linked"), F.col("rest")).otherwise(F.col("blocks")) - 1))
    rows = (salted_lookup(met, totals, "g", "g2", "r").withColumn("own", own).withColumn("o", other)
            .select("g", "r", F.when(F.col("linked"), F.col("o")).otherwise(F.col("own")).alias("i"),
                    (F.col("rest") + F.when(F.col("linked"), F.col("own")).otherwise(F.col("o"))).alias("j"),
                    F.col("linked").cast("int").alias("side"), F.col("linked").alias("one")))
    return _compare(rows.join(packed, "r"), threshold)


def _links(led: DataFrame, packed: DataFrame, threshold: float, stars_left: int) -> DataFrame:
    """Links of groups: ``led`` has g, chain, r, n (once for each text and group)."""
    totals = led.groupBy(F.col("g").alias("g2")).agg(_block_count("count(*)", "sum(n)").alias("blocks"))
    dealt = salted_lookup(led, totals, "g", "g2", "r").withColumn("side", F.pmod(F.xxhash64("r"), F.col("blocks")).cast("int"))
    dealt = cut_lineage(dealt, "omh-dealt")
    large = dealt.filter("blocks > 1")
    split = stars_left > 0 and not large.isEmpty()
    # a text goes to every pair of blocks that its own block is part of
    blocks = ((dealt.filter("blocks = 1") if split else dealt).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("g", "r", "side", F.least("side", "o").alias("i"), F.greatest("side", "o").alias("j"), F.lit(False).alias("one")))
    links = _compare(blocks.join(packed, "r"), threshold)
    if not split:
        return links
    stars = cut_lineage(_stars(large, packed, threshold), "omh-stars")
    links = links.unionByName(stars.filter("linked and r <> lead").select(F.col("lead").alias("u"), F.col("r").alias("v")))
    links = links.unionByName(_linked_to_rest(stars, packed, threshold))
    rest = stars.filter("not linked").select("chain", F.explode("keys").alias("key"), "r", "n").withColumn("b", F.xxhash64("chain", "key")).drop("key")
    size = rest.groupBy(F.col("b").alias("b2")).agg(F.count("*").alias("c")).filter("c > 1")
    rest = cut_lineage(salted_lookup(rest, size, "b", "b2", "r"), "omh-rest")
    again = (_elect(rest).withColumn("chain", F.concat("chain", F.array("lead")))
             .select(F.xxhash64("chain").alias("g"), "chain", "r", "n").distinct())
    return links.unionByName(_links(cut_lineage(again, "omh-again"), packed, threshold, stars_left - 1))


def _first_rows(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, sketches: int = SKETCHES,
                length: int = LENGTH, threshold: float = THRESHOLD) -> DataFrame:
    """(d, h, first): id and text hash of every row, and the first row of its class as struct (null, d, h)."""
    ship_package(docs.sparkSession)
    rows = cut_lineage(sketch_texts(docs, id_col, text_col, words, sketches, length), "omh-rows")
    texts = cut_lineage(rows.groupBy("h").agg(F.min("d").alias("d"), F.first("n").alias("n"), F.first("s").alias("s"))
                        .withColumn("r", F.monotonically_increasing_id()), "omh-texts")
    member = texts.select("r", "n", F.explode("s").alias("b"))
    size = member.groupBy("b").agg(F.count("*").alias("c")).filter("c > 1")
    member = cut_lineage(member.join(size, "b"), "omh-members")
    led = cut_lineage(_elect(member).select(F.col("lead").alias("g"), F.array("lead").alias("chain"), "r", "n").distinct(), "omh-led")
    wanted = texts.join(led.select("r").distinct(), "r", "left_semi").select("r", "h", "d")
    src = docs.select(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("h2"), F.col(id_col).alias("d2"),
                      F.col(text_col).cast("string").alias("t"))
    found = src.join(wanted, (F.col("h") == F.col("h2")) & F.col("d").eqNullSafe(F.col("d2"))).select("r", "t")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            x = [(shingles(t, words) >> np.uint64(32)).astype("<u4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary())], names=["r", "x"])

    packed = cut_lineage(found.mapInArrow(pack, "r long, x binary"), "omh-shingles")
    links = _links(led, packed, threshold, STARS)
    roots = components(links)

    named = (texts.select("h", "r", F.struct(F.col("d").isNull().alias("null"), "d", "h").alias("me"))
             .join(roots, F.col("r") == F.col("node"), "left").withColumn("root", F.coalesce("root", "r")))
    classes = with_group_min(named.select("h", "r", "me", "root"), "root", "me", "first", "r").select(F.col("h").alias("h2"), "first")
    return salted_lookup(rows.select("d", "h"), classes, "h", "h2", "d")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, class_id): the class of every row, named by the smallest id in it.

    Equal texts are one class from the start (null and empty texts too are
    equal), and enter the search once.  Rows that repeat an id get one row
    each.  A class in which every id is null has a null name.  An empty table
    gives no rows.
    """
    return _first_rows(docs, id_col, text_col, **how).select(F.col("d").alias(id_col), F.col("first.d").alias("class_id"))


def salted_lookup(rows: DataFrame, look: DataFrame, key: str, look_key: str, salt_of: str, salts: int = 64) -> DataFrame:
    """Inner join of ``rows`` to one row per key, by (key, salt): only salts that occur are made."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int"))
    some = salted.select(F.col(key).alias("_k"), F.col("_salt").alias("_s")).distinct()
    spread = some.join(look, F.col("_k") == F.col(look_key))
    return salted.join(spread, (F.col(key) == F.col("_k")) & (F.col("_salt") == F.col("_s"))).drop("_salt", "_s", "_k", look_key)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The first row of each class by id (null ids last): one document of each group stays.

    Of rows that repeat both id and text one stays.  Other columns stay as
    they are, whatever their names; they play no part.
    """
    whole, (docs, names) = docs, apart(docs, id_col, text_col)
    first = (_first_rows(docs, id_col, text_col, **how).select(F.col("first.d").alias("_omh_d"), F.col("first.h").alias("_omh_h")).distinct())
    hashed = docs.withColumn("_omh_text", F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")))
    kept = hashed.join(first, (F.col("_omh_text") == F.col("_omh_h")) & F.col(id_col).eqNullSafe(F.col("_omh_d")), "left_semi")
    # repeated rows are rare, so that only they pay for a look at each other
    again = docs.groupBy(F.col(id_col).alias("_omh_d")).agg(F.count("*").alias("_omh_n")).filter("_omh_n > 1").select("_omh_d")
    if again.isEmpty():
        return together(kept, names, whole)
    same = F.col(id_col).eqNullSafe(F.col("_omh_d"))
    once = kept.join(again, same, "left_semi").dropDuplicates([id_col, "_omh_text"])
    return together(kept.join(again, same, "left_anti").unionByName(once), names, whole)
