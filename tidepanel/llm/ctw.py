"""Byte language model by context-tree weighting.

The next byte is told in eight binary decisions; each decision node (the bits
told so far) has its own tree of contexts, the last 0 to DEPTH bytes.  A
node of that tree holds how often each bit followed in the training texts, and
its Krichevsky-Trofimov (KT) block probability.  Weighting mixes, with prior
one half, "this context is enough" (KT) with "split by one more byte" (the
product of the children), at all depths at once.  With the counts frozen after
training, the prediction of a bit is the same mixture of the KT estimates
along the context path, with posterior weights.

What is learnt is a Spark table: counts of byte strings of DEPTH + 1.  Trees are
built bottom-up in tasks that each hold the contexts of some last two bytes;
the few nodes above join them.  Texts are scored block by block: a block asks only for the words that occur in
it, so no vocabulary has to fit anywhere whole.  The byte strings go the same
way, unless there are few enough of them to broadcast.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucket_of, scratch_path, ship_package, slices

DEPTH = 5
#: Marks the end of a text and stands before its start; no UTF-8 text has this byte.
END = 0xFF
#: Documents of a block share one lookup.
BLOCK_ROWS = 8192
#: A model of at most so many byte strings (16 bytes each) is broadcast; of a larger one each block gets the strings it holds.
BROADCAST_STRINGS = 4_000_000


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x > 0: Stirling's series eight steps up, then back by the recurrence."""
    y, back = x + 8, x.copy()
    for i in range(1, 8):
        back *= x + i
    r = 1 / y
    series = r / 12 - r ** 3 / 360 + r ** 5 / 1260 - r ** 7 / 1680
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(back)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the KT probability of any sequence with a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def _store(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, packed tightly."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def grams_of(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of depth + 1 bytes ending at each byte and at the end of each text, and where each text's begin.

    Strings are numbers, the first byte highest; the contexts of a text's
    first bytes are filled up with END.
    """
    stream = np.frombuffer(bytes([END] * depth) + b"".join(t + bytes([END] * depth) for t in texts), np.uint8)
    g = np.zeros(len(stream) - depth, np.int64)
    for i in range(depth + 1):
        g = (g << 8) | stream[i:len(stream) - depth + i]
    sizes = np.array([len(t) + depth for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    # of the END bytes behind a text only the first is predicted
    skip = (starts + sizes)[:, None] - np.arange(1, depth)[None, :]
    g[skip.ravel()] = -1
    return g, starts


def _pieces(texts: list[bytes], size: int = 2 << 20) -> Iterator[tuple[int, int]]:
    lo = have = 0
    for i, t in enumerate(texts):
        have += len(t)
        if have >= size:
            yield lo, i + 1
            lo, have = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _as_bytes(t: str | None) -> bytes:
    return (t or "").encode().lower()  # bytes.lower() is A-Z alone


class _Tally:
    """Words and strings of the documents of one block seen by one task."""

    def __init__(self, depth: int):
        self.depth = depth
        self.words, self.other, self.grams = Counter(), set(), []

    def add(self, texts: list[bytes], held: list[bool]) -> None:
        for t, h in zip(texts, held, strict=True):
            (self.other if h else self.words).update(t.split())
        for lo, hi in _pieces(texts):
            for flag in (False, True):
                some = [t for t, h in zip(texts[lo:hi], held[lo:hi], strict=True) if h == flag]
                if some:
                    g, _ = grams_of(some, self.depth)
                    u, n = np.unique(g, return_counts=True)
                    self.grams.append((u[u >= 0], np.zeros(int((u >= 0).sum()), np.int64) if flag else n[u >= 0]))

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        g, n = np.concatenate([x[0] for x in self.grams]), np.concatenate([x[1] for x in self.grams])
        u, at = np.unique(g, return_inverse=True)
        n = np.bincount(at, n, len(u)).astype(np.int64)
        yield _rows(block, None, u, n)
        words = list(self.words) + list(self.other.difference(self.words))
        counts = [self.words[w] for w in words]
        for i in range(0, len(words), 50_000):
            yield _rows(block, words[i:i + 50_000], None, np.array(counts[i:i + 50_000], np.int64))


def _rows(block: int, words: list[bytes] | None, grams: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    size = len(n)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(size, block, np.int64)), pa.nulls(size, pa.binary()) if words is None else pa.array(words, pa.binary()),
         pa.nulls(size, pa.int64()) if grams is None else pa.array(grams), pa.array(n)], names=["b", "w", "g", "n"])


def count_blocks(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(b, w, g, n): for each block the words (w) and byte strings (g) that occur in it, with training counts.

    ``docs`` has b (block), t (text), h (held out: counted as 0, but asked for).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, tally = None, None
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if blocks[lo] != block:
                    if tally is not None:
                        yield from tally.batches(block)
                    block, tally = int(blocks[lo]), _Tally(depth)
                for i in range(lo, hi, 500):
                    part = batch.slice(i, min(500, hi - i))
                    tally.add([_as_bytes(t) for t in part.column(1).to_pylist()], part.column(2).to_pylist())
        if tally is not None:
            yield from tally.batches(block)

    return docs.select("b", "t", "h").mapInArrow(run, "b long, w binary, g long, n long")


class _Level:
    """Nodes of one context depth, in key order: key = context bytes, then the bits told (with a leading 1)."""

    def __init__(self, key: np.ndarray, a: np.ndarray, b: np.ndarray, split: np.ndarray | None):
        self.key, self.a, self.b = key, a, b
        kt = log_kt(a, b)
        if split is None:  # full depth: no split beyond
            self.lw, self.stop = kt, np.ones(len(kt))
        else:
            high, low = np.maximum(kt, split), np.minimum(kt, split)
            self.lw = high + np.log1p(np.exp(low - high)) - math.log(2)
            self.stop = 1 / (1 + np.exp(np.clip(split - kt, -700, 700)))
        self.one = (b + 0.5) / (a + b + 1)

    def above(self, depth: int) -> "_Level":
        """The level of ``depth`` context bytes, one less than this one's; ``up`` then leads there."""
        context, told = self.key >> 8, self.key & 255
        key, self.up = np.unique(((context & ((1 << 8 * depth) - 1)) << 8) | told, return_inverse=True)
        return _Level(key, *(np.bincount(self.up, x, len(key)) for x in (self.a, self.b, self.lw)))

    def mix(self, p: np.ndarray | float, left: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        """Mixture so far and weight still to give, below a parent that had ``p`` and ``left``."""
        return p + left * self.stop * self.one, left * (1 - self.stop)


def _levels(g: np.ndarray, n: np.ndarray, depth: int, least: int) -> tuple[list[_Level], np.ndarray, np.ndarray]:
    """Levels ``least`` to ``depth`` over the strings, and for each bit of each string its node and value."""
    sym = g & 255
    told = np.stack([(1 << i) | (sym >> (8 - i)) for i in range(8)])
    bit = np.stack([(sym >> (7 - i)) & 1 for i in range(8)])
    key, at = np.unique((((g >> 8) << 8)[None, :] | told).ravel(), return_inverse=True)
    count = np.tile(n, 8).astype(np.float64)
    ones = np.bincount(at, count * bit.ravel(), len(key))
    levels = [_Level(key, np.bincount(at, count, len(key)) - ones, ones, None)]
    for d in range(depth - 1, least - 1, -1):
        levels.insert(0, levels[0].above(d))
    return levels, at.reshape(8, -1), bit


#: Strings a task takes at once, about (whole groups of equal last two context bytes).
PART_STRINGS = 200_000


def _by_group(rows: DataFrame, work, schema: str) -> DataFrame:
    """Apply ``work(g, n)`` to strings (g, n), all that share the last two context bytes together."""
    dealt = rows.withColumn("k", F.expr("cast(shiftright(g, 8) & 65535 as int)")).repartition("k").sortWithinPartitions("k").select("k", "g", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gs, ns, size, last = [], [], 0, None
        for b in batches:
            k, g, n = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for lo, hi in zip([0, *(np.flatnonzero(np.diff(k)) + 1)], [*(np.flatnonzero(np.diff(k)) + 1), len(k)], strict=True):
                if lo == hi:
                    continue
                if k[lo] != last and size > PART_STRINGS:
                    yield work(np.concatenate(gs), np.concatenate(ns))
                    gs, ns, size = [], [], 0
                last = k[lo]
                gs.append(g[lo:hi])
                ns.append(n[lo:hi])
                size += hi - lo
        if gs:
            yield work(np.concatenate(gs), np.concatenate(ns))

    return dealt.mapInArrow(run, schema)


def string_probabilities(counts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(g, lp): log10 probability of the last byte of each string after the others.

    ``counts`` has g (each once) and n (training count; 0 for strings that are
    only asked for: a node without counts has KT probability one and predicts
    one half, as an unseen context must).  Contexts with equal last two bytes
    are one task's, from their full depth up to depth 2.  The nodes of depth 1
    and 0, at most 257 x 255, are summed by Spark and weighted on the driver,
    and a second pass predicts from them downwards.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6 bytes")

    def upwards(g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        low = _levels(g, n, depth, 2)[0][0]
        return pa.RecordBatch.from_pydict({"key": pa.array(low.key), "a": pa.array(low.a), "b": pa.array(low.b), "lw": pa.array(low.lw)})

    second = _by_group(counts, upwards, "key long, a double, b double, lw double")
    top = (second.groupBy((F.col("key").bitwiseAND(0xFFFF)).alias("key"))
           .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("lw").alias("split")).orderBy("key").toPandas())
    one = _Level(*(top[c].to_numpy() for c in ("key", "a", "b", "split")))
    nil = one.above(0)
    p, left = nil.mix(0.0, 1.0)
    p, left = one.mix(p[one.up], left[one.up])
    have = np.zeros((2, 1 << 16))
    have[0, one.key], have[1, one.key] = p, left

    def downwards(g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        levels, at, bit = _levels(g, n, depth, 2)
        p, left = levels[0].mix(*have[:, levels[0].key & 0xFFFF])
        for level in levels[1:]:
            p, left = level.mix(p[level.up], left[level.up])
        lp = np.log10(np.where(bit == 1, p[at], 1 - p[at])).sum(0)
        return pa.RecordBatch.from_pydict({"g": pa.array(g), "lp": pa.array(lp)})

    return _by_group(counts, downwards, "g long, lp double")


class _Lookup:
    """log10 probabilities of strings, in a hash table of arrays (every string asked for must be in it)."""

    def __init__(self, g: np.ndarray, lp: np.ndarray, depth: int):
        self.depth = depth
        bits = max(4, int(2 * len(g)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.lp = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        left, at = np.arange(len(g)), self._place(g)
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = g[left[free]]  # of several that want a place one stays
            won = self.keys[at] == g[left]
            self.lp[at[won]] = lp[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.mask

    def _place(self, g: np.ndarray) -> np.ndarray:
        return ((g.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def score(self, texts: list[bytes]) -> np.ndarray:
        g, starts = grams_of(texts, self.depth)
        skip = g < 0
        g[skip] = g[0]
        at = self._place(g)
        miss = np.flatnonzero(self.keys[at] != g)
        while len(miss):
            at[miss] = (at[miss] + 1) & self.mask
            miss = miss[self.keys[at[miss]] != g[miss]]
        lp = self.lp[at]
        lp[skip] = 0.0
        return np.add.reduceat(lp, starts)


_SHARED: dict[str, _Lookup] = {}


def _shared(name: str, value: tuple[np.ndarray, np.ndarray], depth: int) -> _Lookup:
    """The lookup of a broadcast model, built once per worker; ``name`` tells models apart."""
    if name not in _SHARED:
        _SHARED.clear()
        _SHARED[name] = _Lookup(*value, depth)
    return _SHARED[name]


def score_texts(docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                depth: int = DEPTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Score every text by a model of the texts for which ``held_out`` (a condition on column ``id_col``) is not true.

    Returns id, held_out, n_tokens, n_known, train_tokens (long), base_score,
    score (double).  A-Z count as lower case throughout.  ``base_score`` is
    that of an add-one word model whose tokens are the words and one end per
    text; ``score`` is the log10 probability of the text's bytes and its end
    by context-tree weighting.  A null text is an empty one (one token, the
    end), a null id is not held out, repeated rows count each time, an empty
    table gives no rows; with nothing to learn from, every bit has
    probability one half.
    """
    spark = docs.sparkSession
    ship_package(spark)
    held = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    kept = docs.select(F.col(id_col).alias("d"), F.col(text_col).cast("string").alias("t"), held.alias("h"),
                       F.floor(F.monotonically_increasing_id() / block_rows).alias("b"))
    kept = _store(kept, "ctw-texts")  # rows keep their block from here on
    counted = _store(count_blocks(kept, depth), "ctw-counts")
    words = _store(counted.filter("w is not null").groupBy("w").agg(F.sum("n").alias("c")), "ctw-words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    ends = kept.filter(~F.col("h")).count()
    n, v = n + ends, v + (ends > 0)
    unit = math.log10(n + v + 1)

    strings = counted.filter("g is not null").select("b", "g", "n")
    totals = _store(strings.groupBy("g").agg(F.sum("n").alias("n")), "ctw-strings")
    probs = string_probabilities(totals, depth)
    kind = kept.schema["d"].dataType.simpleString()
    nothing = lambda t: F.lit(None).cast(t)
    shared, name = None, uuid.uuid4().hex
    if totals.count() <= BROADCAST_STRINGS:
        got = probs.toArrow()
        shared = spark.sparkContext.broadcast((got["g"].to_numpy(), got["lp"].to_numpy()))
        del got
    rows = (counted.filter("w is not null").select("b", "w").join(words, "w")
            .select("b", F.lit(0).alias("k"), "w", nothing("long").alias("g"), F.col("c").cast("double").alias("x"),
                    nothing(kind).alias("d"), nothing("string").alias("t"), nothing("boolean").alias("h"))
            .unionByName(kept.select("b", F.lit(2).alias("k"), nothing("binary").alias("w"), nothing("long").alias("g"),
                                     nothing("double").alias("x"), "d", "t", "h")))
    if shared is None:
        rows = rows.unionByName(strings.join(probs, "g").select(
            "b", F.lit(1).alias("k"), nothing("binary").alias("w"), "g", F.col("lp").alias("x"),
            nothing(kind).alias("d"), nothing("string").alias("t"), nothing("boolean").alias("h")))
    rows = rows.repartition("b").sortWithinPartitions("b", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, logs, gs, lps, look = None, {}, [], [], None
        unknown = -unit  # log10 of (0 + 1) over the same total
        for batch in batches:
            bs, ks = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((np.diff(bs) != 0) | (np.diff(ks) != 0)) + 1), len(bs)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if bs[lo] != block:
                    block, logs, gs, lps, look = bs[lo], {}, [], [], None
                part = batch.slice(lo, hi - lo)
                if ks[lo] == 0:
                    logs.update(zip(part.column(2).to_pylist(), (np.log10(part.column(4).to_numpy() + 1) - unit).tolist(), strict=True))
                    continue
                if ks[lo] == 1:
                    gs.append(part.column(3).to_numpy())
                    lps.append(part.column(4).to_numpy())
                    continue
                if look is None:
                    look = _shared(name, shared.value, depth) if shared is not None else _Lookup(np.concatenate(gs), np.concatenate(lps), depth)
                for part in slices(iter([part]), 6):
                    texts = [_as_bytes(t) for t in part.column(6).to_pylist()]
                    base, size, seen = [], [], []
                    for t in texts:
                        parts = np.array([logs[w] for w in t.split()])
                        size.append(len(parts) + 1)
                        base.append(float(parts.sum()) + math.log10(ends + 1) - unit)
                        seen.append(int((parts > unknown).sum()) + (ends > 0))
                    score = np.concatenate([look.score(texts[i:j]) for i, j in _pieces(texts)])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(5), part.column(7), pa.array(size, pa.int64()), pa.array(seen, pa.int64()),
                         pa.array([n] * len(texts), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())],
                        names=["d", "h", "n", "k", "t", "b", "s"])

    out = rows.mapInArrow(run, f"d {kind}, h boolean, n long, k long, t long, b double, s double")
    return out.toDF(id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def fold_held_out(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    return bucket_of(id_col, folds) == fold
