"""Mixing sources to target weights by temperature.

A source's weight is its token share raised to an exponent and normalised: 1
keeps the shares, 0 makes all sources equal.  The exponent is bisected until
the weights have a wanted entropy, or until the most repeated source is read
as often as allowed.  Weights times a token budget give each source a quota;
the quota is realised as whole passes over the source in freshly permuted
block order, and a last pass cut where the budget ends.

What a source needs to know about its cut is one row (the place in the last
permutation where it ends), so the rows themselves are never ranked: each
compares its own place with its source's cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import apart, column, together, cut_lineage

#: Exponents tried at once in a round, and rounds: the bracket shrinks to 16**-12.
WAYS, ROUNDS = 16, 12
#: A source table of at most so many rows is broadcast; a larger one is joined by (source, salt).
BROADCAST_SOURCES, SALTS = 10_000, 64
# Words for token counts; the characters are fixed so that every engine cuts alike.
WORD = r"[^ \t\n\r]+"


def word_count(col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def source_key(col: str) -> Column:
    """A string for each source; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("s"), F.col(col).cast("string")), F.lit("null"))


def _md5(*parts) -> Column:
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]).cast("binary"))


def with_places(docs: DataFrame, source_col: str, id_col: str, seed: int) -> DataFrame:
    """Add source key ``_mix_s``, document key ``_mix_k`` and its blocks ``_mix_b1`` (256 of a source) and ``_mix_b2`` (4096 of a block)."""
    key = _md5(seed, F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return (docs.withColumn("_mix_s", source_key(source_col)).withColumn("_mix_k", key)
            .withColumn("_mix_b1", F.substring("_mix_k", 1, 2)).withColumn("_mix_b2", F.substring("_mix_k", 3, 3)))


def shares(tokens: DataFrame) -> DataFrame:
    """(_mix_s, n, p): tokens of each source and its share; sources without tokens are left out."""
    total = tokens.agg(F.sum("_mix_n")).first()[0] or 1
    return (tokens.groupBy("_mix_s").agg(F.sum("_mix_n").alias("n")).filter("n > 0")
            .select("_mix_s", "n", (F.col("n") / F.lit(float(total))).alias("p")))


def exponent(sh: DataFrame, max_repeats: float | None = None, target_entropy: float | None = None,
             budget_tokens: int | None = None) -> float:
    """The smallest exponent in [0, 1] within the repetition limit, or the largest that reaches the entropy.

    Both grow as the exponent falls, so each is bisected, some exponents a
    round; a round is one aggregate over the sources and returns one number
    for each exponent.  Without a budget, the largest source is read once.
    An entropy beyond that of equal weights gives 0; a limit that even the
    plain shares pass gives 1.
    """
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        tries = [lo + (hi - lo) * i / WAYS for i in range(WAYS + 1)]
        cols = []
        for i, a in enumerate(tries):
            q = F.pow(F.col("p"), F.lit(a))
            if target_entropy is not None:
                cols.append((F.ln(F.sum(q)) - F.sum(q * F.ln(q)) / F.sum(q)).alias(f"c{i}"))
            elif budget_tokens is None:
                cols.append((F.max(F.pow(F.col("p"), F.lit(a - 1))) / F.min(F.pow(F.col("p"), F.lit(a - 1)))).alias(f"c{i}"))
            else:
                cols.append((F.max(q / F.col("n")) / F.sum(q) * budget_tokens).alias(f"c{i}"))
        row = sh.agg(*cols).first()
        limit = target_entropy if target_entropy is not None else max_repeats
        above = [row[i] is not None and row[i] > limit for i in range(WAYS + 1)]
        if not above[0] or above[-1]:
            return lo if not above[0] else hi
        k = max(i for i in range(WAYS + 1) if above[i])
        lo, hi = tries[k], tries[k + 1]
    return lo if target_entropy is not None else hi


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", tokens: Column | None = None,
             text_col: str = "text", max_repeats: float | None = 2.0, target_entropy: float | None = None,
             budget_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """One row per source: _mix_s, weight, quota, full (whole passes), cut (where the next pass ends; null: not begun).

    ``cut`` is the struct (block place, sub-block place, document key) of the
    last document taken in pass number ``full``.  Documents of equal id are
    taken together or not at all.
    """
    tokens = word_count(text_col) if tokens is None else tokens
    t = cut_lineage(with_places(docs, source_col, id_col, seed).select("_mix_s", "_mix_k", "_mix_b1", "_mix_b2", tokens.alias("_mix_n")), "mix-tokens")
    sh = cut_lineage(shares(t), "mix-shares")
    a = exponent(sh, max_repeats, target_entropy, budget_tokens)
    q = sh.withColumn("q", F.pow("p", F.lit(a)))
    z, once = q.agg(F.sum("q"), F.max(F.col("n") / F.col("q"))).first()
    z = z or 1.0
    budget = float(budget_tokens) if budget_tokens is not None else (once or 0.0) * z
    # a hair above: the last bits of the division do not count
    quota = F.floor(F.lit(budget) * F.col("q") / F.lit(z) + F.lit(1e-6)).cast("long")
    if budget_tokens is None:  # every source is read once at least, also where those bits outgrow the hair
        quota = F.greatest(quota, F.col("n"))
    plan = (q.select("_mix_s", (F.col("q") / F.lit(z)).alias("weight"), quota.alias("quota"), "n")
            .withColumn("full", F.floor(F.col("quota") / F.col("n")).cast("long"))
            .withColumn("rest", F.col("quota") - F.col("full") * F.col("n")))
    plan = cut_lineage(plan, "mix-plan")

    def cut(level: DataFrame, keys: list[str], place: Column, out: str) -> DataFrame:
        """Where the rest ends among the units of each group; ``level`` has keys, unit tokens ``m``, ``rest``, ``full``."""
        w = W.partitionBy(*keys).orderBy("place").rangeBetween(W.unboundedPreceding, W.currentRow)
        run = level.withColumn("place", place).withColumn("upto", F.sum("m").over(w))
        return run.withColumn(out, F.col("place")).drop("place")

    b1 = t.groupBy("_mix_s", "_mix_b1").agg(F.sum("_mix_n").alias("m")).join(plan.filter("rest > 0").select("_mix_s", "full", "rest"), "_mix_s")
    r1 = cut(b1, ["_mix_s"], _md5(seed, F.col("full"), F.col("_mix_s"), F.col("_mix_b1")), "p1")
    edge1 = r1.filter("upto > rest").groupBy("_mix_s").agg(F.min_by(F.struct("_mix_b1", "p1", "full", (F.col("rest") - F.col("upto") + F.col("m")).alias("rest")), "p1").alias("e")).select("_mix_s", "e.*")
    b2 = (t.groupBy("_mix_s", "_mix_b1", "_mix_b2").agg(F.sum("_mix_n").alias("m")).join(edge1, ["_mix_s", "_mix_b1"]))
    r2 = cut(b2, ["_mix_s", "_mix_b1"], _md5(seed, F.col("full"), F.col("_mix_s"), F.col("_mix_b1"), F.col("_mix_b2")), "p2")
    edge2 = r2.filter("upto > rest").groupBy("_mix_s").agg(F.min_by(F.struct("_mix_b1", "_mix_b2", "p1", "p2", "full", (F.col("rest") - F.col("upto") + F.col("m")).alias("rest")), "p2").alias("e")).select("_mix_s", "e.*")
    r3 = cut(t.withColumnRenamed("_mix_n", "m").join(edge2, ["_mix_s", "_mix_b1", "_mix_b2"]), ["_mix_s", "_mix_b1", "_mix_b2"], F.col("_mix_k"), "p3")
    # no document of the edge sub-block fits: its place with an empty key ends the pass before it
    edge3 = r3.groupBy("_mix_s").agg(F.struct(F.first("p1").alias("p1"), F.first("p2").alias("p2"),
                                          F.coalesce(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("p3"))), F.lit("")).alias("p3")).alias("cut"))
    return cut_lineage(plan.join(edge3, "_mix_s", "left").select("_mix_s", "weight", "quota", "full", "cut"), "mix-cuts")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                tokens: Column | None = None, max_repeats: float | None = 2.0, target_entropy: float | None = None,
                budget_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as its source's quota asks, with ``mix_epoch``, ``mix_place``, ``mix_weight``.

    Read by (mix_epoch, mix_place) the rows are the permuted sequence.  The
    default budget reads the largest source once and so drops nothing; the
    smallest is read ``max_repeats`` times.  Null and empty texts have no
    tokens: they go with every pass of their source, and a source without any
    token is kept once.  Null sources are one source.  An empty table gives
    no rows.  Other columns stay as they are, whatever their names; one called
    like a result (``mix_epoch``, ``mix_place``, ``mix_weight``) gives way.
    """
    results = ("mix_epoch", "mix_place", "mix_weight")
    counted = docs.select(*[column(c) for c in docs.columns if c not in results], (word_count(text_col) if tokens is None else tokens).alias("mix_weight"))
    docs = counted.drop("mix_weight")
    plain, _ = apart(counted, id_col, source_col, "mix_weight")
    names = plain.columns[:-1]
    tokens = F.col("mix_weight")
    plan = mix_plan(plain, id_col, source_col, tokens, text_col, max_repeats, target_entropy, budget_tokens, seed).select(
        "_mix_s", F.col("weight").alias("_mix_w"), F.col("full").alias("_mix_full"), F.col("cut").alias("_mix_cut"))
    rows = with_places(plain.drop("mix_weight"), source_col, id_col, seed)
    if plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        j = rows.join(F.broadcast(plan), "_mix_s", "left")
    else:
        salted = plan.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        j = rows.withColumn("_mix_salt", F.pmod(F.xxhash64("_mix_k"), F.lit(SALTS)).cast("int")).join(salted, ["_mix_s", "_mix_salt"], "left").drop("_mix_salt")
    at = lambda e: F.struct(_md5(seed, e, F.col("_mix_s"), F.col("_mix_b1")).alias("p1"), _md5(seed, e, F.col("_mix_s"), F.col("_mix_b1"), F.col("_mix_b2")).alias("p2"), F.col("_mix_k").alias("p3"))
    taken = F.coalesce((at(F.col("_mix_full")) <= F.col("_mix_cut")).cast("long"), F.lit(0))
    copies = F.when(F.col("_mix_full").isNull(), F.lit(1)).otherwise(F.col("_mix_full") + taken)
    out = (j.withColumn("_mix_c", copies.cast("long")).filter("_mix_c > 0")
           .withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_mix_c") - 1))))
    place = at(F.col("mix_epoch"))
    out = out.withColumn("mix_place", F.concat(F.substring(place["p1"], 1, 8), F.substring(place["p2"], 1, 8), F.substring("_mix_k", 1, 16)))
    return together(out, names, docs, "mix_epoch", "mix_place", F.col("_mix_w").alias("mix_weight"))
