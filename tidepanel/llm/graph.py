"""Group minima and connected components that no hot key can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

SALTS = 64
MAX_ROUNDS = 60


def with_group_min(df: DataFrame, key: str, value: str, out: str, salt_of: str) -> DataFrame:
    """``df`` with the smallest ``value`` of the row's ``key`` group (nulls do not count).

    The group's minimum is taken over (key, salt) and then over key, and comes
    back by (key, salt), so a key that holds a third of the rows is spread
    over SALTS tasks all the way.  ``salt_of`` is a column that varies within
    a group.
    """
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(salt_of), F.lit(SALTS)).cast("int"))
    some = rows.groupBy(F.col(key).alias("_k"), "_salt").agg(F.min(value).alias("_lo"))
    least = some.groupBy(F.col("_k").alias("_k2")).agg(F.min("_lo").alias(out))
    look = some.join(least, F.col("_k") == F.col("_k2")).select("_k", F.col("_salt").alias("_s2"), out)
    return (rows.join(look, (F.col(key) == F.col("_k")) & (F.col("_salt") == F.col("_s2")))
            .select(*[F.col(c) for c in df.columns], out))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node that a link (u, v) names.

    Alternates large-star and small-star steps: each node hands its larger
    (then its smaller) neighbours to its least neighbour, until all links of
    a component lead to its least node.  Each round is written to the shared
    folder, so plans stay short and survive lost executors.
    """
    edges = cut_lineage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "cc")
    last = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_group_min(both, "u", "v", "m", "v").select("u", "v", F.least("u", "m").alias("m")).filter("v > u")
        edges = large.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        edges = cut_lineage(edges, "cc")
        small = with_group_min(edges, "u", "v", "m", "v")
        edges = cut_lineage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
                            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "cc")
        # done when every node has one link, to a node that has none upwards, and nothing moved
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
