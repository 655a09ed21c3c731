"""Merkle manifest of a dataset, its proofs acquired by a butterfly exchange.

Rows are leaves, in the order of their id within a group; every FANOUT
consecutive nodes become one, up to the group's root, and the groups' roots
become the dataset's root in the same way.

The leaves of a group are dealt into aligned blocks of FANOUT ** BLOCK_LEVELS
rows.  A block hashes its own subtree in one task.  Then the blocks swap
subtree roots: in round r, block b takes from each of the FANOUT subtrees of
its aligned run the root that the block at b's own place in that subtree holds
(place modulo the subtree's blocks, where the last one is short), and hashes the
parent itself, as all the others do.  After the last round every block knows
all nodes beside its way to the root, so nothing is handed down again.  A round
moves at most FANOUT digests a block, and blocks are one row in some thousand.

Defined results: repeated rows are leaves of their own, side by side; a null
id comes first, a null group is a group of its own and comes first; null
values have their own mark in a leaf; a table without rows has no leaves and
no root.  Columns that are not named play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, ship_package

FANOUT, BLOCK_LEVELS = 8, 4
#: Copies of a short last subtree's roots, at most, for the blocks that all ask there.
COPIES = 64
_STEPS = "array<struct<at: int, run: array<string>>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _name(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its byte count, a colon and its text, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]).cast("binary"), 256)


def _levels(leaves: Sequence[str], fanout: int, height: int | None) -> list[list[str]]:
    """Nodes by level above ``leaves``: ``height`` levels, or as many as it takes to one node."""
    out = [list(leaves)]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([digest("".join(last[k:k + fanout])) for k in range(0, len(last), fanout)])
    return out


def _placed(rows: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """``rows`` (written) with the block ``b`` and place ``i`` of each in its group ``g``, and the group's row count ``n``.

    Sorted over all tasks by sampled ranges; a row's place is its place in the
    partition plus what earlier partitions hold of the group.
    """
    dealt = (rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
             .withColumn("_m", F.monotonically_increasing_id()))
    dealt = cut_lineage(dealt.withColumn("_p", F.shiftright("_m", 33)), "merkle-leaves")
    runs = dealt.groupBy("g", "_p").agg(F.count("*").alias("_c"), F.min("_m").alias("_first"))
    w = Window.partitionBy("g")
    runs = runs.select(F.col("g").alias("_g"), F.col("_p").alias("_q"), "_first", F.sum("_c").over(w).alias("n"),
                       (F.sum("_c").over(w.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_c")).alias("_before"))
    at = F.col("_before") + F.col("_m") - F.col("_first")
    return (dealt.join(runs, (F.col("g") == F.col("_g")) & (F.col("_p") == F.col("_q")))
            .select(*rows.columns, F.expr("n"), F.floor(at / size).alias("b"), (at % size).cast("int").alias("i")))


def _block_roots(placed: DataFrame, fanout: int, height: int) -> DataFrame:
    """(g, b, nb, node): the root of every block's subtree; ``nb`` blocks make the group."""
    size = fanout ** height

    def up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iat[0])
        top = _levels(list(rows.sort_values("i")["leaf"]), fanout, height if n > size else None)[-1]
        return pd.DataFrame({"g": [key[0]], "b": [key[1]], "nb": [-(-n // size)], "node": top})

    return placed.select("g", "b", "i", "n", "leaf").groupBy("g", "b").applyInPandas(up, "g string, b long, nb long, node string")


def butterfly(blocks: DataFrame, fanout: int) -> DataFrame:
    """(g, b, node, steps): every block's root of the group, and the run and its own place in it at each level above the block.

    One round a level; each is written to the shared folder, so that a lost
    executor costs one round at most.
    """
    state = cut_lineage(blocks.withColumn("steps", F.expr(f"cast(array() as {_STEPS})")), "merkle-round")
    width, most = 1, state.agg(F.max("nb")).first()[0] or 0
    while -(-most // width) > 1:
        q = F.floor(F.col("b") / width)
        units = F.ceil(F.col("nb") / width)
        own = F.col("b") % width
        active = state.filter(units > 1)
        # the blocks of subtree s; only a group's last subtree may be short
        first = q - q % fanout
        asks = (active.select("g", "b", "nb", own.alias("own"),
                              F.explode(F.sequence(first, F.least(first + fanout, units) - 1)).alias("s"))
                .withColumn("has", F.least(F.lit(width), F.col("nb") - F.col("s") * width))
                .select("g", "b", "s", (F.col("s") * width + F.col("own") % F.col("has")).alias("p"),
                        (F.floor(F.col("own") / F.col("has")) % COPIES).alias("copy")))
        has = F.least(F.lit(width), F.col("nb") - q * width)
        gives = active.select(F.col("g").alias("_g"), F.col("b").alias("_b"), F.col("node").alias("_node"),
                              F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.ceil(F.lit(width) / has), F.lit(COPIES)) - 1)).alias("_copy"))
        got = (asks.join(gives, (F.col("g") == F.col("_g")) & (F.col("p") == F.col("_b")) & (F.col("copy") == F.col("_copy")))
               .groupBy(F.col("g").alias("_g"), F.col("b").alias("_b"))
               .agg(F.expr("transform(sort_array(collect_list(struct(s, _node))), x -> x._node)").alias("run")))
        step = F.struct((q % fanout).cast("int").alias("at"), "run")
        state = state.join(got, (F.col("g") == F.col("_g")) & (F.col("b") == F.col("_b")), "left").select(
            "g", "b", "nb", F.coalesce(F.sha2(F.array_join("run", "").cast("binary"), 256), "node").alias("node"),
            F.when(F.col("run").isNull(), F.col("steps")).otherwise(F.concat("steps", F.array(step))).alias("steps"))
        state = cut_lineage(state, "merkle-round")
        width *= fanout
    return state.select("g", "b", "node", "steps")


def _fold(leaf: str, steps: Iterator[tuple[int, Sequence[str]]]) -> str:
    for at, run in steps:
        leaf = digest("".join([*run[:at], leaf, *run[at + 1:]]))
    return leaf


def _beside(steps: Sequence[tuple[int, Sequence[str]]]) -> str:
    return "".join("".join([*run[:at], *run[at + 1:]]) for at, run in steps)


@dataclass
class Manifest:
    """A dataset's leaves by block, and each block's root and steps to it, as written tables.

    ``leaves``: the rows' key columns, ``g``, ``b``, ``i``, ``leaf``; ``blocks``: ``g``, ``b``,
    ``subroot``, ``root``, ``steps`` (levels above the block, up to the root of all).
    """
    leaves: DataFrame
    blocks: DataFrame
    fanout: int
    height: int

    def root(self) -> str | None:
        row = self.blocks.select("root").first()
        return row[0] if row else None

    def _by_block(self, rows: DataFrame, work, schema: str) -> DataFrame:
        """``work(leaves of the block, steps of leaf i, block row)`` for every block."""
        fanout, height = self.fanout, self.height

        def run(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
            rows, top = rows.sort_values("i", ignore_index=True), block.iloc[0]
            upper = [(s["at"], list(s["run"])) for s in top["steps"]]
            whole = _levels(list(rows["leaf"]), fanout, height if int(rows["n"].iat[0]) > fanout ** height else None)

            def below(i: int) -> list[tuple[int, list[str]]]:
                out = []
                for level in whole[:-1]:
                    out.append((i % fanout, level[i - i % fanout:i - i % fanout + fanout]))
                    i //= fanout
                return out
            return work(rows, below, upper, top)

        return (rows.groupBy("g", "b").cogroup(self.blocks.groupBy("g", "b"))
                .applyInPandas(run, schema))

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """(id, leaf, subroot, root, steps) of every leaf, or of those whose id is in ``wanted``: at each level
        the run that the way to the root passes, and the place in it."""
        marked = self.leaves.withColumn("_take", F.lit(True))
        if wanted is not None:
            ids = wanted.select(F.col("id").alias("_id")).distinct().withColumn("_hit", F.lit(True))
            marked = (self.leaves.join(ids, F.col("id").eqNullSafe(F.col("_id")), "left")
                      .withColumn("_take", F.col("_hit").isNotNull()).drop("_id", "_hit"))

        def work(rows, below, upper, top):
            at = [k for k, take in enumerate(rows["_take"]) if take]
            steps = [[{"at": p, "run": run} for p, run in [*below(k), *upper]] for k in at]
            return pd.DataFrame({"id": rows["id"].iloc[at].to_numpy(), "leaf": rows["leaf"].iloc[at].to_numpy(),
                                 "subroot": top["subroot"], "root": top["root"], "steps": pd.Series(steps, dtype=object)})

        kind = self.leaves.schema["id"].dataType.simpleString()
        return self._by_block(marked, work, f"id {kind}, leaf string, subroot string, root string, steps {_STEPS}")

    def check(self) -> DataFrame:
        """Each leaf with its proof's digest, the root folded from ``seen`` (what the row's digest is now; null: the
        leaf) and the nodes beside its way, and whether that is the root."""
        def work(rows, below, upper, top):
            shared, proof, folded = _beside(upper), [], []
            for k, (leaf, seen) in enumerate(zip(rows["leaf"], rows["seen"], strict=True)):
                low = below(k)
                proof.append(digest(_beside(low) + shared))
                folded.append(_fold(_fold(seen or leaf, low), upper))
            return pd.DataFrame({"id": rows["id"], "leaf": rows["leaf"], "subroot": top["subroot"], "root": top["root"],
                                 "proof_sha256": proof, "folded_root": folded, "verified": [f == top["root"] for f in folded]})

        kind = self.leaves.schema["id"].dataType.simpleString()
        return self._by_block(self.leaves, work, f"id {kind}, leaf string, subroot string, root string, "
                                                 "proof_sha256 string, folded_root string, verified boolean")


def _tree(rows: DataFrame, order: Sequence[str], fanout: int, height: int) -> tuple[DataFrame, DataFrame]:
    """Leaves in their blocks, and blocks with their group's root and the steps to it; both written."""
    placed = cut_lineage(_placed(rows, order, fanout ** height), "merkle-placed")
    return placed, butterfly(_block_roots(placed, fanout, height), fanout)


def build_manifest(rows: DataFrame, id_col: str, group_col: str, columns: Sequence[str], seen: Sequence[Column] | None = None,
                   fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """Manifest of ``rows``: leaves over ``columns``, by ``group_col`` in the order of ``id_col`` (an integer).

    ``seen``: what those columns are found to be at checking, as columns over ``rows``
    (null as a whole where nothing changed), for ``Manifest.check``.
    """
    spark = rows.sparkSession
    ship_package(spark)
    leaf = leaf_digest([_name(c) for c in columns])
    found = F.lit(None).cast("string") if seen is None else leaf_digest(seen)
    group = F.coalesce(F.concat(F.lit("="), _name(group_col).cast("string")), F.lit(""))  # null before all others
    table = cut_lineage(rows.select(_name(id_col).alias("id"), group.alias("g"), leaf.alias("leaf"), found.alias("seen")), "merkle-rows")
    placed, blocks = _tree(table, ["id", "leaf"], fanout, block_levels)
    tops = blocks.filter("b = 0").select(F.lit("").alias("g"), F.col("g").alias("id"), F.col("node").alias("leaf"))
    over = Manifest(*_tree(tops, ["id"], fanout, block_levels), fanout, block_levels)
    over.blocks = over.blocks.select("g", "b", F.col("node").alias("subroot"), F.col("node").alias("root"), "steps")
    ways = over.proofs().select(F.col("id").alias("_g"), "root", F.col("steps").alias("_more"))
    blocks = blocks.join(ways, F.col("g") == F.col("_g")).select(
        "g", "b", F.col("node").alias("subroot"), "root", F.concat("steps", "_more").alias("steps"))
    return Manifest(placed, cut_lineage(blocks, "merkle-blocks"), fanout, block_levels)


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def tamper_report(docs: DataFrame) -> DataFrame:
    """Manifest of documents, checked against a copy in which every third text (by crc32 of its id) is lower-cased.

    A null id is never tampered with.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    seen = [*[F.col(c) for c in COLUMNS[:-1]], F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))]
    manifest = build_manifest(docs, "doc_id", "lang", COLUMNS, seen)
    return manifest.check().withColumnRenamed("id", "doc_id")
