"""Merkle manifest of a table: one tree a group, one over the groups, checkpoint and recompute.

Rows become leaves (a digest each). A group's leaves stand in order; eight
consecutive nodes become one, until one is left, the group's root. The roots
of all groups, in order of the group, make a tree of the same kind.

Of each tree only every third level is stored (``LEVELS``), as a written
table. A stored node covers an aligned block of up to 512 nodes of the stored
level below. Building folds each block in one task call. Proofs go down from
the top: each block is folded again from its stored nodes, the siblings of
every node on the way to the block's top are handed out in front of the proof
of that top, and the levels in between are dropped. So the disk holds a little
over one digest a row, a proof costs no read of the levels above, and what a
call holds is bounded by a block, however large a group is.

Positions in a group come without a window over it: rows are dealt by range of
(group, order), sorted within partitions, and numbered from the counts of
(partition, group). A group with a third of all rows, or all of them, lies in
as many partitions as its size asks for; so do many groups.

Shuffles: one by range of digests, orders and the columns kept, then one a
stored level. The texts are read once and never shuffled. Stored levels lie in
the shared checkpoint folder, so a lost executor costs the blocks of one level.

Defined results: a null group is a group of its own, before all others; null
order values come first; rows alike in order are ordered by their digest, so
repeated rows change nothing but the count; an empty table has no groups and
the digest of nothing as root. Columns of the input are passed through, but
those named ``subroot``, ``root`` and ``steps`` are replaced.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
ROWS_PER_PART = 200_000
STEPS = "array<struct<at:int,siblings:string>>"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


EMPTY = sha("")


def field(value: Column) -> Column:
    """A value as text that tells where it ends: ``-`` for null, else its UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""

    def up(node: Column, step: Column) -> Column:
        cut = step["at"] * 64
        left, right = F.substr(step["siblings"], F.lit(1), cut), F.substr(step["siblings"], cut + 1)
        return F.sha2(F.concat(left, node, right), 256)

    return F.aggregate(steps, leaf, up)


def proof_text(steps: Column) -> Column:
    """All siblings of a proof, from the leaf up."""
    return F.array_join(F.transform(steps, lambda s: s["siblings"]), "")


def _block_levels(nodes: list[str], n_level: int) -> list[list[str]]:
    """A block's nodes, level by level; ``n_level``: nodes of the whole tree on the lowest of these."""
    levels = [nodes]
    while len(levels) <= LEVELS and n_level > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        n_level = -(-n_level // FAN)
    return levels


def _above(n: Column) -> Column:
    for _ in range(LEVELS):
        n = F.ceil(n / FAN)
    return n.cast("long")


def _fold_block(nodes: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    n = nodes.column("n")[0].as_py()
    top = _block_levels(nodes.column("digest").to_pylist(), n)[-1]
    for _ in range(LEVELS):
        n = -(-n // FAN)
    return pa.table({"tree": [nodes.column("tree")[0].as_py()], "pos": [nodes.column("pos")[0].as_py() // BLOCK], "n": [n], "digest": top})


def _prove_block(nodes: pa.Table, above: pa.Table) -> pa.Table:
    """The nodes with their proofs: siblings within the block, then the proof of the block's top."""
    nodes = nodes.sort_by("pos")
    levels = _block_levels(nodes.column("digest").to_pylist(), nodes.column("n")[0].as_py())
    top = above.column("steps")[0].as_py()
    tail = [(s["at"], s["siblings"]) for s in top]
    places: list[int] = []
    siblings: list[str] = []
    for i in range(nodes.num_rows):
        at = i
        for level in levels[:-1]:
            run = at - at % FAN
            places.append(at % FAN)
            siblings.append("".join(level[run:at] + level[at + 1 : run + FAN]))
            at //= FAN
        for place, text in tail:
            places.append(place)
            siblings.append(text)
    each = len(levels) - 1 + len(tail)
    steps = pa.ListArray.from_arrays(
        pa.array(range(0, each * nodes.num_rows + 1, each) if each else [0] * (nodes.num_rows + 1), pa.int32()),
        pa.StructArray.from_arrays([pa.array(places, pa.int32()), pa.array(siblings, pa.string())], ["at", "siblings"]),
    )
    subroot = pa.array([above.column("subroot")[0].as_py()] * nodes.num_rows, pa.string())
    return nodes.drop_columns(["n", "block"]).append_column("subroot", subroot).append_column("steps", steps)


def ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` in its tree and ``n``, the rows of the tree, as a written table."""
    by = ["tree", *order, "digest"]
    parts = max(8, -(-rows.count() // ROWS_PER_PART))
    laid = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    laid = staged(laid.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), f"{name}-laid")
    held = laid.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("k"))
    tree = Window.partitionBy("tree")  # a row a partition: bounded by their number
    held = held.select(
        "tree", "part", F.sum("k").over(tree).alias("n"),
        (F.sum("k").over(tree.orderBy("part")) - F.col("k") - F.col("first")).alias("shift"),
    )
    placed = laid.join(held, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
    return staged(placed.drop("part", "at", "shift"), f"{name}-0")


def stored_levels(level: DataFrame, name: str) -> list[DataFrame]:
    """Every third level of all trees, from the leaves to one row a tree."""
    levels = [level]
    left = level.agg(F.max("n")).first()[0] or 1
    while left > 1:
        blocks = levels[-1].select("tree", "pos", "n", "digest").groupBy("tree", F.expr(f"pos div {BLOCK}"))
        levels.append(staged(blocks.applyInArrow(_fold_block, "tree string, pos long, n long, digest string"), f"{name}-{len(levels) * LEVELS}"))
        for _ in range(LEVELS):
            left = -(-left // FAN)
    return levels


def proved(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """Level 0 with ``subroot`` and ``steps``; ``top`` has them for each tree's root."""
    above = top.select("tree", F.lit(0).cast("long").alias("pos"), "subroot", "steps")
    for level in reversed(levels[:-1]):
        kept = [f for f in level.schema.fields if f.name != "n"]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", subroot string, steps {STEPS}"
        nodes = level.select(*[f.name for f in kept], "n", F.expr(f"pos div {BLOCK}").alias("block"))
        above = nodes.groupBy("tree", "block").cogroup(above.groupBy("tree", "pos")).applyInArrow(_prove_block, schema)
    if len(levels) == 1:
        above = levels[0].join(above.select("tree", "subroot", "steps"), "tree")
    return above


@dataclass
class Manifest:
    """The stored levels of the groups' trees and of the tree over them, and the root of all."""

    levels: list[DataFrame]
    top_levels: list[DataFrame]
    root: str
    names: dict[str, str]

    def subroots(self) -> DataFrame:
        """Group (null: the null group), number of rows, and the group's root."""
        sizes = self.levels[0].groupBy("tree").agg(F.count("*").alias("n_rows"))
        group = F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))
        return self.levels[-1].join(sizes, "tree").select(group.alias("group"), "n_rows", F.col("digest").alias("subroot"))

    def proofs(self) -> DataFrame:
        """The input's rows with ``subroot``, ``root`` and ``steps``: each level's place in its run and the run's others."""
        none = F.array().cast(STEPS)
        top = self.top_levels[-1].select("tree", F.lit("").alias("subroot"), none.alias("steps"))
        groups = proved(self.top_levels, top).select(F.col("member").alias("tree"), F.col("digest").alias("subroot"), "steps")
        rows = proved(self.levels, groups)
        kept = [F.col(new).alias(old) for old, new in self.names.items() if old not in ("subroot", "root", "steps")]
        return rows.select(*kept, "subroot", F.lit(self.root).alias("root"), "steps")


def merkle_manifest(rows: DataFrame, digest_col: str, group_col: str, order_cols: list[str], name: str = "merkle") -> Manifest:
    """Build and store the manifest of ``rows``, whose leaves are in ``digest_col``."""
    names = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    leaves = staged(rows.select(
        *[F.col(f"`{old}`").alias(new) for old, new in names.items()], tree.alias("tree"), F.col(f"`{digest_col}`").alias("digest"),
    ), f"{name}-leaves")
    levels = stored_levels(ranked(leaves, [names[c] for c in order_cols], name), name)
    groups = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    top_levels = stored_levels(ranked(groups, ["member"], f"{name}-top"), f"{name}-top")
    root = top_levels[-1].select("digest").first()
    return Manifest(levels, top_levels, root[0] if root else EMPTY, names)
