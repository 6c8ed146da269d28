"""Merkle manifest of a dataset: a tree of SHA-256 digests per group of rows, and one over the groups.

Each row is a leaf.  The leaves of a group, in key order, are dealt to aligned
blocks of ``FANOUT ** DEPTH`` nodes; a block keeps each of its levels as one
string of concatenated hex digests.  A parent is the hash of a fixed-width
substring (``FANOUT`` digests; the last may be shorter), so a level is made from
the one below by substrings alone, and the siblings of a node are the two
substrings that flank it.  The roots of the blocks are the nodes of the next
round, until a group has one block left.  Its root is the group's subroot, and
the subroots, in group order, are built in the same way into the root.

Proofs are made downwards: a block's own proof is made once in the block above
and goes in front of nothing but the block's rows, so no node above a block is
joined to single rows.  Ranks come from a range partitioning of narrow rows
(keys and digests, no texts) and per-partition counts, and a block holds at
most 512 rows, so neither a large group nor a repeated key gathers in one task.

Defined cases: a null value is ``-``.  Rows of a group ascend by key (null
first), then by digest; repeated rows are leaves of their own, and since they
are equal, which of them comes first changes no result.  The group null is a group,
ordered first.  A group of one row has that leaf as subroot, and a single group's
subroot is the root.  An empty table gives an empty result.  Texts are hashed whole, once.
Columns that aren't named are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_crc_mod, materialise

FANOUT = 8
DEPTH = 3
BLOCK = FANOUT ** DEPTH
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PATH = "array<struct<before:string,after:string>>"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and its text, or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _parents(level: str) -> str:
    """SQL for the next level's string: one digest for each run of FANOUT nodes."""
    wide = FANOUT * HEX
    return (f"array_join(transform(sequence(0, CAST((length({level}) - 1) DIV {wide} AS INT)), "
            f"r -> sha2(substring({level}, r * {wide} + 1, {wide}), 256)), '')")


def _runs(level: str) -> str:
    """SQL for the substrings of a level that have a common parent."""
    wide = FANOUT * HEX
    return (f"transform(sequence(0, CAST((length({level}) - 1) DIV {wide} AS INT)), "
            f"r -> substring({level}, r * {wide} + 1, {wide}))")


def _flanks(p: str) -> str:
    """SQL for the siblings of node p (of the block's lowest level) at each level that has a parent."""
    steps = []
    for k in range(DEPTH):
        at = f"({p} DIV {FANOUT ** k})"
        run, place = f"element_at(runs{k}, CAST({at} DIV {FANOUT} AS INT) + 1)", f"CAST({at} % {FANOUT} AS INT)"
        steps.append(f"CASE WHEN height > {k} THEN struct(left({run}, {place} * {HEX}) AS before, "
                     f"substring({run}, {place} * {HEX} + {HEX + 1}) AS after) END")
    return f"filter(array({', '.join(steps)}), x -> x IS NOT NULL)"


def ranked(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, the rank from 0 within ``tree`` by ``order``, and ``nodes``, the tree's count.

    Rows are range-partitioned and written once in order; a row's number within its task, less the
    task's first of that tree, plus the tree's rows in earlier tasks, is its rank.
    """
    keys = ["tree", *order]
    spread = nodes.withColumn("_tie", F.rand(11))  # equal rows may lie on either side of a border
    dealt = materialise(spread.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys).drop("_tie")
                        .withColumn("_at", F.monotonically_increasing_id())
                        .withColumn("_part", F.shiftright("_at", 33)), "manifest-ranked")
    held = dealt.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = (held.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .withColumn("nodes", F.sum("_n").over(Window.partitionBy("tree")))
            .select(F.col("tree").alias("_tree"), F.col("_part").alias("_p"), "_first", "_before", "nodes"))
    return (dealt.join(held, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_part") == F.col("_p")))
            .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_tree", "_p", "_first", "_before", "_at", "_part"))


def blocks(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """tree, block, nodes, height, level0..level{DEPTH}, root and the columns to carry as arrays in node order.

    nodes: tree, pos, nodes, digest.  ``height`` is the number of levels above the lowest: DEPTH, or
    in a tree of one block as many as leave one node.
    """
    packed = (nodes.withColumn("block", F.expr(f"pos DIV {BLOCK}"))
              .groupBy("tree", "block", "nodes")
              .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", *carry))).alias("held"))
              .withColumn("height", F.expr("CASE " + " ".join(f"WHEN nodes <= {FANOUT ** k} THEN {k}" for k in range(DEPTH))
                                           + f" ELSE {DEPTH} END"))
              .withColumn("level0", F.expr("array_join(held.digest, '')")))
    for k in range(DEPTH):
        packed = packed.withColumn(f"level{k + 1}", F.expr(f"CASE WHEN height > {k} THEN {_parents(f'level{k}')} END"))
    return packed.withColumn("root", F.expr("CASE height " + " ".join(f"WHEN {k} THEN level{k}" for k in range(DEPTH))
                                            + f" ELSE level{DEPTH} END")).drop(f"level{DEPTH}")


def _descend(held: DataFrame, carry: Sequence[str], heads: Sequence[str]) -> DataFrame:
    """One row a node of blocks that have their own ``path``: tree, heads, pos, digest, carried columns, path to the root."""
    # the strings are cut here, once a block, not once a node
    opened = held.select("*", *[F.expr(f"CASE WHEN height > {k} THEN {_runs(f'level{k}')} END").alias(f"runs{k}")
                                for k in range(DEPTH)])
    return opened.selectExpr(
        "tree", *heads, "inline(transform(held, (x, p) -> struct(x.pos AS pos, x.digest AS digest, "
        + "".join(f"x.{c} AS {c}, " for c in carry) + f"concat({_flanks('p')}, path) AS path)))")


@dataclass
class Tree:
    """The written rounds of blocks of all trees of a forest, lowest first, and their roots (tree, root)."""

    rounds: list[DataFrame]
    carry: tuple[str, ...]
    roots: DataFrame


def build(nodes: DataFrame, carry: Sequence[str] = (), name: str = "manifest") -> Tree:
    """Blocks of every round over ranked nodes (tree, pos, nodes, digest); a round is DEPTH levels."""
    rounds, wanted = [], tuple(carry)
    while True:
        rounds.append(materialise(blocks(nodes, wanted), f"{name}-blocks"))
        wanted = ()
        above = rounds[-1].filter(f"nodes > {BLOCK}")
        if above.isEmpty():
            break
        nodes = above.selectExpr("tree", "block AS pos", f"(nodes - 1) DIV {BLOCK} + 1 AS nodes", "root AS digest")
    roots = None
    for r in rounds:
        done = r.filter(f"nodes <= {BLOCK}").select("tree", "root")
        roots = done if roots is None else roots.unionByName(done)
    return Tree(rounds, tuple(carry), roots)


def proofs(tree: Tree, tops: DataFrame | None = None) -> DataFrame:
    """tree, pos, digest, carried columns, path: the siblings before and after each node, lowest level first.

    tops: tree, path and more - what follows above a tree's own root; the further columns come down with it.
    """
    heads = [c for c in tops.columns if c not in ("tree", "path")] if tops is not None else []
    above = None
    for r, held in reversed([(i, h.drop("root")) for i, h in enumerate(tree.rounds)]):
        last = held.filter(f"nodes <= {BLOCK}")
        if tops is None:
            last = last.withColumn("path", F.expr(f"CAST(array() AS {PATH})"))
        else:
            last = (last.join(tops.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree")))
                    .drop("_tree"))
        if above is not None:
            over = above.select(F.col("tree").alias("_tree"), F.col("pos").alias("_block"), "path", *heads)
            last = last.unionByName(
                held.filter(f"nodes > {BLOCK}")
                .join(over, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block")))
                .drop("_tree", "_block"))
        above = _descend(last, tree.carry if r == 0 else (), heads)
    return above


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS,
             other: Column | None = None) -> DataFrame:
    """key, group, pos, leaf, other, subroot, root and path (siblings before and after, leaf level first) of every row.

    other: a second digest to carry along each leaf, null where it equals the leaf.
    """
    mine = leaf([F.col(c) for c in fields])
    rows = materialise(docs.select(F.col(group).alias("tree"), F.col(key).alias("key"), mine.alias("digest"),
                                   (F.lit(None).cast("string") if other is None else other).alias("other")), "manifest-leaves")
    trees = build(ranked(rows, ["key", "digest"]), ("key", "other"))
    # the subroots are the nodes of one tree above, in the order of the groups
    subs = materialise(trees.roots.select(F.lit(0).alias("tree"), F.col("tree").alias("grp"), F.col("root").alias("digest")),
                       "manifest-subroots")
    top = build(ranked(subs, ["grp"]), ("grp",), "manifest-top")
    heads = materialise(proofs(top).join(top.roots, "tree").select(
        F.col("grp").alias("tree"), F.col("digest").alias("subroot"), "root", "path"), "manifest-heads")
    return proofs(trees, heads).select(F.col("key").alias(key), F.col("tree").alias(group), "pos",
                                       F.col("digest").alias("leaf"), "other", "subroot", "root", "path")


def fold(start: str, path: str) -> Column:
    """The root that a leaf gives with its siblings: the leaf is hashed between them, level by level."""
    return F.expr(f"aggregate({path}, {start}, (h, s) -> sha2(concat(s.before, h, s.after), 256))")


def siblings_digest(path: str) -> Column:
    return F.expr(f"sha2(array_join(transform({path}, s -> concat(s.before, s.after)), ''), 256)")


def audit(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: every row's proof, tried on tampered rows.

    Where 3 divides the crc32 of the id, the row is tampered with: A-Z of its text are lower-cased.
    """
    text = F.when(id_crc_mod(F.col("doc_id"), 3) == 0, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    tampered = leaf([text if c == "text" else F.col(c) for c in FIELDS])
    other = F.when((id_crc_mod(F.col("doc_id"), 3) == 0) & F.col("text").rlike("[A-Z]"), tampered)
    return (manifest(docs, other=other).withColumn("tried", F.coalesce("other", "leaf"))
            .select("doc_id", "leaf", "subroot", "root", siblings_digest("path").alias("proof_sha256"),
                    fold("tried", "path").alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
