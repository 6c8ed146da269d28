"""Document fingerprints as Merkle trees (DataFrame functions only).

Leaves are clauses (cut after a punctuation mark and a blank), paragraphs are
lines, and sections are runs of paragraphs that end after a blank line or a
paragraph whose hash is a multiple of eight, so an edit moves no later border.
Each node hashes its children's hashes; the root is a SHA-256.  Equal roots mean
equal texts.  Where roots differ, ``edits`` walks down and names the differing
sections and paragraphs.  The likeness of two trees is Dice's coefficient of
their distinct leaves, which the fingerprint holds as its last part
(``likeness_of`` computes it from two fingerprints).

The next document is found without a global sort in one task: the keys (narrow)
are range-partitioned by Spark, the first key of every range becomes a border
(at most ``MOST_RANGES``), and each range also gets a copy of the row that
opens the next one.  One shuffle of the texts by range then serves a window.

Defined cases: a null text is empty.  Rows are ordered by doc_id (null first),
then by a hash of the text, then the text, so repeated ids have a fixed order
and repeated rows equal answers up to that order.  The row after the last is
the first; a single row follows itself.  Two empty texts are alike (1).  An
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 1000
MOST_RANGES = 65_536
CLAUSE = r"(?<=[.!?,;:|]) "


def tree(text: str) -> str:
    """SQL for the tree of a text column: leaves by paragraph."""
    return f"transform(split({text}, '\\n'), p -> transform(split(p, '{CLAUSE}'), s -> xxhash64(s)))"


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds <name>_paragraphs, _sections, _root and _leaves for a column of texts."""
    p, s = f"{name}_paragraphs", f"{name}_sections"
    return (df.withColumn(f"{name}_tree", F.expr(tree(text)))
            .withColumn(p, F.expr(f"transform({name}_tree, x -> xxhash64(x))"))
            .withColumn(f"{name}_ends", F.expr(
                f"filter(sequence(1, size({p})), i -> i = size({p}) OR pmod(get({p}, i - 1), 8L) = 0 "
                f"OR get({name}_tree, i - 1) = array(xxhash64('')))"))
            .withColumn(s, F.expr(
                f"transform({name}_ends, (e, j) -> xxhash64(slice({p}, coalesce(get({name}_ends, j - 1), 0) + 1, "
                f"e - coalesce(get({name}_ends, j - 1), 0))))"))
            .withColumn(f"{name}_root", F.expr(f"sha2(array_join(transform({s}, x -> hex(x)), '.'), 256)"))
            .withColumn(f"{name}_leaves", F.expr(f"array_distinct(flatten({name}_tree))"))
            .drop(f"{name}_tree", f"{name}_ends"))


def fingerprint(name: str) -> Column:
    """The tree as text: root, sections, paragraphs, distinct leaves (parts by colons, hashes by dots)."""
    parts = ", ".join(f"array_join(transform({name}_{x}, x -> hex(x)), '.')" for x in ("sections", "paragraphs", "leaves"))
    return F.expr(f"concat_ws(':', {name}_root, {parts})")


def likeness_of(a: str, b: str) -> Column:
    """The likeness of two columns of fingerprints."""
    return likeness(f"split(split_part({a}, ':', 4), '[.]')", f"split(split_part({b}, ':', 4), '[.]')")


def likeness(a: str, b: str) -> Column:
    """Dice's coefficient of two arrays of distinct leaves."""
    return F.expr(f"2D * size(array_intersect({a}, {b})) / (size({a}) + size({b}))")


def edits(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Adds same (roots equal), sections and paragraphs (numbers, from 0) of column a that b doesn't hold."""
    lost = "filter(transform({0}, (x, i) -> CASE WHEN NOT array_contains({1}, x) THEN i END), i -> i IS NOT NULL)"
    both = with_tree(with_tree(pairs, a, "_a"), b, "_b").withColumn("same", F.col("_a_root") == F.col("_b_root"))
    for level in ("sections", "paragraphs"):
        both = both.withColumn(f"changed_{level}", F.expr(
            f"CASE WHEN same THEN CAST(array() AS ARRAY<INT>) ELSE {lost.format(f'_a_{level}', f'_b_{level}')} END"))
    return both.drop(*[f"_{x}_{y}" for x in "ab" for y in ("sections", "paragraphs", "root", "leaves")])


def _key(doc_id: Column, h: Column) -> Column:
    """One number that orders rows as (doc_id, null first, then the hash of the text), up to 40 bits of the hash."""
    wide = F.coalesce(doc_id.cast("decimal(20,0)"), F.lit("-9223372036854775809").cast("decimal(20,0)"))
    return (wide * F.lit(1 << 40).cast("decimal(13,0)") + F.shiftright(h, 24).cast("decimal(20,0)")).cast("decimal(38,0)")


def _ranges(keyed: DataFrame) -> tuple[list[str], int]:
    """The first key of every range, in order: as many as MOST_RANGES."""
    n = max(1, min(MOST_RANGES, keyed.count() // ROWS_PER_RANGE))
    firsts = (keyed.repartitionByRange(n, "key").groupBy(F.spark_partition_id().alias("p"))
              .agg(F.min("key").alias("first")).collect())
    found = sorted({r["first"] for r in firsts})
    return [f"{x:f}" for x in found], len(found)


def with_next(docs: DataFrame, name: str = "own") -> DataFrame:
    """doc_id, text and tree columns of every row, next_text and next_leaves."""
    base = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text")).withColumn("key", _key(F.col("doc_id"), F.col("h"))))
    firsts, n = _ranges(base.select("key"))
    step = 256
    borders = lambda xs: f"CAST(split('{','.join(xs)}', ',') AS ARRAY<DECIMAL(38,0)>)" if xs else "CAST(array() AS ARRAY<DECIMAL(38,0)>)"
    # the range of a key: the borders at or below it, searched in two steps
    placed = (base.withColumn("block", F.expr(f"size(filter({borders(firsts[::step])}, b -> b <= key)) - 1"))
              .withColumn("range", F.expr(f"block * {step} + size(filter(slice({borders(firsts)}, "
                                          f"block * {step} + 1, {step}), b -> b <= key))"))
              .withColumn("opens", F.expr(f"get({borders(firsts)}, range - 1) = key")))
    own = F.struct(F.col("range"), F.lit(0).alias("late"))
    copy = F.struct(F.when(F.col("range") == 1, F.lit(n)).otherwise(F.col("range") - 1).alias("range"),
                    F.lit(1).alias("late"))
    dealt = (placed.select("doc_id", "text", "h",
                           F.explode(F.when(F.col("opens"), F.array(own, copy)).otherwise(F.array(own))).alias("at"))
             .select("doc_id", "text", "h", "at.range", "at.late")
             .repartition("range"))
    w = Window.partitionBy("range").orderBy("late", "doc_id", "h", "text")
    return (with_tree(dealt, "text", name)
            .withColumn("next_text", F.lead("text").over(w))
            .withColumn("next_leaves", F.lead(f"{name}_leaves").over(w))
            .filter("late = 0"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    edited = (with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
              .withColumn("half", F.expr("CAST(n_chars DIV 2 AS INT)"))
              .withColumn("edited", F.expr("concat(left(text, CAST(n_chars - half AS INT)), left(next_text, half))")))
    return with_tree(edited, "edited", "other").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("own").alias("fingerprint"), fingerprint("other").alias("edited_fingerprint"),
        likeness("own_leaves", "other_leaves").alias("near_edited"),
        likeness("own_leaves", "next_leaves").alias("near_next"))
