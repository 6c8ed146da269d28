"""Sharding by extendible hashing.

Rows are addressed by the bits of a hash of (doc_id, text).  Shards are the
buckets of a directory: one bucket at first, and only a bucket over the byte
limit is split on one more bit of the prefix, until all fit.  Instead of one
pass per bit, a pass counts the bytes of fine cells (a prefix of ``LEVELS``
more bits) and sums them for every shorter prefix; the shard of a cell is its
shortest prefix that fits.  Cells that don't fit go into the next pass.

A row over the limit is a shard of its own.  Rows equal in doc_id and text share
all 64 bits; a bucket of them that never fits gets overflow pages, numbered
from counts by partition, so that no group meets in one task.

Defined cases: null text is empty (0 bytes), null ids hash like any value.  An
empty table has no shards.  Extra columns are kept out of the result.  Nothing
depends on row order; which of several equal rows gets which page doesn't matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

LIMIT = 4 << 20
LEVELS = 12
BITS = 60


def addresses(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the address: BITS bits of a hash."""
    return docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                       F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 64 - BITS).alias("address"))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """The leaves of the directory: depth, prefix, bytes, rows.  Buckets don't overlap and cover all addresses used."""
    spark = rows.sparkSession
    leaves, open_cells, depth = None, rows.select("address", "n_bytes"), 0
    while depth < BITS:
        top = min(BITS, depth + LEVELS)
        cells = (open_cells.groupBy(F.expr(f"shiftrightunsigned(address, {BITS - top})").alias("cell"))
                 .agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")))
        cells = materialise(cells, "cells")
        # the bytes of every prefix of every cell; the empty prefix is counted in the first pass only
        prefixes = (cells.withColumn("depth", F.explode(F.sequence(F.lit(depth + (depth > 0)), F.lit(top))))
                    .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {top} - depth)"))
                    .groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")))
        prefixes = materialise(prefixes, "prefixes")
        over = prefixes.filter(F.col("bytes") > limit)
        # a leaf fits and its parent doesn't
        parents = over.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("above"))
        found = prefixes.filter(F.col("bytes") <= limit).withColumn("above", F.expr("shiftrightunsigned(prefix, 1)"))
        below = found.join(parents, ["depth", "above"], "left_semi").drop("above")
        if depth == 0:
            below = below.unionByName(prefixes.filter((F.col("depth") == 0) & (F.col("bytes") <= limit)))
        else:  # the parent of the first bit of this pass was over the limit in the last one
            below = below.unionByName(prefixes.filter((F.col("depth") == depth + 1) & (F.col("bytes") <= limit)))
        leaves = below if leaves is None else leaves.unionByName(below)
        full = over.filter(F.col("depth") == top).select("depth", "prefix", "bytes", "rows")
        if full.isEmpty():
            return leaves
        if top == BITS:
            return leaves.unionByName(full)
        open_cells = open_cells.join(full.select(F.col("prefix").alias("p")),
                                     F.expr(f"shiftrightunsigned(address, {BITS - top}) = p"), "left_semi")
        depth = top
    return leaves if leaves is not None else spark.createDataFrame([], "depth int, prefix long, bytes long, rows long")


def shard(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, shard_id, depth, page, shard_bytes: the shard of every row.

    shard_id is the bucket's prefix in binary, ``big-...`` for a row over the limit; with page it names the shard.
    """
    rows = materialise(addresses(docs), "addresses")
    big, small = rows.filter(F.col("n_bytes") > limit), rows.filter(F.col("n_bytes") <= limit)
    leaves = materialise(directory(small, limit), "directory")
    depths = [r["depth"] for r in leaves.select("depth").distinct().collect()]  # at most BITS + 1
    if not depths:
        small = small.withColumns({"depth": F.lit(0), "shard_id": F.lit(""), "shard_bytes": F.lit(0).cast("long"),
                                   "page": F.lit(0).cast("long")})
    else:
        # each address meets exactly one leaf: its prefix at one of the depths in use
        probe = (small.withColumn("depth", F.explode(F.array(*map(F.lit, sorted(depths)))))
                 .withColumn("prefix", F.expr(f"shiftrightunsigned(address, {BITS} - depth)")))
        small = (probe.join(leaves.withColumnRenamed("bytes", "shard_bytes"), ["depth", "prefix"])
                 .withColumn("shard_id", F.expr("right(lpad(conv(CAST(prefix AS STRING), 10, 2), 64, '0'), depth)")))
        small = _pages(small, limit)
    columns = ["doc_id", "n_bytes", "shard_id", "depth", "page", "shard_bytes"]
    big = big.select("doc_id", "n_bytes", F.concat(F.lit("big-"), F.hex("address")).alias("shard_id"),
                     F.lit(0).alias("depth"), F.monotonically_increasing_id().alias("page"),
                     F.col("n_bytes").alias("shard_bytes"))
    return small.select(columns).unionByName(big.select(columns))


def _pages(placed: DataFrame, limit: int) -> DataFrame:
    """page 0, but for buckets at full depth that are over the limit: as many equal rows a page as fit."""
    fits = placed.filter(F.col("shard_bytes") <= limit).withColumn("page", F.lit(0).cast("long"))
    over = placed.filter(F.col("shard_bytes") > limit)
    if over.isEmpty():
        return fits
    over = materialise(over.withColumn("task", F.spark_partition_id())
                       .withColumn("at", F.monotonically_increasing_id()), "overflow")
    before = Window.partitionBy("shard_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (over.groupBy("shard_id", "task").agg(F.count("*").alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    inner = Window.partitionBy("shard_id", "task").orderBy("at")
    paged = (over.withColumn("k", F.row_number().over(inner) - 1).join(offsets, ["shard_id", "task"])
             .withColumn("a_page", F.greatest(F.lit(1), F.expr(f"{limit} DIV greatest(n_bytes, 1)")))
             .withColumn("page", F.expr("CAST((k + offset) DIV a_page AS LONG)")))
    sizes = paged.groupBy("shard_id", "page").agg(F.sum("n_bytes").alias("page_bytes"))
    paged = paged.join(sizes, ["shard_id", "page"]).withColumn("shard_bytes", F.col("page_bytes"))
    return fits.unionByName(paged.select(fits.columns))
