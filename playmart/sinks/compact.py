"""Small-file compaction for the star folders written batch by batch.

Every micro-batch appends a few small files; a long-running load needs them
rewritten into fewer, larger ones.

* fact: take a reliable checkpoint (so the write never reads the files it
  replaces, and a lost executor recomputes from the copy), then rewrite only the given
  (closed) ``play_date`` folders, with dynamic partition overwrite - every
  other day is untouched;
* dimension: rewrite the whole table with fewer files (ids and rows kept) in a
  folder beside it, then switch.

Run a compaction when no loader writes the same table (one writer per table).
Compact only *closed* fact days - windows already behind the rolling KPIs'
watermark: the rolling query reads the fact folder as a file stream, sees
rewritten files as new input, and drops rows that old as late data; a day
still inside the watermark would be counted twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..schemas import FACT_HISTORY
from .loader import Warehouse
from .versions import Files

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def compact_fact_days(wh: Warehouse, days: Sequence[str], files_per_day: int = 1) -> int:
    """Rewrite the fact's ``play_date`` folders in ``days``; returns rows rewritten."""
    if not days:
        return 0
    spark = wh.spark
    path = wh.path(FACT_HISTORY.name)
    glob = "{" + ",".join(f"play_date={d}" for d in days) + "}"
    try:
        part = spark.read.option("basePath", path).parquet(f"{path}/{glob}")
    except AnalysisException:
        return 0                                   # none of those days holds plays
    part = part.checkpoint(eager=True)
    rows = part.count()
    old = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        (part.repartition(max(1, files_per_day * len(days)), "play_date",
                          F.pmod(F.xxhash64("song_id"), F.lit(files_per_day)))
         .write.mode("overwrite").partitionBy("play_date").parquet(path))
    finally:
        spark.conf.set(OVERWRITE_MODE, old)
    return rows


def compact_table(wh: Warehouse, table: str, files: int = 1) -> int:
    """Rewrite a (dimension) table into ``files`` files; returns rows rewritten.

    The new files are written beside the table, whole, before the folders change
    names; ``Warehouse.read`` completes a switch that was cut short between the two renames.
    """
    df = wh.read(table)
    if df is None:
        return 0
    new = wh.beside(table)
    fs = Files(wh.spark, wh.root)
    if fs.exists(new):
        fs.delete(new)                      # left by a rewrite that didn't end
    df.repartition(max(1, files)).write.parquet(new)
    rows = wh.spark.read.parquet(new).count()
    old = f"{wh.root}/_replaced_{table}-{uuid.uuid4().hex[:8]}"
    fs.move(wh.path(table), old)
    wh.finish_switch(table)
    fs.delete(old)
    return rows
