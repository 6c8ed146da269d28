"""Landing data arriving over time: write a table's rows in time slices.

The rows are derived once, into a folder per slice.  Each slice is an ordinary
parallel write into the landing folder; between
slices the caller runs its ``availableNow`` queries, so every slice is a new
micro-batch after a restart from the checkpoint (state and offsets carried
across).  Slices are cut on whole seconds of the event time, so rows that
share a second (and hence a played_at key) land in the same slice.
A slice's folder goes once the slice has landed for the last time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import open_files, scratch_dir
from ..sinks.topics import write_landing
from ..sinks.versions import Files

#: Bytes that one open Parquet file of the staged slices holds back before it writes.
STAGED_BLOCK = 16 * 1024 * 1024


def slice_column(df: DataFrame, ts_col: str, n: int) -> Column:
    sec = F.unix_seconds(F.col(ts_col).cast("timestamp"))
    lo, hi = df.agg(F.min(sec), F.max(sec)).first()
    if lo is None:
        return F.lit(0)
    width = (hi - lo + 1) / n
    return F.least(F.floor((sec - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(n - 1))


def stage_and_run(records: DataFrame, landing_root: str, ts_col: str, n: int,
                  run: Callable[[int], None], replay: bool = False,
                  order: Sequence[int] | None = None, times: DataFrame | None = None) -> None:
    """Write slice k then call ``run``; with ``replay`` send all slices again.

    ``order``: in which the slices arrive (default: by time); one that comes after a later one is late.
    ``times``: a frame that holds the records' times and is cheaper to read (e.g. the plays before the fan-out).
    """
    spark = records.sparkSession
    staged = scratch_dir(spark, "slices")
    rows = records.withColumn("_slice", slice_column(records if times is None else times, ts_col, n)).select("topic", "key", "value", "_slice")
    files = Files(spark, staged)
    try:
        with open_files(spark, n + 1):       # one per slice, and one for rows without a time
            (rows.write.partitionBy("_slice").option("parquet.block.size", STAGED_BLOCK).option("compression", "zstd")
             .parquet(staged))
        tagged = spark.read.schema(rows.schema).parquet(staged)
        once = list(range(n) if order is None else order)
        rounds = once + (once if replay else [])
        for i, k in enumerate(rounds):
            write_landing(tagged.filter(F.col("_slice") == k).drop("_slice"), landing_root)
            if k not in rounds[i + 1:]:
                files.delete(f"{staged}/_slice={k}")
            run(i)
    finally:
        files.delete(staged)
