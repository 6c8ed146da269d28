"""Dense row numbers without a single-partition window.

``row_number().over(Window.orderBy(k))`` moves every row into one task.
Instead: (optionally) range-partition and sort by the key, materialise that
once (a reliable checkpoint, so both passes below see the same partitions),
count rows per partition (one small row per partition), turn the counts into
prefix offsets, and add each row's position inside its partition.  The only
thing broadcast is the offsets table, whose size is the partition count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_row_index(df: DataFrame, order_cols: Sequence[str] = (), start: int = 1,
                   col: str = "id", checkpoint: bool = True) -> DataFrame:
    """Add ``col`` = start, start+1, ... (in ``order_cols`` order if given)."""
    if order_cols:
        df = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    if checkpoint:
        df = df.checkpoint(eager=True)
    tagged = df.withColumn("_pid", F.spark_partition_id()) \
               .withColumn("_mono", F.monotonically_increasing_id())
    # position inside the partition: the low 33 bits of the monotonic id
    tagged = tagged.withColumn("_pos", F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(col, F.col("_off") + F.col("_pos") + F.lit(start))
            .drop("_pid", "_mono", "_pos", "_off"))
