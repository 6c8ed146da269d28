"""Top-N per group without sending a whole group to one task.

A window ``partitionBy(group)`` puts every row of a group into one task; a
group can hold a large share of all rows (one listener, one busy day).  Two
stages instead:

1. top-N inside (group, bucket), where the bucket is a hash of the item, so a
   big group is spread over ``buckets`` tasks;
2. top-N per group over what is left: at most ``n * buckets`` rows per group.

Exact: with a total order (ties broken by the item), every member of a
group's top-N is also in the top-N of its own bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    n: int, item_col: str, buckets: int = 64,
                    rank_col: str | None = None) -> DataFrame:
    """Rows ranked ``1..n`` per group by ``order`` (which must end in ``item_col``).

    ``rank_col`` (when given) keeps the final rank as an integer column.
    """
    g = list(group_cols)
    salted = df.withColumn("_b", F.pmod(F.xxhash64(F.col(item_col)), F.lit(buckets)))
    w1 = Window.partitionBy(*g, "_b").orderBy(*order)
    stage1 = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n)
    w2 = Window.partitionBy(*g).orderBy(*order)
    out = (stage1.drop("_b", "_r").withColumn("_r", F.row_number().over(w2))
           .filter(F.col("_r") <= n))
    if rank_col:
        return out.withColumnRenamed("_r", rank_col)
    return out.drop("_r")
