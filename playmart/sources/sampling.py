"""Sampling rows with replacement.

``exact``: draw exactly ``min(n, rows)`` positions uniformly (with replacement)
in the order of a digest of each row's key, and fetch the rows at these
positions.  The digest's first digits deal the table to buckets; one narrow
aggregation counts them, the draws are allotted to buckets by running sums, and
only rows of buckets with a draw are put in order (for 200 draws: at most
200 of 4,096 buckets).  The table is read twice and never copied.  The result
hangs on the rows and the seed alone, not on files or partitions.
``approximate``: Spark's Poisson sampler (``sample(withReplacement=True)``).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ids import with_row_index


# The draws are made on the driver and broadcast: up to so many.
MOST_DRAWS = 1_000_000


def positions(n: int, rows: int, seed: int) -> list[int]:
    """n uniform positions below ``rows``, from digests of the seed and a counter (52 bits each)."""
    return [int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:13], 16) * rows >> 52 for i in range(n)]


def sample_with_replacement(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows drawn uniformly with replacement.

    ``keys``: the columns that name a row (default: all); rows with equal keys are ordered by a hash of the whole row.
    """
    if n > MOST_DRAWS:
        raise ValueError(f"at most {MOST_DRAWS} draws; use sample_approx")
    names = list(keys or df.columns)
    digits = min(5, max(3, len(f"{20 * n:x}")))          # about one bucket in twenty has a draw, or fewer
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]))
    marked = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, digits))
    # at most 16 ** 5 rows, one per bucket
    counts = sorted(map(tuple, marked.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()))
    total = sum(c for _, c in counts)
    k = min(n, total)
    if k == 0:
        return df.limit(0)
    ends = list(accumulate(c for _, c in counts))
    draws = [(bisect_right(ends, p), p) for p in positions(k, total, seed)]
    shift, at = {}, 0                                    # from a position in the table to one among drawn buckets
    for b in sorted({b for b, _ in draws}):
        shift[b] = ends[b] - counts[b][1] - at
        at += counts[b][1]
    spark = df.sparkSession
    drawn = spark.createDataFrame([(p - shift[b],) for b, p in draws], "_row long")
    wanted = spark.createDataFrame([(counts[b][0],) for b in shift], "_bucket string")
    held = marked.join(F.broadcast(wanted), "_bucket", "left_semi").withColumn("_all", F.xxhash64(*df.columns))
    indexed = with_row_index(held, ["_digest", *names, "_all"], start=0, col="_row")
    return indexed.join(F.broadcast(drawn), "_row").select(*df.columns)


def sample_approx(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    return df.sample(withReplacement=True, fraction=fraction, seed=seed)
