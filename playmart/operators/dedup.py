"""De-duplication: stream (unbounded or watermark-bounded state) and batch.

Batch survivor selection uses an aggregate, not a window: ``min_by`` over the
tie-break is a partial aggregate, so copies of a hot key are reduced on the
map side before the shuffle instead of being gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_stream(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key across all micro-batches; state grows with the key set.

    Use for dimensions (the key set is the catalogue) with the RocksDB state
    store; NULL keys count as equal.
    """
    return df.dropDuplicates(list(keys))


def dedup_within_watermark(df: DataFrame, keys: Sequence[str], event_time: str,
                           delay: str = "1 hour") -> DataFrame:
    """Bounded-state dedup: a key is remembered until the watermark passes it.

    Rows later than the watermark are dropped as late, which bounds the state
    for the unbounded fact stream.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_batch(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key; the survivor is the smallest ``order`` tuple (all other
    columns when ``order`` is empty), so the result is deterministic."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = list(order) or rest
    best = F.min_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(best.alias("_s")).select(*keys, *[f"_s.{c}" for c in rest]) \
             .select(*df.columns)
