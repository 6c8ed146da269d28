"""Joins between the fact and the dimensions.

Broadcast policy: a side is broadcast only behind a size check.  By default
the check is Spark's own (``autoBroadcastJoinThreshold`` from file statistics
at planning time, and again from real shuffle sizes under AQE); a caller that
knows a row bound can pass ``broadcast_max_rows`` and the side is counted up
to that bound first.  Above any bound the join is a shuffle (sort-merge) join,
with AQE skew-join splitting hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fits_in_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def checked_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """``broadcast(df)`` if it is proven to hold at most ``max_rows`` rows."""
    if max_rows is not None and fits_in_rows(df, max_rows):
        return F.broadcast(df)
    return df


def join_dim(facts: DataFrame, dim: DataFrame, key: str | Sequence[str],
             how: str = "inner", broadcast_max_rows: int | None = None) -> DataFrame:
    """Equi-join on the business key; the dimension is the build side."""
    return facts.join(checked_broadcast(dim, broadcast_max_rows), key, how)


def new_rows_only(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``target`` (insert-if-absent).

    ``=`` semantics: a NULL key part never matches, as a UNIQUE constraint lets
    NULLs repeat.
    """
    return batch.join(target.select(*keys), list(keys), "left_anti")


def unmatched_fact_rows(fact: DataFrame, song: DataFrame, artist: DataFrame,
                        album: DataFrame) -> DataFrame:
    """Plays that an inner star join would drop, counted per dimension.

    One scan of the fact counts plays per song, per artist and per album at
    once (grouping sets; partial aggregation, so a hot key is one row per
    task before the shuffle).  The per-key counts, tagged with their grouping
    id, are anti-joined once with the three dimensions' keys (tagged the same
    way) - the raw plays are never shuffled or joined.  A NULL key never
    matches, so its plays count as unmatched.  Rows ``(dimension, unmatched)``.
    """
    keys = ("song_id", "artist_id", "album_id")
    # grouping_id bits follow (song_id, artist_id, album_id): 0 for the grouped column
    gid = {"song_id": 0b011, "artist_id": 0b101, "album_id": 0b110}
    counts = (fact.select(*keys)
              .groupingSets([[k] for k in keys], *keys)
              .agg(F.count(F.lit(1)).alias("plays"), F.grouping_id().alias("_gid")))
    key = F.when(F.col("_gid") == gid["song_id"], F.col("song_id").cast("string")) \
           .when(F.col("_gid") == gid["artist_id"], F.col("artist_id").cast("string")) \
           .otherwise(F.col("album_id").cast("string"))
    tagged = counts.select(key.alias("_k"), "_gid", "plays")
    dim_keys = None
    for k, dim in (("song_id", song), ("artist_id", artist), ("album_id", album)):
        part = dim.select(F.col(k).cast("string").alias("_k"),
                          F.lit(gid[k]).cast(tagged.schema["_gid"].dataType).alias("_gid"))
        dim_keys = part if dim_keys is None else dim_keys.unionByName(part)
    missing = tagged.join(dim_keys, ["_k", "_gid"], "left_anti")
    names = (("dim_song", "song_id"), ("dim_artist", "artist_id"), ("dim_album", "album_id"))
    agg = missing.agg(*[F.coalesce(F.sum(F.when(F.col("_gid") == gid[k], F.col("plays"))),
                                   F.lit(0)).cast("long").alias(d) for d, k in names])
    return agg.select(F.expr(
        "stack(3, 'dim_song', dim_song, 'dim_artist', dim_artist, 'dim_album', dim_album)"
        " AS (dimension, unmatched)"))
