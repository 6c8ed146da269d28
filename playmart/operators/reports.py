"""Reports over the star schema: top lists, totals, weekday, recent plays, digest stats.

Plan shape, chosen for a fact table far larger than its dimensions:

* the recency predicate is a literal (``as_of`` resolved before planning or
  ``current_timestamp()``, which Catalyst folds), so it reaches the Parquet
  scan as a pushed filter and prunes row groups / ``play_date`` partitions;
* counts are taken on the fact's *key* before any join (partial + final
  aggregate), so a hot song or artist collapses map-side and the join sees
  one row per key, never the raw plays;
* names are attached afterwards and grouped again (same-named songs merge,
  as the reports group by name), then top-N is ``orderBy+limit``
  (``TakeOrderedAndProject``: per-partition top-N, no global sort).

``group_cols`` turns any report into a per-group report (e.g. per user); the
empty tuple is the single-listener meaning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ts_literal, weekday_name, weekday_number
from .joins import join_dim
from .topn import top_n_per_group

TS = "played_at"


def as_of_column(fact: DataFrame, as_of=None, ts_col: str = TS) -> Column:
    if as_of is None:
        ts_type = fact.schema[ts_col].dataType
        now = F.current_timestamp()
        return now.cast("timestamp_ntz") if ts_type.typeName() == "timestamp_ntz" else now
    return ts_literal(as_of, fact.schema[ts_col].dataType)


def recent(fact: DataFrame, as_of=None, days: int = 7, ts_col: str = TS,
           date_col: str = "play_date") -> DataFrame:
    """Plays with ``ts >= as_of - days`` (closed lower bound, no upper bound).

    When the fact carries its partition column ``play_date`` (as the loader
    writes it), the implied ``play_date >= to_date(bound)`` is added too:
    Spark does not derive partition filters from a timestamp predicate, and
    this one prunes every older day folder.  It cannot drop a matching row
    (a later time never has an earlier date, in the session zone the loader
    used).
    """
    lower = as_of_column(fact, as_of, ts_col) - F.expr(f"INTERVAL {int(days)} DAYS")
    out = fact.filter(F.col(ts_col) >= lower)
    if date_col in fact.columns:
        out = out.filter(F.col(date_col) >= F.to_date(lower))
    return out


def plays_by_name(fact: DataFrame, dim: DataFrame, key: str, name_col: str,
                  as_of=None, days: int | None = 7, group_cols: Sequence[str] = (),
                  broadcast_max_rows: int | None = None) -> DataFrame:
    """``name_col, plays`` over the recency window: inner join on ``key``."""
    g = list(group_cols)
    f = recent(fact, as_of, days) if days is not None else fact
    per_key = f.groupBy(*g, key).agg(F.count(F.lit(1)).alias("plays"))
    return name_counts(per_key, dim, key, name_col, g, broadcast_max_rows)


def name_counts(per_key: DataFrame, dim: DataFrame, key: str, name_col: str,
                group_cols: Sequence[str] = (), broadcast_max_rows: int | None = None) -> DataFrame:
    """Attach names to per-key ``plays`` and add them up per name."""
    g = list(group_cols)
    named = join_dim(per_key, dim.select(key, name_col), key, "inner", broadcast_max_rows)
    return named.groupBy(*g, name_col).agg(F.sum("plays").alias("plays"))


def top_n(counts: DataFrame, name_col: str, n: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` by plays, ties broken by name (NULL names last)."""
    order = [F.col("plays").desc(), F.col(name_col).asc_nulls_last()]
    if not group_cols:
        return counts.orderBy(*order).limit(n)
    # per group: two-stage top-N, so one large group is not one task
    return top_n_per_group(counts, group_cols, order, n, name_col)


def top_songs(star, as_of=None, n: int = 5, days: int = 7, group_cols=(),
              broadcast_max_rows=None) -> DataFrame:
    c = plays_by_name(star.fact, star.song, "song_id", "song_name", as_of, days,
                      group_cols, broadcast_max_rows)
    return top_n(c, "song_name", n, group_cols)


def top_artists(star, as_of=None, n: int = 5, days: int = 7, group_cols=(),
                broadcast_max_rows=None) -> DataFrame:
    c = plays_by_name(star.fact, star.artist, "artist_id", "artist_name", as_of, days,
                      group_cols, broadcast_max_rows)
    return top_n(c, "artist_name", n, group_cols)


def minutes_expr(col: str = "duration_ms") -> Column:
    """Integer minutes: integer sum, truncating division, 0 when empty."""
    return F.coalesce(F.expr(f"sum({col}) div 60000"), F.lit(0).cast("long"))


def totals(fact: DataFrame, as_of=None, days: int = 7, group_cols=(),
           approximate: bool = False) -> DataFrame:
    """total_plays, unique_songs, unique_artists, total_minutes (one row per group).

    Exact distinct counts (NULL ids not counted); ``approximate=True`` swaps in
    HyperLogLog++ for very large windows.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return recent(fact, as_of, days).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("total_plays"),
        distinct("song_id").alias("unique_songs"),
        distinct("artist_id").alias("unique_artists"),
        minutes_expr().alias("total_minutes"))


def listening_minutes(fact: DataFrame, as_of=None, days: int = 7, group_cols=()) -> DataFrame:
    return recent(fact, as_of, days).groupBy(*group_cols).agg(minutes_expr().alias("mins"))


def plays_by_weekday(fact: DataFrame, as_of=None, days: int = 30, padded: bool = False,
                     group_cols=()) -> DataFrame:
    """day_name, day_num (Sunday = 0), plays; ordered by day_num."""
    return (recent(fact, as_of, days)
            .groupBy(*group_cols, weekday_name(TS, padded).alias("day_name"),
                     weekday_number(TS).alias("day_num"))
            .agg(F.count(F.lit(1)).alias("plays"))
            .orderBy(*group_cols, "day_num"))


def listening_hours_by_day(fact: DataFrame, as_of=None, days: int = 30,
                           group_cols=()) -> DataFrame:
    """play_date, listening_hours: integer sum of ms first, one division."""
    return (recent(fact, as_of, days)
            .groupBy(*group_cols, F.to_date(TS).alias("play_date"))
            .agg((F.sum("duration_ms") / F.lit(3600000.0)).alias("listening_hours")))


RECENT_ORDER = ("played_at", "song_id", "album_id", "artist_id", "duration_ms")


DIMS = (("song", "song_id", "song_name"), ("artist", "artist_id", "artist_name"),
        ("album", "album_id", "album_name"))


def _recent_join(facts: DataFrame, star, small: bool = False) -> DataFrame:
    """Attach the three names; ``small``: ``facts`` is a proven-small side."""
    out = facts
    for dim, key, name in DIMS:
        d = getattr(star, dim).select(key, name)
        out = (F.broadcast(out).join(d, key) if small else out.join(d, key))
    return out


def recent_plays(star, n: int = 20, widen: int = 8, max_candidates: int = 1 << 20) -> DataFrame:
    """Latest ``n`` plays that have all three dimension rows (4-way inner join).

    Plan: take the fact's own top-k (per-partition top-k, no shuffle of the
    fact), checkpoint those k rows and attach the names with the candidates
    as the broadcast side (dimension keys are unique by contract, so the side
    stays at most k rows; the dimensions are only streamed, never shuffled).
    If at least ``n`` candidates matched, the answer lies among them (any
    play outside the top-k is later in the order).  Otherwise k grows
    ``widen``-fold; beyond ``max_candidates`` the whole fact is joined before
    the top-N.  The result is exact in every case.
    """
    order = [F.col("played_at").desc_nulls_last()] + [F.col(c).asc_nulls_last()
                                                      for c in RECENT_ORDER[1:]]
    cols = ["played_at", "song_name", "artist_name", "album_name"]
    fact = star.fact.select(*RECENT_ORDER)
    k = n
    while k <= max_candidates:
        cands = fact.orderBy(*order).limit(k).checkpoint(eager=True)
        named = _recent_join(cands, star, small=True).persist()
        if named.count() >= n or cands.count() < k:
            out = named.orderBy(*order).limit(n).select(*cols).checkpoint(eager=True)
            named.unpersist()
            return out
        named.unpersist()
        k *= widen
    return _recent_join(fact, star).orderBy(*order).limit(n).select(*cols)


def latest_events(fact: DataFrame) -> DataFrame:
    """All plays newest first (a range-partitioned global sort)."""
    order = [F.col("played_at").desc_nulls_last()] + [F.col(c).asc_nulls_last()
                                                      for c in RECENT_ORDER[1:]]
    return fact.orderBy(*order)


def _ranked_list(top: DataFrame, name_col: str, group_cols: Sequence[str], alias: str):
    """Pack a top list into ``array<struct<name, plays>>`` in rank order.

    Sort key: plays descending, then name with NULL last (as ``top_n`` ranks).
    """
    packed = F.sort_array(F.collect_list(F.struct(
        (-F.col("plays")).alias("_k"), F.col(name_col).isNull().alias("_null"),
        F.col(name_col).alias("name"), F.col("plays").alias("plays"))))
    return top.groupBy(*group_cols).agg(
        F.transform(packed, lambda x: F.struct(x["name"].alias("name"),
                                               x["plays"].alias("plays"))).alias(alias))


def weekly_stats(star, as_of=None, n: int = 5, days: int = 7, group_cols=()) -> DataFrame:
    """One row per group: top_songs, top_artists (array<struct<name, plays>>), total_minutes.

    The window is read once: plays and milliseconds are aggregated per
    (song, artist), that small result is checkpointed (a reliable copy in the
    shared folder, so lost executors do not re-read the fact), and the three
    parts are derived from it.  Each list holds at most ``n`` entries per
    group, so packing is bounded however many plays a group has.  With no
    ``group_cols`` an empty window still yields one row: empty lists and 0
    minutes.
    """
    g = list(group_cols)
    base = (recent(star.fact, as_of, days)
            .groupBy(*g, "song_id", "artist_id")
            .agg(F.count(F.lit(1)).alias("plays"), F.sum("duration_ms").alias("ms"))
            .checkpoint(eager=True))
    per_song = base.groupBy(*g, "song_id").agg(F.sum("plays").alias("plays"))
    per_artist = base.groupBy(*g, "artist_id").agg(F.sum("plays").alias("plays"))
    songs = _ranked_list(top_n(name_counts(per_song, star.song, "song_id", "song_name", g),
                               "song_name", n, g), "song_name", g, "top_songs")
    artists = _ranked_list(top_n(name_counts(per_artist, star.artist, "artist_id",
                                             "artist_name", g), "artist_name", n, g),
                           "artist_name", g, "top_artists")
    minutes = base.groupBy(*g).agg(
        F.coalesce(F.expr("sum(ms) div 60000"), F.lit(0).cast("long")).alias("mins"))
    # Assemble one row per group without a join: union the three parts (each
    # has one value per group) and take the single non-NULL value per column.
    arr = "array<struct<name:string,plays:bigint>>"
    parts = (songs.select(*g, "top_songs", F.lit(None).cast(arr).alias("top_artists"),
                          F.lit(None).cast("long").alias("mins"))
             .unionByName(artists.select(*g, F.lit(None).cast(arr).alias("top_songs"),
                                         "top_artists", F.lit(None).cast("long").alias("mins")))
             .unionByName(minutes.select(*g, F.lit(None).cast(arr).alias("top_songs"),
                                         F.lit(None).cast(arr).alias("top_artists"),
                                         F.col("mins").cast("long"))))
    out = parts.groupBy(*g).agg(F.max("top_songs").alias("top_songs"),
                                F.max("top_artists").alias("top_artists"),
                                F.max("mins").alias("mins"))
    empty = F.array().cast(arr)
    return out.select(*g,
                      F.coalesce("top_songs", empty).alias("top_songs"),
                      F.coalesce("top_artists", empty).alias("top_artists"),
                      F.coalesce("mins", F.lit(0).cast("long")).alias("total_minutes"))


def explode_stats(stats: DataFrame, group_cols=()) -> DataFrame:
    """Flatten weekly stats to ``list, pos, name, plays, total_minutes`` rows."""
    g = list(group_cols)
    parts = []
    for list_name, col in (("songs", "top_songs"), ("artists", "top_artists")):
        parts.append(stats.select(*g, F.lit(list_name).alias("list"),
                                  F.posexplode(col).alias("pos0", "item"),
                                  "total_minutes")
                     .select(*g, "list", (F.col("pos0") + 1).alias("pos"),
                             F.col("item.name").alias("name"),
                             F.col("item.plays").alias("plays"), "total_minutes"))
    return parts[0].unionByName(parts[1])


def headline_top_song(stats: DataFrame, group_cols=()) -> DataFrame:
    """First song of the ranked list, or ``none``."""
    return stats.select(*group_cols, "total_minutes",
                        F.coalesce(F.get(F.col("top_songs"), 0)["name"],
                                   F.lit("none")).alias("top_song"))
