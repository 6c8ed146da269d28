"""Reports put together from daily partials instead of rescanning 7 and 30 days of plays.

Counts and minutes come from the pane table.  Distinct songs and artists come
from ``DistinctTable``: per day and item, bitmaps over the dense surrogate ids
of the dimensions (32,768 ids to a bitmap), which are merged by OR and counted;
keys that had no dimension row when their day was derived are kept as
themselves and are given their id when the report is made, so a song is never
counted twice.

A report window begins inside a day: that one day is read from the fact (its
folder only) and turned into the same partials.  All reports equal those
of ``operators.reports`` on the fact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import weekday_name, weekday_number
from ..operators import reports as R
from ..schemas import FACT_HISTORY
from ..sinks.loader import Warehouse
from .panes import DayTable, PaneTable, panes

#: Which dimension numbers the keys of a grouping.
ITEMS = {"song_id": "dim_song", "artist_id": "dim_artist"}
SET_SCHEMA = "play_date date, item string, bucket long, bitmap binary, key string"


def numbered(keys: DataFrame, wh: Warehouse) -> DataFrame:
    """Adds ``id``, the dimension's surrogate id of (item, key), NULL where it has none."""
    ids = None
    for item, dim in ITEMS.items():
        rows = wh.read(dim)
        if rows is not None:
            rows = rows.select(F.lit(item).alias("item"), F.col(item).cast("string").alias("key"), F.col("id").cast("long").alias("id"))
            ids = rows if ids is None else ids.unionByName(rows)
    return keys.withColumn("id", F.lit(None).cast("long")) if ids is None else keys.join(ids, ["item", "key"], "left")


def distinct_sets(keys: DataFrame, wh: Warehouse) -> DataFrame:
    """(play_date, item, key) as sets: a bitmap per day, item and bucket of ids, and the keys without an id."""
    known = numbered(keys.distinct(), wh)
    maps = (known.filter("id IS NOT NULL")
            .groupBy("play_date", "item", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))
            .withColumn("key", F.lit(None).cast("string")))
    rest = (known.filter("id IS NULL")
            .select("play_date", "item", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bitmap"), "key"))
    return maps.unionByName(rest)


def distinct_counts(sets: DataFrame, wh: Warehouse) -> DataFrame:
    """item, n: how many different keys the sets hold together."""
    loose = sets.filter("bitmap IS NULL").select(F.lit(None).cast("date").alias("play_date"), "item", "key")
    again = distinct_sets(loose, wh)          # keys whose dimension row came later have an id by now
    merged = (sets.filter("bitmap IS NOT NULL").select("item", "bucket", "bitmap")
              .unionByName(again.filter("bitmap IS NOT NULL").select("item", "bucket", "bitmap"))
              .groupBy("item", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n")))
    rest = again.filter("bitmap IS NULL").groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    return merged.select("item", "n").unionByName(rest).groupBy("item").agg(F.sum("n").cast("long").alias("n"))


def _keys(held: DataFrame) -> DataFrame:
    return (held.filter(F.col("grouping").isin(*ITEMS) & F.col("key").isNotNull())
            .select("play_date", F.col("grouping").alias("item"), "key"))


class DistinctTable(DayTable):
    """Daily sets of songs and artists, derived from the pane table's rows."""

    schema = SET_SCHEMA

    def __init__(self, pane_table: PaneTable, root: str):
        super().__init__(pane_table.wh, root)
        self.panes = pane_table

    def derive(self, days: Sequence[str]) -> DataFrame | None:
        wanted = [F.lit(d).cast("date") for d in days]
        held = self.panes.read(days[0], days[-1]).filter(F.col("play_date").isin(*wanted))
        return distinct_sets(_keys(held), self.wh)


class Partials:
    """Panes and sets of the days of a report window; the day in which it begins comes from the fact."""

    def __init__(self, pane_table: PaneTable, sets: DistinctTable, as_of: str, days: int):
        wh = pane_table.wh
        bound = wh.spark.range(1).select(
            (F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")).alias("b")).select(
            F.date_format("b", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.date_format(F.date_add("b", 1), "yyyy-MM-dd")).first()
        first, after = bound[0][:10], bound[1]
        self.wh = wh
        self.panes, self.sets = pane_table.read(after), sets.read(after)
        plays = wh.read_days(FACT_HISTORY.name, [first])
        if plays is not None:
            opening = panes(plays.filter(F.col("played_at") >= F.lit(bound[0]).cast("timestamp")),
                            pane_table.width, pane_table.group_cols)
            self.panes = self.panes.unionByName(opening)
            self.sets = self.sets.unionByName(distinct_sets(_keys(opening), wh))

    def _top(self, key: str, dim: str, name: str, n: int) -> DataFrame:
        per_key = (self.panes.filter(F.col("grouping") == key).groupBy(F.col("key").alias(key))
                   .agg(F.sum("plays").alias("plays")))
        names = self.wh.spark.read.parquet(self.wh.path(dim))
        return R.top_n(R.name_counts(per_key, names, key, name), name, n)

    def top_songs(self, n: int = 10) -> DataFrame:
        return self._top("song_id", "dim_song", "song_name", n)

    def top_artists(self, n: int = 10) -> DataFrame:
        return self._top("artist_id", "dim_artist", "artist_name", n)

    def _totals(self) -> DataFrame:
        return self.panes.filter(F.col("grouping") == "total")

    def totals(self) -> DataFrame:
        """total_plays, unique_songs, unique_artists, total_minutes: one row."""
        plays = self._totals().agg(F.coalesce(F.sum("plays"), F.lit(0)).alias("total_plays"),
                                   R.minutes_expr("listening_ms").alias("total_minutes"), F.lit(0).alias("_one"))
        count = lambda item: F.coalesce(F.sum(F.when(F.col("item") == item, F.col("n"))), F.lit(0))
        items = distinct_counts(self.sets, self.wh).agg(
            count("song_id").alias("unique_songs"), count("artist_id").alias("unique_artists"), F.lit(0).alias("_one"))
        return plays.join(items, "_one").select("total_plays", "unique_songs", "unique_artists", "total_minutes")

    def plays_by_weekday(self, padded: bool = False) -> DataFrame:
        return (self._totals().groupBy(weekday_name("play_date", padded).alias("day_name"),
                                       weekday_number("play_date").alias("day_num"))
                .agg(F.sum("plays").alias("plays")).orderBy("day_num"))

    def listening_hours_by_day(self) -> DataFrame:
        return (self._totals().groupBy("play_date")
                .agg((F.sum("listening_ms") / F.lit(3600000.0)).alias("listening_hours")))


def report_tables(pane_table: PaneTable, sets: DistinctTable, as_of: str) -> dict[str, DataFrame]:
    """The refreshed reports (see ``refresh``) as of a time, given as text in the session's zone."""
    week, month = Partials(pane_table, sets, as_of, 7), Partials(pane_table, sets, as_of, 30)
    return {"top_songs": week.top_songs(10), "top_artists": week.top_artists(10),
            "plays_by_weekday": month.plays_by_weekday(), "totals": week.totals(),
            "listening_hours_by_day": month.listening_hours_by_day()}
