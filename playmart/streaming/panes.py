"""Windowed KPIs as a table that follows the fact, late plays included.

A streaming aggregate must forget old windows and drop what comes later
(``rolling.py``).  Here each load of the fact names the days that its *inserted*
plays touch (``Warehouse(track_days=True)``); those days, and no others, are
aggregated anew from the fact and replaced.  A play that arrives months late
is one more touched day, and a replay touches none.

What is stored are panes, the stretches between any two window borders: every
play is counted once, in its pane, and a window of any size and slide that the
pane divides is a sum of panes (``windows``) - not size / slide copies of every
play.  Per pane there are rows per song, album and artist and a total, from one
pass of grouping sets.

The table is a ``VersionedTable`` whose parts are days: a refresh writes the
touched days to a new folder and one pointer switches to all of them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import FACT_HISTORY
from ..sinks.loader import Warehouse
from ..sinks.versions import VersionedTable
from .consumers import _trigger

GROUPS = ("song_id", "album_id", "artist_id")
DAY = 86_400
SCHEMA = "pane_start timestamp, grouping string, key string, plays long, listening_ms long, play_date date"
#: Seconds of the units that a window size may have.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": DAY, "week": 7 * DAY}


def seconds(interval: str) -> int:
    """``'6 hours'`` as seconds (units of fixed length only)."""
    m = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", interval.lower())
    if not m or m.group(2) not in UNITS or not int(m.group(1)):
        raise ValueError(f"not a fixed interval: {interval}")
    return int(m.group(1)) * UNITS[m.group(2)]


def pane_width(*intervals: str) -> int:
    """The longest pane, at most a day, that divides all the given sizes and slides."""
    return math.gcd(DAY, *map(seconds, intervals))


def panes(plays: DataFrame, width: int, group_cols: Sequence[str] = GROUPS) -> DataFrame:
    """pane_start, grouping, key, plays, listening_ms, play_date of plays (grouping ``total``: key is NULL)."""
    g = list(group_cols)
    start = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("played_at").cast("timestamp")) / width) * width)
    src = plays.select("play_date", start.alias("pane_start"), *[F.col(c).cast("string").alias(c) for c in g], "duration_ms")
    base = [F.col("play_date"), F.col("pane_start")]
    agg = (src.groupingSets([[*base, F.col(c)] for c in g] + [base], *base, *[F.col(c) for c in g])
           .agg(F.count(F.lit(1)).alias("plays"), F.sum("duration_ms").cast("long").alias("listening_ms"),
                *[F.grouping(c).alias(f"_{c}") for c in g]))
    name, key = F.lit("total"), F.lit(None).cast("string")
    for c in g:
        name = F.when(F.col(f"_{c}") == 0, F.lit(c)).otherwise(name)
        key = F.when(F.col(f"_{c}") == 0, F.col(c)).otherwise(key)
    return agg.select("pane_start", name.alias("grouping"), key.alias("key"), "plays", "listening_ms", "play_date")


def windows(held: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """window_start, window_end, grouping, key, plays, listening_ms: sums of panes.

    A pane goes to the size / slide windows that hold it; plays don't.
    """
    long, step = seconds(size), seconds(slide or size)
    if step > long:
        raise ValueError("a slide longer than the window leaves gaps")
    at = F.unix_seconds("pane_start")
    last = F.floor(at / step) * step
    starts = F.sequence(last, last - (F.ceil((last + long - at) / step) - 1) * step, F.lit(-step).cast("long"))
    spread = (held.withColumn("_start", last) if step == long else held.withColumn("_start", F.explode(starts)))
    return (spread.groupBy("_start", "grouping", "key")
            .agg(F.sum("plays").alias("plays"), F.sum("listening_ms").alias("listening_ms"))
            .select(F.timestamp_seconds("_start").alias("window_start"),
                    F.timestamp_seconds(F.col("_start") + long).alias("window_end"),
                    "grouping", "key", "plays", "listening_ms"))


class DayTable:
    """A table derived from the fact, one part per day; ``derive`` gives a frame with a column play_date."""

    schema: str

    def __init__(self, wh: Warehouse, root: str):
        self.wh = wh
        self.table = VersionedTable(wh.spark, root)

    def derive(self, days: Sequence[str]) -> DataFrame | None:
        raise NotImplementedError

    def refresh(self, days: Iterable[str]) -> None:
        """Derive the given days anew and replace them, all at once."""
        days = sorted(set(days))
        rows = self.derive(days) if days else None
        if rows is None:
            return
        folder = self.table.folder()
        (rows.withColumn("day", F.col("play_date")).hint("rebalance", "day")
         .write.partitionBy("day").parquet(f"{self.table.root}/{folder}"))
        held = set(self.table.files.names(f"{self.table.root}/{folder}"))
        self.table.publish({d: f"{folder}/day={d}" for d in days if f"day={d}" in held})

    def read(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """The current rows; only the folders of days from first to last are listed and read."""
        now = self.table.current()
        paths = [f"{self.table.root}/{now[d]}" for d in sorted(now)
                 if (first is None or d >= first) and (last is None or d <= last)]
        spark = self.wh.spark
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)


class PaneTable(DayTable):
    """Panes of a warehouse's fact."""

    schema = SCHEMA

    def __init__(self, wh: Warehouse, root: str, width: int = DAY, group_cols: Sequence[str] = GROUPS):
        super().__init__(wh, root)
        if DAY % width:
            raise ValueError("a pane must divide a day")
        self.width, self.group_cols = width, tuple(group_cols)

    def derive(self, days: Sequence[str]) -> DataFrame | None:
        plays = self.wh.read_days(FACT_HISTORY.name, days)
        return None if plays is None else panes(plays, self.width, self.group_cols)


def touched_days(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The log of touched days as a stream (new loads only)."""
    wh.journal(FACT_HISTORY.name).files.make(wh.touched_path)
    return spark.readStream.schema("play_date date, batch_id string").parquet(wh.touched_path)


def start_pane_refresh(tables: Sequence[DayTable], checkpoint: str, query_name: str = "pane_refresh",
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Refresh tables of one warehouse, in the given order, as its loads announce their days.

    A batch holds one row per load and day, so the days that it brings back are at most those of the calendar.
    """
    def refresh(batch: DataFrame, batch_id: int) -> None:
        days = [r[0] for r in batch.select(F.col("play_date").cast("string")).distinct().collect()]
        for t in tables:
            t.refresh(days)

    wh = tables[0].wh
    w = (touched_days(wh.spark, wh).writeStream.queryName(query_name)
         .option("checkpointLocation", checkpoint).foreachBatch(refresh))
    return _trigger(w, available_now, processing_time).start()
