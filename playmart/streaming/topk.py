"""Top items per window from sketches of bounded size, exact all the same.

Per pane a frequent-items sketch is kept (``approx_top_k_accumulate``): its size is
bounded whatever the number of items, and sketches merge, so the sketch of a window
is that of its panes (``approx_top_k_combine``).  A window's sketch names
candidates; the candidates, and nothing else, are counted exactly in the
fact.  An item that the sketch doesn't name has at most ``n * 3.5 / size``
plays of n, where size is the sketch's table (the guarantee of the frequent-items
algorithm at its usual load).  So if the last of the top k has more than that, no other
item can be among them, however ties fall: the window is proven.  Windows
that aren't are counted in full; with few plays or very even ones that is the
common case, and costs what it would have cost anyway.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.topn import top_n_per_group
from ..schemas import FACT_HISTORY
from ..sinks.loader import Warehouse
from .panes import DAY, DayTable, seconds

TRACKED = 1_000
#: Stands for a missing item in a sketch, which counts values only.
NO_ITEM = "\x00"


def table_size(tracked: int) -> int:
    """Entries of a sketch's table that tracks so many items: a power of two, at most three quarters full."""
    return 1 << max(3, math.ceil(math.log2(tracked / 0.75)))


def _start(col: F.Column, width: int) -> F.Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(col.cast("timestamp")) / width) * width)


class SketchTable(DayTable):
    """Per pane: the number of plays and a sketch of one item column."""

    def __init__(self, wh: Warehouse, root: str, item: str = "song_id", width: int = DAY, tracked: int = TRACKED):
        super().__init__(wh, root)
        self.item, self.width, self.tracked = item, width, tracked

    @property
    def schema(self):
        return self.sketches(self.wh.spark.createDataFrame(
            [], f"play_date date, played_at timestamp, {self.item} string")).schema

    def sketches(self, plays: DataFrame) -> DataFrame:
        return (plays.select("play_date", _start(F.col("played_at"), self.width).alias("pane_start"),
                             F.coalesce(F.col(self.item).cast("string"), F.lit(NO_ITEM)).alias("item"))
                .groupBy("play_date", "pane_start")
                .agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(item, {self.tracked})").alias("sketch")))

    def derive(self, days: Sequence[str]) -> DataFrame | None:
        plays = self.wh.read_days(FACT_HISTORY.name, days)
        return None if plays is None else self.sketches(plays)


def candidates(held: DataFrame, size: str, tracked: int) -> DataFrame:
    """window_start, n (plays), items: what the sketch of each tumbling window tracks."""
    return (held.groupBy(_start(F.col("pane_start"), seconds(size)).alias("window_start"))
            .agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
            .select("window_start", "n", F.expr(f"transform(approx_top_k_estimate(sketch, {tracked}), x -> x.item)").alias("items")))


def top_per_window(table: SketchTable, size: str = "1 day", k: int = 5, first: str | None = None,
                   last: str | None = None) -> DataFrame:
    """window_start, rank, item, plays, proven: the top k items of every window, ties by item (a missing one last).

    ``proven``: the sketch alone ruled out all other items.
    """
    wide = seconds(size)
    if wide % table.width:
        raise ValueError("a window must be made of whole panes")
    named = candidates(table.read(first, last), size, table.tracked).checkpoint()
    item = F.coalesce(F.col(table.item).cast("string"), F.lit(NO_ITEM)).alias("item")
    fact = table.wh.read(FACT_HISTORY.name)
    if first is not None:
        fact = fact.filter(F.col("play_date") >= F.lit(first).cast("date"))
    if last is not None:
        fact = fact.filter(F.col("play_date") <= F.lit(last).cast("date"))
    plays = fact.select(_start(F.col("played_at"), wide).alias("window_start"), item)
    wanted = named.select("window_start", F.explode("items").alias("item"))
    counted = (plays.join(wanted, ["window_start", "item"], "left_semi")
               .groupBy("window_start", "item").agg(F.count(F.lit(1)).alias("plays"))).checkpoint()
    best = _top(counted, k).checkpoint()
    reached = (counted.groupBy("window_start").agg(F.sum("plays").alias("covered"))
               .join(best.groupBy("window_start").agg(F.count(F.lit(1)).alias("found"), F.min("plays").alias("least")), "window_start"))
    bound = F.col("n") * F.lit(3.5 / table_size(table.tracked))
    # every play belongs to a candidate, or no other item can have as many as the last of the top k
    judged = (named.select("window_start", "n").join(reached, "window_start", "left")
              .select("window_start", ((F.col("covered") == F.col("n"))
                                       | (F.col("found") >= k) & (F.col("least") > bound)).alias("proven")))
    judged = judged.fillna(False, ["proven"]).checkpoint()
    rest = judged.filter("NOT proven").select("window_start")
    full = (plays.join(rest, "window_start", "left_semi")
            .groupBy("window_start", "item").agg(F.count(F.lit(1)).alias("plays")))
    out = (best.join(judged.filter("proven"), "window_start")
           .unionByName(_top(full, k).withColumn("proven", F.lit(False))))
    return out.select("window_start", "rank", F.when(F.col("item") != NO_ITEM, F.col("item")).alias("item"), "plays", "proven")


def _top(counted: DataFrame, k: int) -> DataFrame:
    order = [F.col("plays").desc(), (F.col("item") == NO_ITEM).asc(), F.col("item").asc()]
    return top_n_per_group(counted, ["window_start"], order, k, "item", rank_col="rank")
