"""Rolling KPIs on the live play stream (windowed streaming aggregates).

Input is a stream of *unique* plays: the loaded fact table read as a stream
(``fact_stream``).  Its loader already removed copies of a play with a
partial aggregate (map-side, so a play re-sent many times never piles up in
one task), and a replayed batch adds no files, so nothing is counted twice.
For raw topic input, ``dedup=True`` puts a watermark-bounded dedup in front.

The aggregates run in ``update`` mode with a watermark (streaming
aggregation is partial + final, so a hot song is also combined map-side), and
state for closed windows is dropped.  Each micro-batch's changed rows are appended to an
update log (``<out>/batch_id=N``, overwritten on a replay of N); readers take
the latest version of each key with ``max_by`` over the batch id - a
partial aggregate, no full-table rewrite per batch.  Ranking (top-N per
window) is done by the reader: ``row_number`` is refused on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.topn import top_n_per_group
from .consumers import _trigger


def windowed(plays: DataFrame, size: str = "1 day", slide: str | None = None) -> F.Column:
    return F.window("played_at", size, slide) if slide else F.window("played_at", size)


def unique_plays(plays: DataFrame, delay: str = "1 hour",
                 keys=("played_at", "song_id")) -> DataFrame:
    """Each play once, even when a batch is re-sent: dedup on the play key.

    The key holds the event time, so the watermark evicts its state; a copy
    that arrives later than the watermark is dropped as late.
    """
    return plays.withWatermark("played_at", delay).dropDuplicates(list(keys))


def fact_stream(spark: SparkSession, fact_path: str, schema=None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The loaded fact folder as a stream of unique plays (new files only)."""
    if schema is None:
        schema = spark.read.parquet(fact_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(fact_path)


def rolling_metrics(plays: DataFrame, group_col: str | None, size: str = "1 day",
                    slide: str | None = None, delay: str = "1 hour",
                    dedup: bool = False) -> DataFrame:
    """plays and listening_ms per (window, group) on a stream of plays."""
    w = windowed(plays, size, slide)
    g = [w.alias("w")] + ([F.col(group_col)] if group_col else [])
    src = unique_plays(plays, delay) if dedup else plays.withWatermark("played_at", delay)
    return (src.groupBy(*g)
            .agg(F.count(F.lit(1)).alias("plays"),
                 F.sum("duration_ms").cast("long").alias("listening_ms"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *([group_col] if group_col else []), "plays", "listening_ms"))


def rolling_kpis(plays: DataFrame, group_cols=("song_id", "album_id", "artist_id"),
                 size: str = "1 day", slide: str | None = None, delay: str = "1 hour",
                 dedup: bool = False) -> DataFrame:
    """All rolling breakdowns in one streaming aggregation (grouping sets).

    Per window: plays and listening_ms per song, per album, per artist and in
    total - one read of the stream and one state store instead of one query
    per breakdown.  Rows: ``window_start, window_end, grouping, key, plays,
    listening_ms`` where ``grouping`` names the grouped column (``total`` for
    the window total) and ``key`` is its value as text.
    """
    g = list(group_cols)
    w = windowed(plays, size, slide)
    src = unique_plays(plays, delay) if dedup else plays.withWatermark("played_at", delay)
    sets = [[w, c] for c in g] + [[w]]
    agg = (src.groupingSets(sets, w, *g)
           .agg(F.count(F.lit(1)).alias("plays"),
                F.sum("duration_ms").cast("long").alias("listening_ms"),
                F.grouping_id().alias("_gid")))
    # grouping_id bits follow (window, *group_cols); a grouped column's bit is 0
    full = (1 << len(g)) - 1
    name = F.lit("total")
    key = F.lit(None).cast("string")
    for i, c in enumerate(g):
        bit = 1 << (len(g) - 1 - i)
        name = F.when(F.col("_gid") == (full ^ bit), F.lit(c)).otherwise(name)
        key = F.when(F.col("_gid") == (full ^ bit), F.col(c).cast("string")).otherwise(key)
    first = agg.columns[0]
    return agg.select(F.col(f"{first}.start").alias("window_start"),
                      F.col(f"{first}.end").alias("window_end"),
                      name.alias("grouping"), key.alias("key"), "plays", "listening_ms")


def kpi(log: DataFrame, grouping: str, key_name: str | None = None) -> DataFrame:
    """One breakdown out of the current ``rolling_kpis`` values."""
    out = log.filter(F.col("grouping") == grouping).drop("grouping")
    return out.drop("key") if key_name is None else out.withColumnRenamed("key", key_name)


def distinct_per_window(item_counts: DataFrame, window_col: str = "window_start") -> DataFrame:
    """Exact distinct items per window, from the per-(window, item) counts.

    Each item with plays in a window has exactly one row there, so counting
    rows is an exact distinct count - no per-item dedup state on the stream.
    """
    return item_counts.groupBy(window_col).agg(F.count(F.lit(1)).alias("distinct_items"))


def start_update_log(agg: DataFrame, out: str, checkpoint: str, query_name: str,
                     available_now: bool = True,
                     processing_time: str | None = None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        # computed once (the batch comes out of a stateful aggregation), then
        # checked and written from the copy
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = (agg.writeStream.queryName(query_name).outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(write))
    return _trigger(w, available_now, processing_time).start()


def read_latest(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Current value per key from the update log."""
    log = spark.read.parquet(out)
    rest = [c for c in log.columns if c not in keys and c != "batch_id"]
    latest = F.max_by(F.struct(*rest), F.col("batch_id"))
    return log.groupBy(*keys).agg(latest.alias("_v")).select(*keys, *[f"_v.{c}" for c in rest])


def top_per_window(counts: DataFrame, item_col: str, n: int = 5,
                   window_col: str = "window_start") -> DataFrame:
    """Top ``n`` items per window by plays, ties broken by the item id.

    Two-stage (salted) top-N: a busy window is spread over many tasks.
    """
    order = [F.col("plays").desc(), F.col(item_col).asc_nulls_last()]
    return top_n_per_group(counts, [window_col], order, n, item_col, rank_col="rank")
