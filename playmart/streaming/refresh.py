"""Report refresh: new versions of small report tables as the clock ticks.

The trigger is a clock (``clock_stream``: Spark's rate source, one batch per
trigger interval), so reports over the last 7 or 30 days age whether or not plays
arrive; a stream of plays can be the trigger instead.  Each tick computes the
reports as of its own time and publishes all of them together through one
pointer (``sinks.versions``): a reader never finds a report missing, half
written, or from another tick than its neighbour.

The reports come from any function of the tick's time: over the star itself
(``star_reports``), or from daily partials (``partials.report_tables``).
A tick that finds a star table not yet loaded leaves the last version in place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from ..operators import reports as R
from ..sinks.versions import VersionedTable
from ..sources.tables import Star
from .consumers import _trigger

#: Versions kept for readers that still hold an older pointer.
KEEP = 3


def clock_stream(spark: SparkSession) -> DataFrame:
    """``timestamp`` rows that come with time alone; the query's trigger interval sets the pace."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select("timestamp")


def staged_clock(spark: SparkSession, start_ms: int, advance_ms: int) -> DataFrame:
    """A clock for trial runs: every batch is one row, ``advance_ms`` after the one before."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1)
            .option("startTimestamp", start_ms).option("advanceMillisPerBatch", advance_ms).load().select("timestamp"))


def one_tick(spark: SparkSession) -> DataFrame:
    """A trigger of one row per ``availableNow`` run: refresh once, as of now."""
    return staged_clock(spark, 0, 1).select(F.lit(1).alias("tick"))


def report_tables(star: Star, as_of=None) -> dict[str, DataFrame]:
    return {
        "top_songs": R.top_songs(star, as_of, n=10),
        "top_artists": R.top_artists(star, as_of, n=10),
        "plays_by_weekday": R.plays_by_weekday(star.fact, as_of, 30),
        "totals": R.totals(star.fact, as_of, 7),
    }


def star_reports(star_reader: Callable[[], Star]) -> Callable[[str | None], dict[str, DataFrame]]:
    return lambda as_of: report_tables(star_reader(), as_of)


def start_report_refresh(trigger_stream: DataFrame, reports: Callable[[str | None], dict[str, DataFrame]],
                         out_root: str, checkpoint: str, query_name: str = "report_refresh",
                         as_of=None, processing_time: str | None = "60 seconds",
                         available_now: bool = False) -> StreamingQuery:
    """Publish ``reports(as_of)`` at every trigger that brings rows.

    as_of: a fixed time; else the latest ``timestamp`` of the batch if the trigger is a clock, else now.
    """
    table = VersionedTable(trigger_stream.sparkSession, out_root)
    ticks = "timestamp" in trigger_stream.columns

    def refresh(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        at = as_of
        if at is None:
            now = F.max("timestamp") if ticks else F.current_timestamp()
            at = batch.agg(F.date_format(now, "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
        try:
            table.replace(reports(at))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return          # a star table is not loaded yet: the next trigger refreshes
        table.vacuum(KEEP)

    w = (trigger_stream.writeStream.queryName(query_name)
         .option("checkpointLocation", checkpoint).foreachBatch(refresh))
    return _trigger(w, available_now, None if available_now else processing_time).start()


def read_report(spark: SparkSession, out_root: str, name: str) -> DataFrame | None:
    """The current version of a report, None before the first refresh."""
    return VersionedTable(spark, out_root).read(name)
