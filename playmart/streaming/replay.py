"""Replay of a stretch of time: the records that arrived in it, from retained files.

A landing stream may archive the files that it has read
(``landing_topic_stream(archive=...)``); a move keeps their time of arrival
(modification time).  A replay reads the files of a half-open stretch
[from, to) from the landing folder and the archive, and no others, and loads them
insert-if-absent, so a day's outage is made up for without reading
everything, and twice the same replay adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TOPIC_TABLE
from ..sinks.loader import Warehouse, load_table
from ..sinks.versions import Files
from ..sources.topics import archived_path, landing_path
from .consumers import FACT_ORDER, accepted, parsed_records


def arrived(spark: SparkSession, root: str, topic: str, start: str, end: str, archive: str | None = None,
            fmt: str = "json") -> DataFrame:
    """``topic, key, value`` rows of files with start <= time of arrival < end (texts in the session's zone)."""
    wanted = [landing_path(root, topic), *([archived_path(archive, root, topic)] if archive else [])]
    paths = [p for p in wanted if Files(spark, p).exists(p)]
    empty = spark.createDataFrame([], "topic string, key string, value string")
    if not paths:
        return empty
    # the reader's options are whole seconds, exclusive on both sides: the coarse cut by listing
    lo, hi = spark.range(1).select(*[
        F.date_format(F.lit(t).cast("timestamp") + F.expr(f"INTERVAL '{s}' SECOND"), "yyyy-MM-dd'T'HH:mm:ss")
        for t, s in ((start, -1), (end, 1))]).first()
    came = F.col("_metadata.file_modification_time")
    return (spark.read.schema("key STRING, value STRING").format(fmt)
            .option("modifiedAfter", lo).option("modifiedBefore", hi)
            .option("timeZone", spark.conf.get("spark.sql.session.timeZone"))
            .load(paths)
            .filter((came >= F.lit(start).cast("timestamp")) & (came < F.lit(end).cast("timestamp")))
            .select(F.lit(topic).alias("topic"), "key", "value"))


def replay_range(spark: SparkSession, wh: Warehouse, root: str, topic: str, start: str, end: str,
                 archive: str | None = None, strict: bool = False) -> int:
    """Load what arrived in the stretch and isn't in the topic's table; returns the rows added."""
    records = parsed_records(arrived(spark, root, topic, start, end, archive), topic, strict)
    name = f"replay-{start}-{end}".replace(" ", "T").replace(":", "")
    return load_table(accepted(records, topic), TOPIC_TABLE[topic], wh, name,
                      FACT_ORDER if topic == "item_topic" else ())
