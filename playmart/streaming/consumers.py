"""Topic consumers: parse, set bad records aside, de-duplicate, load the star.

One streaming query per topic, each with its own name and checkpoint folder
(the checkpoint holds the source offsets and any dedup state, and belongs to
exactly one query).  De-duplication modes:

* ``"table"`` (default): no stream state; the loader's anti-join against the
  target table is the cross-batch dedup, and rejects are written in the same
  ``foreachBatch``.
* ``"state"``: ``dropDuplicates(keys)`` in the stream (the reference's
  behaviour), unbounded state - fine for dimensions.
* ``"watermark"``: ``dropDuplicatesWithinWatermark`` on the event time,
  bounded state - for the fact stream.

With a state mode the streaming plan keeps accepted rows only; rejects then
need ``start_reject_sink`` (a second, stateless query on the same source).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.decode import CORRUPT, classify, parse_values
from ..operators.dedup import dedup_stream, dedup_within_watermark
from ..schemas import TOPIC_TABLE, TOPICS
from ..session import shuffle_width
from ..sinks.loader import Warehouse, load_table

# Survivor tie-break for duplicate plays (fixed so replays pick the same row).
FACT_ORDER = ("album_id", "artist_id", "duration_ms")
# Dead letters below a warehouse's root: of table mode, and of the state modes.
REJECTS, STREAM_REJECTS = "_rejects", "_rejects_stream"


def parsed_records(raw: DataFrame, topic: str, strict: bool = False) -> DataFrame:
    """Typed record columns plus ``_reject`` (NULL when accepted) and raw ``value``.

    Only a column that the table declares NOT NULL can reject a record; a field
    of the wrong type is NULL, unless ``strict`` rejects it too.
    """
    schema = TOPICS[topic]
    keys = TOPIC_TABLE[topic].not_null
    parsed = parse_values(raw, schema, "value", keep=("value",))
    if topic == "item_topic":
        # parse the text time before the key check: bad text is a NULL key part
        parsed = parsed.withColumn("played_at", F.try_to_timestamp("played_at"))
    return classify(parsed, schema, keys, strict)


def accepted(parsed: DataFrame, topic: str) -> DataFrame:
    cols = TOPICS[topic].fieldNames()
    return parsed.filter(F.col("_reject").isNull()).select(*cols)


def _with_dedup(recs: DataFrame, topic: str, dedup: str, delay: str) -> DataFrame:
    keys = TOPIC_TABLE[topic].keys
    if dedup == "state":
        return dedup_stream(recs, keys)
    if dedup == "watermark":
        return dedup_within_watermark(recs, keys, "played_at", delay)
    return recs


def topic_batch_handler(topic: str, wh: Warehouse, query_name: str, write_rejects: bool = True,
                        already_accepted: bool = False):
    contract = TOPIC_TABLE[topic]
    order = FACT_ORDER if topic == "item_topic" else ()

    def handle(batch: DataFrame, batch_id: int) -> None:
        if already_accepted:
            load_table(batch, contract, wh, f"{query_name}-{batch_id}", order)
            return
        # the copy holds the typed columns, and the text of what goes to the dead letters only
        batch = (batch.withColumn("value", F.when(F.col("_reject").isNotNull(), F.col("value")))
                 .drop(CORRUPT).persist())
        try:
            # one read of the source, then the copy
            rows, bad = batch.agg(F.count(F.lit(1)), F.count("_reject")).first()
            if write_rejects and bad:
                (batch.filter(F.col("_reject").isNotNull())
                 .select(F.col("value").alias("raw_value"), F.col("_reject").alias("reason"))
                 .write.mode("overwrite").parquet(
                     f"{wh.root}/{REJECTS}/topic={topic}/batch_id={query_name}-{batch_id}"))
            load_table(accepted(batch, topic), contract, wh, f"{query_name}-{batch_id}", order,
                       rows_in=rows - bad)
        finally:
            batch.unpersist()
    return handle


def read_rejects(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """topic, raw_value, reason: the dead letters of a warehouse, whichever mode wrote them.

    Table mode writes a folder per batch, the state modes a file sink whose log would hide
    other files, hence two folders.
    """
    wh = Warehouse(spark, root)
    out = spark.createDataFrame([], "topic string, raw_value string, reason string")
    for folder in (REJECTS, STREAM_REJECTS):
        for t in TOPICS if topic is None else [topic]:
            found = wh.read(f"{folder}/topic={t}")
            if found is not None:
                out = out.unionByName(found.select(F.lit(t).alias("topic"), "raw_value", "reason"))
    return out


def start_topic_load(raw_stream: DataFrame, topic: str, wh: Warehouse, checkpoint: str,
                     query_name: str, dedup: str = "table", delay: str = "1 hour",
                     available_now: bool = True, processing_time: str | None = None,
                     shuffle_partitions: int | None = None, strict: bool = False,
                     write_rejects: bool = True) -> StreamingQuery:
    """Start the consumer of one topic into its star table."""
    parsed = parsed_records(raw_stream, topic, strict)
    if dedup == "table":
        frame, handler = parsed, topic_batch_handler(topic, wh, query_name, write_rejects)
    else:
        frame = _with_dedup(accepted(parsed, topic), topic, dedup, delay)
        handler = topic_batch_handler(topic, wh, query_name, already_accepted=True)
    w = (frame.writeStream.queryName(query_name).outputMode("append")
         .option("checkpointLocation", checkpoint).foreachBatch(handler))
    w = _trigger(w, available_now, processing_time)
    with shuffle_width(frame.sparkSession, shuffle_partitions):
        return w.start()


def start_reject_sink(raw_stream: DataFrame, topic: str, out: str, checkpoint: str,
                      query_name: str, available_now: bool = True, strict: bool = False,
                      processing_time: str | None = None) -> StreamingQuery:
    """Stateless dead-letter query: rejected raw values with their reason."""
    rej = (parsed_records(raw_stream, topic, strict).filter(F.col("_reject").isNotNull())
           .select(F.col("value").alias("raw_value"), F.col("_reject").alias("reason")))
    w = (rej.writeStream.queryName(query_name).format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, available_now, processing_time).start()


def start_append(frame: DataFrame, out: str, checkpoint: str, query_name: str,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Stateless append to a Parquet folder (file sink: exactly-once via its log).

    Rows written per micro-batch are observed (``observe``) and arrive with
    each progress event as the ``rows_written`` metric.
    """
    frame = frame.observe(f"{query_name}_out", F.count(F.lit(1)).alias("rows_written"))
    w = (frame.writeStream.queryName(query_name).format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", checkpoint))
    return _trigger(w, available_now, processing_time).start()


def _trigger(w, available_now: bool, processing_time: str | None):
    if processing_time:
        return w.trigger(processingTime=processing_time)
    if available_now:
        return w.trigger(availableNow=True)
    return w


def run_to_end(queries: list[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries to finish; re-raise a query failure."""
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name} failed: {q.exception()}")


def start_star_load(spark: SparkSession, source, wh: Warehouse, checkpoint_root: str,
                    prefix: str = "load", dedup_dims: str = "table",
                    dedup_fact: str = "table", available_now: bool = True,
                    processing_time: str | None = None) -> list[StreamingQuery]:
    """Four consumers (song, album, artist, play) into the star; one checkpoint each.

    With ``available_now=False`` they go on running, batch after batch or every
    ``processing_time``.

    ``source(topic) -> streaming DataFrame`` supplies ``topic, key, value`` rows
    (Kafka or a landing folder).
    """
    out = []
    for topic in TOPICS:
        mode = dedup_fact if topic == "item_topic" else dedup_dims
        name = f"{prefix}_{topic}"
        out.append(start_topic_load(source(topic), topic, wh,
                                    f"{checkpoint_root.rstrip('/')}/{name}", name, dedup=mode,
                                    available_now=available_now, processing_time=processing_time))
    return out
