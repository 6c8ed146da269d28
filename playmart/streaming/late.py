"""Late plays set aside, and counted, before a stateful operator drops them unseen.

A stateful query drops what lies behind its watermark without a trace.  The
router is a stateless query in front of it: per batch it splits the plays into
rejected, late and passed ones.  Late is what the watermark of the batches before
rules out (the latest play so far less the delay, kept per batch beside the
checkpoint, so a replayed batch is split as it was).  Late and rejected records go to
the dead letters with their reason, passed ones to a folder that the stateful
query reads.  That query may take several routed batches at once, so its own
watermark is never ahead of the router's, and it drops nothing more.

``accounting``: read = rejected + late + loaded + copies.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_within_watermark
from ..schemas import FACT_HISTORY, TOPICS
from ..sinks.loader import METRICS, Warehouse
from ..sinks.versions import Files
from . import consumers as SC
from .panes import seconds

TOPIC = "item_topic"
ROUTED, ROUTING = "_routed", "_routing"
COUNTS = ("read", "rejected", "late", "passed")


class HighWater:
    """The latest event time (milliseconds) up to each batch of a query."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.files = Files(spark, f"{checkpoint.rstrip('/')}-high")

    def before(self, batch_id: int) -> int | None:
        names = [n for n in self.files.names(self.files.root) if n.endswith(".json") and int(n.split(".")[0]) < batch_id]
        return json.loads(self.files.read(f"{self.files.root}/{names[-1]}")) if names else None

    def put(self, batch_id: int, millis: int) -> None:
        path = f"{self.files.root}/{batch_id:012d}.json"
        if self.files.exists(path):
            return                       # the batch is replayed
        self.files.make(self.files.root)
        self.files.write(path, json.dumps(millis))
        for old in self.files.names(self.files.root)[:-3]:
            self.files.delete(f"{self.files.root}/{old}")


def start_router(raw_stream: DataFrame, wh: Warehouse, checkpoint: str, query_name: str = "route_plays",
                 delay: str = "1 hour", available_now: bool = True, processing_time: str | None = None,
                 strict: bool = False) -> StreamingQuery:
    """Split plays of a topic stream: passed ones to ``<root>/_routed``, the others to the dead letters."""
    spark = raw_stream.sparkSession
    high = HighWater(spark, checkpoint)
    cols = TOPICS[TOPIC].fieldNames()
    Files(spark, wh.root).make(f"{wh.root}/{ROUTED}")

    def route(batch: DataFrame, batch_id: int) -> None:
        before = high.before(batch_id)
        bound = None if before is None else before - 1000 * seconds(delay)
        at = F.unix_millis(F.col("played_at"))
        late = F.lit(False) if bound is None else at <= F.lit(bound)
        batch = batch.withColumn("_reason", F.coalesce("_reject", F.when(late, F.lit("late")))).persist()
        try:
            rows, bad, behind, top = batch.agg(
                F.count(F.lit(1)), F.count("_reject"), F.count_if(F.col("_reason") == "late"),
                F.max(F.when(F.col("_reject").isNull(), at))).first()
            if not rows:
                return
            if bad or behind:
                (batch.filter(F.col("_reason").isNotNull())
                 .select(F.col("value").alias("raw_value"), F.col("_reason").alias("reason"))
                 .write.mode("overwrite").parquet(f"{wh.root}/{SC.REJECTS}/topic={TOPIC}/batch_id={query_name}-{batch_id}"))
            (batch.filter(F.col("_reason").isNull()).select(*cols)
             .write.mode("overwrite").parquet(f"{wh.root}/{ROUTED}/batch_id={query_name}-{batch_id}"))
            (spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in zip(
                COUNTS, (rows, bad, behind, rows - bad - behind), strict=True)])
             .write.mode("overwrite").parquet(f"{wh.root}/{ROUTING}/batch_id={query_name}-{batch_id}"))
            if top is not None:
                high.put(batch_id, top if before is None else max(top, before))
        finally:
            batch.unpersist()

    w = (SC.parsed_records(raw_stream, TOPIC, strict).writeStream.queryName(query_name)
         .option("checkpointLocation", checkpoint).foreachBatch(route))
    return SC._trigger(w, available_now, processing_time).start()


def start_routed_load(spark: SparkSession, wh: Warehouse, checkpoint: str, query_name: str = "load_routed_plays",
                      delay: str = "1 hour", available_now: bool = True,
                      processing_time: str | None = None) -> StreamingQuery:
    """Load what the router passed, de-duplicated within the watermark."""
    schema = ", ".join(f"{f} {'timestamp' if f == 'played_at' else TOPICS[TOPIC][f].dataType.simpleString()}"
                       for f in TOPICS[TOPIC].fieldNames())
    plays = (spark.readStream.schema(schema + ", batch_id string").parquet(f"{wh.root}/{ROUTED}").drop("batch_id"))
    handler = SC.topic_batch_handler(TOPIC, wh, query_name, already_accepted=True)
    w = (dedup_within_watermark(plays, FACT_HISTORY.keys, "played_at", delay).writeStream.queryName(query_name)
         .option("checkpointLocation", checkpoint).foreachBatch(handler))
    return SC._trigger(w, available_now, processing_time).start()


def accounting(wh: Warehouse) -> DataFrame:
    """One row: read, rejected, late, loaded, copies of all routed plays."""
    routed = wh.read(ROUTING).agg(*[F.sum(c).alias(c) for c in COUNTS])
    loads = wh.read(f"{METRICS}/table_name={FACT_HISTORY.name}")
    if loads is None:
        return routed.select("read", "rejected", "late", F.lit(0).cast("long").alias("loaded"),
                             F.col("passed").alias("copies"))
    loaded = loads.agg(F.sum("rows_new").alias("loaded"))
    one = F.lit(0).alias("_one")
    return (routed.select("*", one).join(loaded.select("*", one), "_one")
            .select("read", "rejected", "late", "loaded", (F.col("passed") - F.col("loaded")).alias("copies")))
