"""Topic sources: Kafka, or a landing folder with the same ``topic, key, value`` rows.

The landing folder is what an upstream writer (``sinks.topics.write_landing``)
lays out: compressed JSON lines (plain ones are read too) partitioned by ``topic``.  A streaming read of one topic
reads ``<root>/topic=<name>``; a replay reads it again as a batch, or as a
stream under a fresh checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(servers: str, topic: str, starting_offsets: str = "latest",
                  extra: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": starting_offsets}
    opts.update(extra or {})
    return opts


def kafka_topic_stream(spark: SparkSession, servers: str, topic: str,
                       starting_offsets: str = "latest", extra: dict | None = None) -> DataFrame:
    """``topic, key, value`` text rows from Kafka (needs the Kafka connector jar)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(servers, topic, starting_offsets, extra).items():
        reader = reader.option(k, v)
    return reader.load().select("topic", F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"))


def kafka_topic_batch(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "earliest", ending_offsets: str = "latest",
                      extra: dict | None = None) -> DataFrame:
    """Replay what the topic retains as a batch (``topic, key, value`` text rows)."""
    reader = spark.read.format("kafka")
    opts = kafka_options(servers, topic, starting_offsets, extra)
    opts["endingOffsets"] = ending_offsets
    for k, v in opts.items():
        reader = reader.option(k, v)
    return reader.load().select("topic", F.col("key").cast("string").alias("key"),
                                F.col("value").cast("string").alias("value"))


def landing_path(root: str, topic: str) -> str:
    return f"{root.rstrip('/')}/topic={topic}"


def archived_path(archive: str, root: str, topic: str) -> str:
    """Where the files of a topic lie once they are archived: their whole path below the archive."""
    path = landing_path(root, topic)
    if "://" in path:
        path = "/" + path.split("://", 1)[1].split("/", 1)[1]
    elif path.startswith("file:"):
        path = path[5:]
    return archive.rstrip("/") + path


def landing_topic_stream(spark: SparkSession, root: str, topic: str,
                         max_files_per_trigger: int | None = None,
                         fmt: str = "json", archive: str | None = None) -> DataFrame:
    """Streaming ``topic, key, value`` rows from a landing folder (JSON lines or Parquet).

    ``archive``: files that a committed batch has read are moved below this folder, so the
    landing folder stays short to list and nothing is lost to a replay.
    """
    reader = spark.readStream.schema("key STRING, value STRING").format(fmt)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(landing_path(root, topic))
            .select(F.lit(topic).alias("topic"), "key", "value"))


def landing_topic_batch(spark: SparkSession, root: str, topic: str,
                        fmt: str = "json") -> DataFrame:
    """The same rows as a batch (a replay of everything retained)."""
    return (spark.read.schema("key STRING, value STRING").format(fmt)
            .load(landing_path(root, topic))
            .select(F.lit(topic).alias("topic"), "key", "value"))
