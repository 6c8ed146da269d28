"""Publishing topic records: Kafka, or a landing folder partitioned by topic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import open_files

# Text files of so many topics are written side by side by one task, without sorting its rows by topic.
OPEN_TOPICS = 64
# Text is written compressed (a topic's records repeat most of their text), and compressed text is read by one task
# a file: a file holds at most so many records, further ones go to the next file.
LANDED_CODEC, FILE_RECORDS = "gzip", 500_000


def write_kafka(records: DataFrame, servers: str, extra: dict | None = None) -> None:
    """``topic, key, value`` rows to Kafka; the ``topic`` column routes each row."""
    w = records.select("topic", "key", "value").write.format("kafka") \
        .option("kafka.bootstrap.servers", servers)
    for k, v in (extra or {}).items():
        w = w.option(k, v)
    w.save()


def write_landing(records: DataFrame, root: str, fmt: str = "json") -> None:
    """Append ``topic, key, value`` rows (compressed JSON lines, or Parquet), one folder per topic."""
    text = fmt == "json"
    w = records.select("topic", "key", "value").write.mode("append").partitionBy("topic").format(fmt)
    if text:
        w = w.option("compression", LANDED_CODEC).option("maxRecordsPerFile", FILE_RECORDS)
    with open_files(records.sparkSession, OPEN_TOPICS if text else 0):
        w.save(root)
