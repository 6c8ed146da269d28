"""Nested "recently played" payloads landed as JSON documents.

One document per poll: ``{"items": [{"played_at", "track": {"name",
"artists": [{"name"}]}}]}``.  Flattening is a projection plus ``posexplode``:
each document is handled inside its own task, with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAYLOAD

def read_payloads(spark: SparkSession, path: str, extra: T.StructType | None = None,
                  multiline: bool = False) -> DataFrame:
    """Read landed payload documents with the nested schema.

    JSON lines by default (splittable); ``multiline=True`` reads one
    (possibly pretty-printed) document per file, as an API response is often
    saved - each file is then one task.
    """
    schema = PAYLOAD
    if extra is not None:
        schema = T.StructType(list(extra.fields) + list(PAYLOAD.fields))
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def _items(limit: int | None):
    # a missing ``items`` reads as an empty list; all items unless a limit is asked for
    items = F.coalesce(F.col("items"), F.array())
    return items if limit is None else F.slice(items, 1, limit)


def flatten_payload(payloads: DataFrame, limit: int | None = None,
                    id_cols: Sequence[str] = ()) -> DataFrame:
    """``pos, name, artist, played_at`` per item; ``artist`` is the first artist."""
    exploded = payloads.select(*id_cols, F.posexplode(_items(limit)).alias("_p", "_i"))
    return exploded.select(
        *id_cols,
        (F.col("_p") + 1).alias("pos"),
        F.col("_i.track.name").alias("name"),
        # ``get`` gives NULL for an empty artist list (``element_at`` would raise)
        F.get(F.col("_i.track.artists"), 0)["name"].alias("artist"),
        F.col("_i.played_at").alias("played_at"))


def payload_counts(payloads: DataFrame, limit: int | None = None,
                   id_cols: Sequence[str] = ()) -> DataFrame:
    """Number of items each payload yields (after the page limit)."""
    return payloads.select(*id_cols, F.size(_items(limit)).alias("count"))
