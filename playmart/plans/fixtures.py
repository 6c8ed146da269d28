"""How the driver's tables stand in for the star schema and the play stream.

| star table   | driver table | columns                                                   |
|--------------|--------------|-----------------------------------------------------------|
| fact_history | lineitem     | played_at=l_shipdate, song_id=l_partkey,                  |
|              |              | album_id=l_orderkey, artist_id=l_suppkey,                 |
|              |              | duration_ms=CAST(l_quantity*10000 AS INT)                 |
| dim_song     | part         | song_id=p_partkey, song_name=p_name                       |
| dim_artist   | supplier     | artist_id=s_suppkey, artist_name=s_name                   |
| dim_album    | orders       | album_id=o_orderkey, album_name=o_orderpriority           |
| play stream  | events       | played_at=ts, song_id=props.k, artist name from user_id,  |
|              |              | album name=event_type, duration_ms=ROUND(value*1000)      |

All projections are lazy, so pruning and pushdown reach the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Star


# Declared schemas of the driver tables we read (no footer-based inference).
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fact_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_shipdate").alias("played_at"),
        F.col("l_partkey").alias("song_id"),
        F.col("l_orderkey").alias("album_id"),
        F.col("l_suppkey").alias("artist_id"),
        (F.col("l_quantity") * 10000).cast("int").alias("duration_ms"),
    )


def song_from_part(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("song_name"),
        (F.col("p_size") * 10000).alias("duration"),
        F.when(F.col("p_size") > 25, "True").otherwise("False").alias("explicit"),
        (F.col("p_size") * 2).alias("popularity"),
    )


def artist_from_supplier(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("artist_id"),
                           F.col("s_name").alias("artist_name"))


def album_from_orders(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("album_id"),
                         F.col("o_orderpriority").alias("album_name"))


def star(spark: SparkSession, sf_dir: str) -> Star:
    return Star(fact=fact_from_lineitem(table(spark, sf_dir, "lineitem")),
                song=song_from_part(table(spark, sf_dir, "part")),
                artist=artist_from_supplier(table(spark, sf_dir, "supplier")),
                album=album_from_orders(table(spark, sf_dir, "orders")))


def fact_as_of(spark: SparkSession, sf_dir: str):
    """The report clock for the fixtures: the latest play in the fact.

    Resolved once to a literal (a one-row aggregate), so the recency bound is
    a constant that Parquet row-group pruning can use.
    """
    return table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).first()[0]


def catalog_from_part(part: DataFrame, supplier: DataFrame | None = None) -> DataFrame:
    """Track catalogue rows drawn from ``part``.

    ``artists`` is written like a one-element list cell (``['Brand#7']``) so the
    stripping step has work to do; ``release_date`` and ``track_number`` are
    absent, so the producer defaults apply.
    """
    return part.select(
        F.col("p_partkey").cast("string").alias("track_id"),
        F.col("p_name").alias("track_name"),
        F.concat(F.lit("['"), F.col("p_brand"), F.lit("']")).alias("artists"),
        F.col("p_type").alias("album_name"),
        (F.col("p_size") * 10000).alias("duration_ms"),
        (F.col("p_size") > 25).alias("explicit"),
        (F.col("p_size") * 2).alias("popularity"),
    )


def wide_plays_from_lineitem(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Wide play events: each lineitem is a play of its part's catalogue track."""
    cat = catalog_from_part(part)
    plays = lineitem.select(F.col("l_partkey").cast("string").alias("track_id"),
                            F.col("l_shipdate").alias("played_ts"))
    return plays.join(cat, "track_id", "inner")


def wide_plays_from_events(events: DataFrame, part: DataFrame) -> DataFrame:
    """Wide play events from the ``events`` stream table.

    song = part ``props.k``; artist name from the user; album name = event type;
    the play lasts the track's duration (as the producer sends it).
    """
    ev = events.select(
        F.col("event_id"),
        F.col("ts").alias("played_ts"),
        F.get_json_object("props", "$.k").alias("track_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("artists"),
        F.col("event_type").alias("album_name"),
    )
    tracks = part.select(F.col("p_partkey").cast("string").alias("track_id"),
                         F.col("p_name").alias("track_name"),
                         (F.col("p_size") * 10000).alias("duration_ms"),
                         (F.col("p_size") > 25).alias("explicit"),
                         (F.col("p_size") * 2).alias("popularity"))
    return ev.join(tracks, "track_id", "inner")


# ------------------------------------------------------------ staged inputs
def item_values(events: DataFrame) -> DataFrame:
    """Play records from ``events`` as ``topic, key, value`` text rows.

    Damage injected for the decode checks (every row is kept): for
    ``event_id % 20 = 0`` the value is not JSON, for ``event_id % 20 = 10`` the
    ``song_id`` field is missing.
    """
    from ..functions.scalars import format_played_at
    song = F.get_json_object("props", "$.k")
    full = F.to_json(F.struct(
        format_played_at("ts", micros=True).alias("played_at"), song.alias("song_id"),
        F.col("event_type").alias("album_id"), F.col("user_id").cast("string").alias("artist_id"),
        F.round(F.col("value") * 1000).cast("int").alias("duration_ms")))
    no_key = F.to_json(F.struct(
        format_played_at("ts", micros=True).alias("played_at"),
        F.col("event_type").alias("album_id"), F.col("user_id").cast("string").alias("artist_id"),
        F.round(F.col("value") * 1000).cast("int").alias("duration_ms")))
    bucket = F.col("event_id") % 20
    value = (F.when(bucket == 0, F.lit("not json"))
             .when(bucket == 10, no_key).otherwise(full))
    return events.select(F.lit("item_topic").alias("topic"), song.alias("key"),
                         value.alias("value"))


def catalog_with_gaps(part: DataFrame) -> DataFrame:
    """Catalogue rows with ``track_name`` NULL where ``p_partkey % 10 = 0``."""
    cat = catalog_from_part(part)
    return cat.withColumn("track_name", F.when(
        F.col("track_id").cast("long") % 10 == 0, F.lit(None)).otherwise(F.col("track_name")))


def payload_documents(lineitem: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """One nested payload per order; items newest first, second artist ``guest``.

    Each document's items come from one order, so a document's size is bounded
    by the lines of one order.
    """
    from ..functions.scalars import format_played_at
    lines = (lineitem
             .join(part.select(F.col("p_partkey").alias("l_partkey"), "p_name"), "l_partkey")
             .join(supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey"))
    item = F.struct(
        F.struct((-F.unix_micros(F.col("l_shipdate").cast("timestamp"))).alias("t"),
                 "l_linenumber", "l_partkey", "l_suppkey", "l_quantity").alias("_k"),
        format_played_at("l_shipdate").alias("played_at"),
        F.struct(F.col("p_name").alias("name"),
                 F.array(F.struct(F.col("s_name").alias("name")),
                         F.struct(F.lit("guest").alias("name"))).alias("artists")).alias("track"))
    docs = lines.groupBy(F.col("l_orderkey").alias("payload_id")).agg(
        F.sort_array(F.collect_list(item)).alias("_items"))
    return docs.select("payload_id", F.transform("_items", lambda x: F.struct(
        x["played_at"].alias("played_at"), x["track"].alias("track"))).alias("items"))


def damaged_fact(lineitem: DataFrame) -> DataFrame:
    """The mapped fact with injected faults (every row kept).

    ``l_orderkey % 10``: 0 -> song key shifted out of the catalogue,
    1 -> artist key shifted, 2 -> album key shifted, 3 -> NULL song key,
    4 -> NULL play time.
    """
    shift = F.lit(1000000000)
    base = lineitem.select(
        (F.col("l_orderkey") % 10).alias("_b"),
        F.col("l_shipdate").alias("played_at"),
        F.col("l_partkey").alias("song_id"),
        F.col("l_orderkey").alias("album_id"),
        F.col("l_suppkey").alias("artist_id"),
        (F.col("l_quantity") * 10000).cast("int").alias("duration_ms"))
    return base.select(
        F.when(F.col("_b") == 4, F.lit(None)).otherwise(F.col("played_at")).alias("played_at"),
        F.when(F.col("_b") == 0, F.col("song_id") + shift)
         .when(F.col("_b") == 3, F.lit(None)).otherwise(F.col("song_id")).alias("song_id"),
        F.when(F.col("_b") == 2, F.col("album_id") + shift).otherwise(F.col("album_id")).alias("album_id"),
        F.when(F.col("_b") == 1, F.col("artist_id") + shift).otherwise(F.col("artist_id")).alias("artist_id"),
        "duration_ms")
