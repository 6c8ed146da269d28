"""Record and table contracts, each stated once.

Topic records are what the producer publishes (all fields nullable, as on the
wire); star tables are what the loader writes.  The star contracts carry the
key columns and maximum text lengths that the database DDL declared; plain
files do not enforce them, so ``operators.contracts`` checks them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SONG_RECORD = T.StructType([
    T.StructField("song_id", T.StringType()),
    T.StructField("song_name", T.StringType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("explicit", T.StringType()),
    T.StructField("popularity", T.IntegerType()),
])

ALBUM_RECORD = T.StructType([
    T.StructField("album_id", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("album_type", T.StringType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("total_tracks", T.IntegerType()),
])

ARTIST_RECORD = T.StructType([
    T.StructField("artist_id", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("external_url", T.StringType()),
])

PLAY_RECORD = T.StructType([
    T.StructField("played_at", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("album_id", T.StringType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("duration_ms", T.IntegerType()),
])

# Landing / Kafka row: what a topic reader yields.
TOPIC_ROW = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Track catalogue read from a delimited file with header.
CATALOG = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("artists", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("duration_ms", T.IntegerType()),
    T.StructField("explicit", T.BooleanType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("track_number", T.IntegerType()),
])

CATALOG_REQUIRED = ("track_id", "track_name", "artists", "album_name")

# Defaults the producer applies when a catalogue column is absent.
CATALOG_DEFAULTS = {
    "duration_ms": 200000,
    "explicit": False,
    "popularity": 50,
    "release_date": "2023-01-01",
    "track_number": 10,
}

# Nested "recently played" payload, one JSON document per poll.
PAYLOAD = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("played_at", T.StringType()),
        T.StructField("track", T.StructType([
            T.StructField("name", T.StringType()),
            T.StructField("artists", T.ArrayType(T.StructType([
                T.StructField("name", T.StringType()),
            ]))),
        ])),
    ]))),
])


@dataclass(frozen=True)
class TableContract:
    name: str
    keys: tuple[str, ...]           # unique business key
    not_null: tuple[str, ...]       # NOT NULL columns
    max_len: dict                   # column -> VARCHAR length


# Key columns and VARCHAR limits of the star schema.
DIM_SONG = TableContract("dim_song", ("song_id",), ("song_id",),
                         {"song_id": 100, "song_name": 300, "explicit": 10})
DIM_ALBUM = TableContract("dim_album", ("album_id",), ("album_id",),
                          {"album_id": 100, "album_name": 300, "album_type": 50,
                           "release_date": 20})
DIM_ARTIST = TableContract("dim_artist", ("artist_id",), ("artist_id",),
                           {"artist_id": 100, "artist_name": 300, "external_url": 500})
FACT_HISTORY = TableContract("fact_history", ("played_at", "song_id"), ("played_at",),
                             {"song_id": 100, "album_id": 100, "artist_id": 100})

CONTRACTS = {c.name: c for c in (DIM_SONG, DIM_ALBUM, DIM_ARTIST, FACT_HISTORY)}

# Topic names and which record each carries.
TOPICS = {
    "song_topic": SONG_RECORD,
    "album_topic": ALBUM_RECORD,
    "artist_topic": ARTIST_RECORD,
    "item_topic": PLAY_RECORD,
}
TOPIC_TABLE = {
    "song_topic": DIM_SONG,
    "album_topic": DIM_ALBUM,
    "artist_topic": DIM_ARTIST,
    "item_topic": FACT_HISTORY,
}
