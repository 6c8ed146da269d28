"""Wide play event -> four topic records (song, album, artist, play).

A wide event is one catalogue row plus its play time.  The four record kinds
are built as structs and emitted in one pass with ``explode`` over a 4-element
array: map-only, no shuffle, and the ``topic`` column routes each row (the
Kafka sink's own contract, or ``partitionBy("topic")`` for a landing folder).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (bool_label, encode_utf8, format_played_at, stable_key,
                                 strip_chars, to_int, url_from_id)
from ..schemas import CATALOG, CATALOG_DEFAULTS

# The literal album type the producer sends and the id prefixes.
ALBUM_TYPE = "album"
ALBUM_PREFIX = "album_"
ARTIST_PREFIX = "artist_"
DEFAULT_ARTIST_URL = "https://open.example.com/artist/"


def with_defaults(df: DataFrame, defaults: dict = CATALOG_DEFAULTS,
                  fill_nulls: bool = False) -> DataFrame:
    """Add each absent column with its default; ``fill_nulls`` also fills NULL cells."""
    types = {f.name: f.dataType for f in CATALOG.fields}
    out = df
    for name, value in defaults.items():
        lit = F.lit(value)
        if name in types:
            lit = lit.cast(types[name])
        if name not in df.columns:
            out = out.withColumn(name, lit)
        elif fill_nulls:
            out = out.withColumn(name, F.coalesce(F.col(name), lit))
    return out


def with_keys(w: DataFrame) -> DataFrame:
    """Add the record keys once per wide row (each is used by two record kinds)."""
    return w.withColumns({
        "_song_id": F.col("track_id").cast("string"),
        # keys come from the raw text, as the producer hashes the raw cell
        "_album_id": stable_key(ALBUM_PREFIX, F.col("album_name")),
        "_artist_id": stable_key(ARTIST_PREFIX, F.col("artists")),
    })


def _keys(w: DataFrame) -> dict[str, Column]:
    return {"song_id": F.col("_song_id"), "album_id": F.col("_album_id"),
            "artist_id": F.col("_artist_id")}


def song_record(w: DataFrame) -> Column:
    k = _keys(w)
    return F.struct(k["song_id"].alias("song_id"),
                    F.col("track_name").cast("string").alias("song_name"),
                    to_int(F.col("duration_ms")).alias("duration"),
                    bool_label(F.col("explicit")).alias("explicit"),
                    to_int(F.col("popularity")).alias("popularity"))


def album_record(w: DataFrame) -> Column:
    k = _keys(w)
    return F.struct(k["album_id"].alias("album_id"),
                    F.col("album_name").cast("string").alias("album_name"),
                    F.lit(ALBUM_TYPE).alias("album_type"),
                    F.col("release_date").cast("string").alias("release_date"),
                    to_int(F.col("track_number")).alias("total_tracks"))


def artist_record(w: DataFrame, url_base: str = DEFAULT_ARTIST_URL) -> Column:
    k = _keys(w)
    return F.struct(k["artist_id"].alias("artist_id"),
                    strip_chars(F.col("artists").cast("string")).alias("artist_name"),
                    url_from_id(url_base, k["artist_id"]).alias("external_url"))


def play_record(w: DataFrame, ts_col: str = "played_ts") -> Column:
    k = _keys(w)
    return F.struct(format_played_at(F.col(ts_col)).alias("played_at"),
                    k["song_id"].alias("song_id"),
                    k["album_id"].alias("album_id"),
                    k["artist_id"].alias("artist_id"),
                    to_int(F.col("duration_ms")).alias("duration_ms"))


RECORDS = {
    "song_topic": ("song_id", song_record),
    "album_topic": ("album_id", album_record),
    "artist_topic": ("artist_id", artist_record),
    "item_topic": ("song_id", play_record),
}


def topic_records(wide: DataFrame, topic: str, as_json: bool = True) -> DataFrame:
    """``key, value`` rows of one topic (value as JSON text, or as a struct)."""
    wide = with_keys(with_defaults(wide))
    key_field, build = RECORDS[topic]
    rec = build(wide)
    return wide.select(rec[key_field].alias("key"),
                       (F.to_json(rec) if as_json else rec).alias("value"))


def fanout(wide: DataFrame, topics=tuple(RECORDS), keep=()) -> DataFrame:
    """All record kinds in one pass: ``topic, key, value`` (value = JSON text).

    ``keep`` passes columns of the wide event through (e.g. its event time).
    """
    wide = with_keys(with_defaults(wide))
    entries = []
    for t in topics:
        key_field, build = RECORDS[t]
        rec = build(wide)
        entries.append(F.struct(F.lit(t).alias("topic"), rec[key_field].alias("key"),
                                F.to_json(rec).alias("value")))
    return wide.select(*keep, F.explode(F.array(*entries)).alias("r")).select(*keep, "r.*")


def encode_records(rows: DataFrame) -> DataFrame:
    """Text key/value -> UTF-8 bytes, as the producer's serializers send them."""
    return rows.select("topic", encode_utf8("key").alias("key"),
                       encode_utf8("value").alias("value"))
