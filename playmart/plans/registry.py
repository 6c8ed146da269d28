"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each reads the driver's tables (through ``plans.fixtures``) and runs the
library operator on them, over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import digest as G
from ..functions import scalars as S
from ..operators import decode as D
from ..operators import fanout as FO
from ..operators import reports as R
from ..operators.contracts import check_star
from ..operators.dedup import dedup_batch
from ..operators.joins import new_rows_only, unmatched_fact_rows
from ..schemas import CATALOG_REQUIRED, CONTRACTS, DIM_SONG, FACT_HISTORY, PLAY_RECORD
from ..session import apply_job_conf, ensure_checkpoint_dir, scratch_dir
from ..sinks import loader as L
from ..sources import catalog as C
from ..sources import payload as P
from ..streaming import consumers as SC
from ..streaming import late as LT
from ..streaming import panes as PN
from ..streaming import partials as PT
from ..streaming import refresh as RF
from ..streaming import rolling as RL
from ..streaming import topk as TK
from . import fixtures as X
from . import streams as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_job_conf(spark)
            ensure_checkpoint_dir(spark)     # the session's, or a test-only one if unset
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _star_asof(spark, sf_dir):
    return X.star(spark, sf_dir), X.fact_as_of(spark, sf_dir)


# ---------------------------------------------------------------- reports
@register("top_songs_week")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.top_songs(s, a, n=5)


@register("top_artists_week")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.top_artists(s, a, n=5)


@register("top10_songs_week")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.top_songs(s, a, n=10)


@register("top10_artists_week")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.top_artists(s, a, n=10)


@register("plays_by_song")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.plays_by_name(s.fact, s.song, "song_id", "song_name", a, 7)


@register("plays_by_artist")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.plays_by_name(s.fact, s.artist, "artist_id", "artist_name", a, 7)


@register("totals_week")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.totals(s.fact, a, 7)


@register("listening_minutes")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.listening_minutes(s.fact, a, 7)


@register("plays_by_weekday")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.plays_by_weekday(s.fact, a, 30)


@register("weekday_padded")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.plays_by_weekday(s.fact, a, 30, padded=True)


@register("listening_hours_by_day")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.listening_hours_by_day(s.fact, a, 30)


@register("recent_plays")
def _q(spark, d):
    return R.recent_plays(X.star(spark, d), n=20)


@register("latest_events")
def _q(spark, d):
    return R.latest_events(X.star(spark, d).fact)


@register("weekly_stats")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.explode_stats(R.weekly_stats(s, a, n=5))


@register("headline_top_song")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.headline_top_song(R.weekly_stats(s, a, n=5))


# ------------------------------------------------- decode, quarantine, time


def _items(spark, d):
    return X.item_values(X.table(spark, d, "events"))


@register("decode_json_records")
def _q(spark, d):
    return D.decode_records(_items(spark, d), PLAY_RECORD)


@register("parse_played_at")
def _q(spark, d):
    rec = D.with_parsed_time(D.decode_records(_items(spark, d), PLAY_RECORD))
    return rec.select(F.col("played_at").cast("timestamp_ntz").alias("played_at"),
                      "song_id", "duration_ms")


@register("quarantine_bad_records")
def _q(spark, d):
    rows = _items(spark, d)
    # one parse, one aggregate: accepted and each reject reason counted together
    parsed = D.classify(D.parse_values(rows, PLAY_RECORD), PLAY_RECORD, ("song_id",))
    return (parsed.groupBy(F.coalesce("_reject", F.lit("accepted")).alias("status"))
            .agg(F.count(F.lit(1)).alias("rows")))


# ---------------------------------------------------------------- scalars


@register("format_played_at")
def _q(spark, d):
    f = X.star(spark, d).fact
    return f.select("played_at", S.format_played_at("played_at").alias("played_at_text"))


@register("bool_label")
def _q(spark, d):
    cat = X.catalog_from_part(X.table(spark, d, "part"))
    return cat.select("track_id", S.bool_label("explicit").alias("explicit_label"))


@register("truncate_to_int")
def _q(spark, d):
    ev = X.table(spark, d, "events")
    return ev.select("event_id", S.to_int("value").alias("value_int"),
                     S.to_int(F.get_json_object("props", "$.k")).alias("k_int"),
                     S.to_int(F.col("event_type")).alias("type_int"))


@register("stable_keys")
def _q(spark, d):
    cat = X.catalog_from_part(X.table(spark, d, "part"))
    albums = cat.select(F.lit("album").alias("kind"), F.col("album_name").alias("name"),
                        S.stable_key("album_", "album_name").alias("key"))
    artists = cat.select(F.lit("artist").alias("kind"), F.col("artists").alias("name"),
                         S.stable_key("artist_", "artists").alias("key"))
    return albums.unionByName(artists).distinct()


@register("strip_char_set")
def _q(spark, d):
    cat = X.catalog_from_part(X.table(spark, d, "part"))
    return cat.select("track_id", S.strip_chars("artists").alias("artist_name"))


# ---------------------------------------------------------------- fan-out


def _wide(spark, d):
    return X.wide_plays_from_lineitem(X.table(spark, d, "lineitem"), X.table(spark, d, "part"))


@register("fanout_all_topics")
def _q(spark, d):
    return FO.fanout(_wide(spark, d))


for _topic, _key in (("song_topic", "fanout_song_records"), ("album_topic", "fanout_album_records"),
                     ("artist_topic", "fanout_artist_records"),
                     ("item_topic", "fanout_play_records")):
    register(_key)(lambda spark, d, _t=_topic: FO.topic_records(_wide(spark, d), _t))


@register("encode_records")
def _q(spark, d):
    enc = FO.encode_records(FO.fanout(_wide(spark, d)))
    return enc.select("topic", F.hex("key").alias("key_hex"),
                      F.md5("value").alias("value_md5"))


@register("default_missing_columns")
def _q(spark, d):
    cat = FO.with_defaults(X.catalog_from_part(X.table(spark, d, "part")))
    return cat.select("track_id", "duration_ms", "explicit", "popularity",
                      "release_date", "track_number")


# -------------------------------------------------------------- catalogue


def _catalog_csv(spark, d):
    path = scratch_dir(spark, "catalog-csv")
    X.catalog_with_gaps(X.table(spark, d, "part")).write.option("header", True) \
        .option("escape", '"').csv(path)
    return C.read_catalog_csv(spark, path)


@register("scan_csv_catalog")
def _q(spark, d):
    return _catalog_csv(spark, d)


@register("drop_incomplete_rows")
def _q(spark, d):
    return C.drop_incomplete(_catalog_csv(spark, d), CATALOG_REQUIRED)


# ---------------------------------------------------------------- payload


def _payloads(spark, d):
    path = scratch_dir(spark, "payload-json")
    X.payload_documents(X.table(spark, d, "lineitem"), X.table(spark, d, "part"),
                        X.table(spark, d, "supplier")).write.json(path)
    return P.read_payloads(spark, path, T.StructType([T.StructField("payload_id", T.LongType())]))


@register("flatten_nested_payload")
def _q(spark, d):
    return P.flatten_payload(_payloads(spark, d), id_cols=("payload_id",))


@register("payload_counts")
def _q(spark, d):
    return P.payload_counts(_payloads(spark, d), id_cols=("payload_id",))


# ---------------------------------------------------------------- digest


def _digest(spark, d):
    s, a = _star_asof(spark, d)
    return G.digest(R.weekly_stats(s, a, n=5))


@register("digest_prompt")
def _q(spark, d):
    return _digest(spark, d).select("prompt")


@register("digest_html")
def _q(spark, d):
    return _digest(spark, d).select("html")


@register("preview_text")
def _q(spark, d):
    return _digest(spark, d).select("preview")


@register("newline_to_break")
def _q(spark, d):
    return _digest(spark, d).select(S.newline_to_break("prompt").alias("text_html"))


# -------------------------------------------------------------- filters
@register("filter_last_7_days")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.recent(s.fact, a, 7)


@register("filter_last_30_days")
def _q(spark, d):
    s, a = _star_asof(spark, d)
    return R.recent(s.fact, a, 30)


@register("scan_star_tables")
def _q(spark, d):
    return X.star(spark, d).fact


@register("join_fact_song")
def _q(spark, d):
    s = X.star(spark, d)
    return s.fact.join(s.song.select("song_id", "song_name"), "song_id")


@register("join_fact_artist")
def _q(spark, d):
    s = X.star(spark, d)
    return s.fact.join(s.artist.select("artist_id", "artist_name"), "artist_id")


@register("sample_with_replacement")
def _q(spark, d):
    from ..sources.sampling import sample_with_replacement
    return sample_with_replacement(X.catalog_from_part(X.table(spark, d, "part")), n=200, keys=["track_id"])


# ---------------------------------------------------------------- streams

DIM_COLS = {
    "dim_song": ["song_id", "song_name", "duration", "explicit", "popularity"],
    "dim_album": ["album_id", "album_name", "album_type", "release_date", "total_tracks"],
    "dim_artist": ["artist_id", "artist_name", "external_url"],
}
FACT_COLS = ["played_at", "song_id", "album_id", "artist_id", "duration_ms"]


def _ntz(col="played_at"):
    return F.col(col).cast("timestamp_ntz").alias(col)


def _fact_rows(wh):
    f = wh.read("fact_history")
    return f.select(_ntz(), *FACT_COLS[1:])


@register("four_streams_load_star")
def _q(spark, d):
    return ST._counts(ST.star_run(spark, d)["wh"])


@register("resume_from_checkpoint")
def _q(spark, d):
    return spark.read.parquet(ST.star_run(spark, d)["resumed"])


@register("replay_is_idempotent")
def _q(spark, d):
    return ST._counts(ST.star_run(spark, d)["wh"])


@register("batch_row_metrics")
def _q(spark, d):
    return L.loaded_rows(ST.star_run(spark, d)["wh"])


@register("foreach_batch_load")
def _q(spark, d):
    return _fact_rows(ST.star_run(spark, d)["wh"])


for _t in ("dim_song", "dim_album", "dim_artist"):
    register(f"{_t}_upsert")(
        lambda spark, d, _t=_t: ST.star_run(spark, d)["wh"].read(_t).select(*DIM_COLS[_t]))


@register("late_rows_accounted")
def _q(spark, d):
    return LT.accounting(ST.late_run(spark, d)["wh"])


@register("late_dead_letters")
def _q(spark, d):
    run = ST.late_run(spark, d)
    return SC.read_rejects(spark, run["wh"].root, "item_topic")


@register("replay_range")
def _q(spark, d):
    """The plays that arrived in slices 1 to 3 of 5, replayed from landed and archived files."""
    return _fact_rows(ST.replay_run(spark, d)["wh"])


@register("stream_topic_source")
def _q(spark, d):
    return spark.read.parquet(ST.state_run(spark, d)["item_raw"]).select("topic", "key", "value")


@register("stream_song_append")
def _q(spark, d):
    return spark.read.parquet(ST.state_run(spark, d)["song_append"])


@register("stream_dedup_album")
def _q(spark, d):
    return spark.read.parquet(ST.state_run(spark, d)["album"])


@register("stream_dedup_artist")
def _q(spark, d):
    return spark.read.parquet(ST.state_run(spark, d)["artist"])


@register("stream_dedup_play")
def _q(spark, d):
    return spark.read.parquet(ST.state_run(spark, d)["play"]).select(_ntz(), "song_id")


@register("stream_dedup_within_watermark")
def _q(spark, d):
    return ST.state_run(spark, d)["wh"].read("fact_history").select(_ntz(), "song_id")


@register("empty_batch_guard")
def _q(spark, d):
    m = ST.state_run(spark, d)["wh"].metrics()
    return m.groupBy("table_name").agg(
        F.sum("rows_new").cast("long").alias("loaded_rows"),
        F.count_if(F.col("rows_in") == 0).alias("zero_row_batches"))


def _roll(spark, d, grouping, key_name=None, slide=None):
    held = PN.windows(ST.star_run(spark, d)["panes"].read(), ST.DAILY, slide)
    r = RL.kpi(held, grouping, key_name)
    return r.withColumn("window_start", _ntz("window_start")).drop("window_end")


@register("rolling_sliding_plays")
def _q(spark, d):
    return _roll(spark, d, "artist_id", "artist_id", ST.SLIDE).select(
        "window_start", "artist_id", "plays", "listening_ms")


@register("rolling_song_plays")
def _q(spark, d):
    return _roll(spark, d, "song_id", "song_id").select("window_start", "song_id", "plays")


@register("rolling_listening_time")
def _q(spark, d):
    return _roll(spark, d, "total").select("window_start", "plays", "listening_ms")


@register("rolling_top_songs")
def _q(spark, d):
    c = _roll(spark, d, "song_id", "song_id")
    return RL.top_per_window(c, "song_id", 5).select("window_start", "rank", "song_id", "plays")


@register("rolling_top_songs_sketched")
def _q(spark, d):
    top = TK.top_per_window(ST.star_run(spark, d)["top_songs"], ST.DAILY, 5)
    return top.select(_ntz("window_start"), "rank", F.col("item").alias("song_id"), "plays")


@register("rolling_top_albums")
def _q(spark, d):
    c = _roll(spark, d, "album_id", "album_id")
    return RL.top_per_window(c, "album_id", 5).select("window_start", "rank", "album_id", "plays")


@register("rolling_artist_metrics")
def _q(spark, d):
    return _roll(spark, d, "artist_id", "artist_id").select(
        "window_start", "artist_id", "plays", "listening_ms")


@register("rolling_distinct_items")
def _q(spark, d):
    return RL.distinct_per_window(_roll(spark, d, "song_id", "song_id"))


# --------------------------------------------- batch dedup, load, contracts

PLAY_KEYS = ("played_at", "song_id")
PLAY_ORDER = ("album_id", "artist_id", "duration_ms")


@register("dedup_play_batch")
def _q(spark, d):
    return dedup_batch(X.star(spark, d).fact, PLAY_KEYS, PLAY_ORDER)


def _cut(spark, d):
    return R.as_of_column(X.star(spark, d).fact, X.fact_as_of(spark, d)) - F.expr("INTERVAL 365 DAYS")


@register("fact_insert_if_absent")
def _q(spark, d):
    """Load the older plays, then all plays: the second load adds only absent keys."""
    wh = L.Warehouse(spark, scratch_dir(spark, "fact-load"), key_buckets=spark.sparkContext.defaultParallelism)
    fact = X.star(spark, d).fact
    L.load_table(fact.filter(F.col("played_at") < _cut(spark, d)), FACT_HISTORY, wh, "first",
                 PLAY_ORDER)
    L.load_table(fact, FACT_HISTORY, wh, "second", PLAY_ORDER)
    return wh.read("fact_history").select(*FACT_COLS)


@register("new_rows_only")
def _q(spark, d):
    li = X.table(spark, d, "lineitem")
    loaded = X.fact_from_lineitem(li.filter(F.col("l_returnflag") == "R"))
    return new_rows_only(X.fact_from_lineitem(li), loaded, PLAY_KEYS)


@register("unmatched_fact_rows")
def _q(spark, d):
    s = X.star(spark, d)
    return unmatched_fact_rows(X.damaged_fact(X.table(spark, d, "lineitem")), s.song, s.artist,
                               s.album)


@register("contract_violations")
def _q(spark, d):
    s = X.star(spark, d)
    tables = {"fact_history": X.damaged_fact(X.table(spark, d, "lineitem")),
              "dim_song": s.song, "dim_artist": s.artist, "dim_album": s.album}
    return check_star(tables, CONTRACTS)


@register("surrogate_ids")
def _q(spark, d):
    """Dense ids: a first load of the songs played before the cut, then all songs."""
    wh = L.Warehouse(spark, scratch_dir(spark, "id-load"))
    s = X.star(spark, d)
    early = s.fact.filter(F.col("played_at") < _cut(spark, d)).select("song_id")
    L.load_table(s.song.join(early, "song_id", "left_semi"), DIM_SONG, wh, "first")
    L.load_table(s.song, DIM_SONG, wh, "second")
    return wh.read("dim_song").agg(
        F.count(F.lit(1)).alias("ids"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.count_distinct("id").alias("distinct_ids"))


@register("fact_surrogate_ids")
def _q(spark, d):
    """Ids of the fact: the plays before the cut, then all plays, then the second batch once more."""
    wh = L.Warehouse(spark, scratch_dir(spark, "fact-ids"))
    fact, cut = X.star(spark, d).fact, _cut(spark, d)
    L.load_table(fact.filter(F.col("played_at") < cut), FACT_HISTORY, wh, "first", PLAY_ORDER)
    for batch in ("second", "second"):
        L.load_table(fact, FACT_HISTORY, wh, batch, PLAY_ORDER)
    early = F.when(F.col("played_at") < cut, F.col("id"))
    return wh.read("fact_history").agg(
        F.count(F.lit(1)).alias("ids"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.count_distinct("id").alias("distinct_ids"), F.max(early).alias("first_block_max"))


def _refreshed(spark, d, ticks: int) -> str:
    """Reports after so many ticks of a clock that starts at the last play and moves three days a tick, without new plays."""
    run = ST.star_run(spark, d)
    out = scratch_dir(spark, "reports")
    last = run["wh"].read("fact_history").agg(F.unix_millis(F.max(F.col("played_at").cast("timestamp")))).first()[0]
    for _ in range(ticks):
        SC.run_to_end([RF.start_report_refresh(
            RF.staged_clock(spark, last, 3 * 86_400_000), lambda at: PT.report_tables(run["panes"], run["sets"], at),
            out, f"{out}-checkpoint", available_now=True)])
    return out


@register("report_refresh")
def _q(spark, d):
    return RF.read_report(spark, _refreshed(spark, d, 1), "top_songs")


@register("report_refresh_totals")
def _q(spark, d):
    return RF.read_report(spark, _refreshed(spark, d, 1), "totals")


@register("report_refresh_aged")
def _q(spark, d):
    """The totals three days after the last play: nothing arrived, and the window has moved on."""
    return RF.read_report(spark, _refreshed(spark, d, 2), "totals")


@register("report_refresh_weekdays")
def _q(spark, d):
    return RF.read_report(spark, _refreshed(spark, d, 2), "plays_by_weekday")
