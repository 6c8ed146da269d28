"""Staged stream runs behind the stream keys.

The play stream is the ``events`` table joined to the catalogue (``part``),
fanned out to the four topics and written to a landing folder in time
slices.  After each slice the queries are restarted with ``availableNow`` from
their checkpoints; then the same slices arrive a second time (new files, same
rows) to exercise de-duplication across batches and restarts.

A run writes only to a fresh folder under the shared checkpoint folder, and
its result tables are reused by every key that reads them in the same session
(they are written tables, not cached frames).
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fanout as FO
from ..operators.dedup import dedup_stream
from ..session import DEFAULT_CONF, freed_shuffles, scratch_dir
from ..sinks.loader import Warehouse
from ..sinks.versions import Files
from ..sources.topics import landing_path, landing_topic_stream
from ..streaming import consumers as SC
from ..streaming import late as LT
from ..streaming.panes import PaneTable, pane_width, start_pane_refresh
from ..streaming.partials import DistinctTable
from ..streaming.replay import replay_range
from ..streaming.topk import SketchTable
from . import fixtures as X
from .staging import stage_and_run

N_SLICES = 5
# The second slice arrives after the third: its plays are days late when they are loaded.
ARRIVAL = (0, 2, 1, 3, 4)
# One pane table serves daily windows and daily windows that slide by six hours.
DAILY, SLIDE = "1 day", "6 hours"
_RUNS: dict = {}
_LOCK = threading.RLock()      # one staged run per dataset even if keys run concurrently


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


class _stateful_width:
    """Pin the state settings while the staged stateful queries first start.

    A stateful query freezes its shuffle width (and state store) into its
    checkpoint, so both are chosen here on purpose - the cluster's
    parallelism and RocksDB unless the session names a provider - rather than
    inherited from whatever the caller's session holds.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.width = str(max(1, spark.sparkContext.defaultParallelism))

    def __enter__(self):
        self.old = self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set("spark.sql.shuffle.partitions", self.width)
        self.set_store = self.spark.conf.get(STATE_STORE, None) in (None, "")
        if self.set_store:
            self.spark.conf.set(STATE_STORE, DEFAULT_CONF[STATE_STORE])

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.shuffle.partitions", self.old)
        if self.set_store:
            self.spark.conf.unset(STATE_STORE)


def replay_files(spark: SparkSession) -> int:
    """So many files of a topic a batch of the replay reads, however much is retained: two a core."""
    return 2 * spark.sparkContext.defaultParallelism


def event_plays(spark: SparkSession, d: str) -> DataFrame:
    return X.wide_plays_from_events(X.table(spark, d, "events"), X.table(spark, d, "part"))


def event_topic_records(spark: SparkSession, d: str, topics=tuple(FO.RECORDS)) -> DataFrame:
    return FO.fanout(event_plays(spark, d), topics, keep=("played_ts",))


def _counts(wh: Warehouse) -> DataFrame:
    parts = [wh.read(t).select(F.lit(t).alias("table_name")) for t in
             ("dim_song", "dim_album", "dim_artist", "fact_history")]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


def star_run(spark: SparkSession, d: str) -> dict:
    """Run A: four consumers (table-based dedup) load the star, slice by slice, one slice late.

    After each slice the pane table and the daily sets follow the days that the load touched.
    """
    with _LOCK:
        return _star_run(spark, d)


def _star_run(spark: SparkSession, d: str) -> dict:
    key = ("star", d.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_dir(spark, "star-run")
    landing, ck = f"{root}/landing", f"{root}/checkpoints"
    wh = Warehouse(spark, f"{root}/star", track_days=True)
    panes = PaneTable(wh, f"{root}/panes", pane_width(DAILY, SLIDE))
    sets = DistinctTable(panes, f"{root}/sets")
    top_songs = SketchTable(wh, f"{root}/top_songs")

    def run(i: int) -> None:
        SC.run_to_end(SC.start_star_load(
            spark, lambda t: landing_topic_stream(spark, landing, t), wh, ck))
        SC.run_to_end([start_pane_refresh([panes, sets, top_songs], f"{ck}/panes")])

    with _stateful_width(spark), freed_shuffles(spark):
        stage_and_run(event_topic_records(spark, d), landing, "played_ts", N_SLICES, run,
                      replay=True, order=ARRIVAL, times=event_plays(spark, d))
        resumed = f"{root}/counts_after_resume"
        _counts(wh).write.parquet(resumed)
        # full replay of everything retained, under new checkpoints, batch by batch until all of it is read
        SC.run_to_end(SC.start_star_load(
            spark, lambda t: landing_topic_stream(spark, landing, t, max_files_per_trigger=replay_files(spark)), wh,
            f"{root}/checkpoints-replay", prefix="replay"))
    out = {"wh": wh, "root": root, "landing": landing, "resumed": resumed, "panes": panes, "sets": sets,
           "top_songs": top_songs}
    _RUNS[key] = out
    return out




def state_run(spark: SparkSession, d: str) -> dict:
    """Run B: state-based dedup, watermark dedup + load, stateless append."""
    with _LOCK:
        return _state_run(spark, d)


def _state_run(spark: SparkSession, d: str) -> dict:
    """Run B (see ``state_run``); its slices come in time order, as a watermark wants."""
    key = ("state", d.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    root = scratch_dir(spark, "state-run")
    landing, ck = f"{root}/landing", f"{root}/checkpoints"
    wh = Warehouse(spark, f"{root}/wm_star")
    out = {n: f"{root}/out/{n}" for n in
           ("album", "artist", "play", "song_append", "item_raw")}

    def src(topic):
        return landing_topic_stream(spark, landing, topic)

    def typed(topic):
        return SC.accepted(SC.parsed_records(src(topic), topic), topic)

    def run(i: int) -> None:
        qs = [
            SC.start_append(dedup_stream(typed("album_topic"), ["album_id"]), out["album"],
                            f"{ck}/album", "dedup_album"),
            SC.start_append(dedup_stream(typed("artist_topic"), ["artist_id"]), out["artist"],
                            f"{ck}/artist", "dedup_artist"),
            SC.start_append(dedup_stream(typed("item_topic"), ["played_at", "song_id"]),
                            out["play"], f"{ck}/play", "dedup_play"),
            SC.start_topic_load(src("item_topic"), "item_topic", wh, f"{ck}/wm_play",
                                "wm_play", dedup="watermark", delay="1 hour"),
            SC.start_append(typed("song_topic"), out["song_append"], f"{ck}/song", "song_append"),
            SC.start_append(src("item_topic"), out["item_raw"], f"{ck}/item_raw", "item_raw"),
        ]
        SC.run_to_end(qs)

    with _stateful_width(spark):
        stage_and_run(event_topic_records(spark, d), landing, "played_ts", N_SLICES, run,
                      replay=True, times=event_plays(spark, d))
    res = {"wh": wh, "root": root, "landing": landing, **out}
    _RUNS[key] = res
    return res


def late_run(spark: SparkSession, d: str) -> dict:
    """Run C: plays in three slices, the second one last, through the router and the watermark load."""
    with _LOCK:
        key = ("late", d.rstrip("/"))
        if key not in _RUNS:
            _RUNS[key] = _late_run(spark, d)
        return _RUNS[key]


def _late_run(spark: SparkSession, d: str) -> dict:
    root = scratch_dir(spark, "late-run")
    landing, ck = f"{root}/landing", f"{root}/checkpoints"
    wh = Warehouse(spark, f"{root}/star")

    def run(i: int) -> None:
        SC.run_to_end([LT.start_router(landing_topic_stream(spark, landing, "item_topic"), wh, f"{ck}/route")])
        SC.run_to_end([LT.start_routed_load(spark, wh, f"{ck}/load")])

    with _stateful_width(spark):
        plays = event_topic_records(spark, d, ("item_topic",))
        stage_and_run(plays, landing, "played_ts", 3, run, order=(0, 2, 1), times=event_plays(spark, d))
    return {"wh": wh, "root": root}


# When the slices of the replay run arrive: one every hour from here on.
FIRST_ARRIVAL_MS = 1_704_067_200_000         # 2024-01-01 00:00 UTC


def replay_run(spark: SparkSession, d: str) -> dict:
    """Run D: five slices land an hour apart; two are read and archived; hours 1 to 3 are replayed into an empty star."""
    with _LOCK:
        key = ("replay", d.rstrip("/"))
        if key not in _RUNS:
            _RUNS[key] = _replay_run(spark, d)
        return _RUNS[key]


def _replay_run(spark: SparkSession, d: str) -> dict:
    root = scratch_dir(spark, "replay-run")
    landing, archive, ck = f"{root}/landing", f"{root}/archive", f"{root}/checkpoints"
    path = landing_path(landing, "item_topic")
    files, seen = Files(spark, path), set()
    first = Warehouse(spark, f"{root}/first")

    def run(i: int) -> None:
        landed = {p for p, _ in files.modified(path)}
        for p in landed - seen:
            files.stamp(p, FIRST_ARRIVAL_MS + 3_600_000 * i)
        seen.update(landed)
        if i < 3:            # files of a batch are archived with the next one
            SC.run_to_end([SC.start_topic_load(landing_topic_stream(spark, landing, "item_topic", archive=archive),
                                               "item_topic", first, f"{ck}/first", "first")])

    plays = event_topic_records(spark, d, ("item_topic",))
    stage_and_run(plays, landing, "played_ts", N_SLICES, run, times=event_plays(spark, d))
    wh = Warehouse(spark, f"{root}/star")
    hour = spark.range(1).select(*[F.date_format(F.timestamp_millis(F.lit(FIRST_ARRIVAL_MS + 3_600_000 * k)),
                                                 "yyyy-MM-dd HH:mm:ss") for k in (1, 4)]).first()
    for _ in range(2):       # the second replay adds nothing
        replay_range(spark, wh, landing, "item_topic", hour[0], hour[1], archive)
    return {"wh": wh, "root": root, "archive": archive}
