"""Streams: late data against the watermark, restart from a checkpoint."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from playmart.sinks.topics import write_landing
from playmart.sources.topics import landing_topic_stream
from playmart.streaming import consumers as SC
from playmart.streaming import rolling as RL


def _plays(spark, day, n, start_id=0):
    recs = []
    for i in range(n):
        t = dt.datetime(2024, 1, day, 10, 0, i)
        recs.append(("item_topic", "s", json.dumps({
            "played_at": t.strftime("%Y-%m-%dT%H:%M:%S.000Z"), "song_id": f"s{start_id + i}",
            "album_id": "a", "artist_id": "r", "duration_ms": 60000})))
    return spark.createDataFrame(recs, "topic string, key string, value string")


def test_rolling_late_file_dropped_and_replay_not_double_counted(spark, tmp_path):
    landing, out, ck = (str(tmp_path / x) for x in ("landing", "out", "ck"))

    def run():
        typed = SC.accepted(SC.parsed_records(
            landing_topic_stream(spark, landing, "item_topic"), "item_topic"), "item_topic")
        q = RL.start_update_log(RL.rolling_metrics(typed, None, dedup=True), out, ck, "roll_test")
        SC.run_to_end([q])

    for day in (1, 2, 3):                       # in order
        write_landing(_plays(spark, day, 3), landing)
        run()
    write_landing(_plays(spark, 3, 3), landing)   # replay of the last slice: same plays
    run()
    write_landing(_plays(spark, 1, 2, start_id=100), landing)   # two batches late: dropped
    run()
    got = {r.window_start.day: r.plays
           for r in RL.read_latest(spark, out, ["window_start"]).collect()}
    assert got == {1: 3, 2: 3, 3: 3}


def test_state_dedup_survives_restart(spark, tmp_path):
    from playmart.operators.dedup import dedup_stream
    landing, out, ck = (str(tmp_path / x) for x in ("landing", "out", "ck"))

    def run():
        typed = SC.accepted(SC.parsed_records(
            landing_topic_stream(spark, landing, "item_topic"), "item_topic"), "item_topic")
        SC.run_to_end([SC.start_append(dedup_stream(typed, ["played_at", "song_id"]), out, ck,
                                       "dedup_test")])

    write_landing(_plays(spark, 1, 4), landing)
    run()
    write_landing(_plays(spark, 1, 4), landing)   # same plays again, after a restart
    write_landing(_plays(spark, 2, 2), landing)
    run()
    assert spark.read.parquet(out).count() == 6
    assert spark.read.parquet(out).select("played_at", "song_id").distinct().count() == 6


def test_job_from_config_loads_star_and_refreshes_reports(spark, tmp_path):
    from playmart.streaming.jobs import start
    from playmart.streaming.consumers import run_to_end
    from playmart.operators.fanout import fanout
    from playmart.streaming.refresh import read_report
    landing = str(tmp_path / "landing")
    wide = spark.createDataFrame(
        [("t1", "One", "['A']", "Al", 1000, True, 50, dt.datetime(2024, 1, 1, 10)),
         ("t2", "Two", "['B']", "Al", 2000, False, 40, dt.datetime(2024, 1, 1, 11)),
         ("t1", "One", "['A']", "Al", 1000, True, 50, dt.datetime(2024, 1, 1, 12))],
        "track_id string, track_name string, artists string, album_name string, "
        "duration_ms int, explicit boolean, popularity int, played_ts timestamp")
    write_landing(fanout(wide), landing)
    cfg = {"source": {"kind": "landing", "root": landing},
           "warehouse": str(tmp_path / "star"), "checkpoints": str(tmp_path / "ck"),
           "trigger": {"available_now": True}}
    run_to_end(start(spark, cfg))
    # a second start resumes the loaders (nothing new) and adds the report refresh, once
    cfg["report_refresh"] = {"out": str(tmp_path / "reports")}
    run_to_end(start(spark, cfg))
    star = str(tmp_path / "star")
    assert spark.read.parquet(f"{star}/fact_history").count() == 3
    assert spark.read.parquet(f"{star}/dim_song").count() == 2
    assert spark.read.parquet(f"{star}/dim_album").count() == 1
    assert spark.read.parquet(f"{star}/dim_artist").count() == 2
    assert read_report(spark, str(tmp_path / "reports"), "totals").count() == 1


def test_parquet_landing_round_trip(spark, tmp_path):
    from playmart.sources.topics import landing_topic_batch
    landing, out, ck = (str(tmp_path / x) for x in ("landing", "out", "ck"))
    write_landing(_plays(spark, 1, 3), landing, fmt="parquet")
    q = SC.start_append(landing_topic_stream(spark, landing, "item_topic", fmt="parquet"),
                        out, ck, "pq_landing")
    SC.run_to_end([q])
    assert spark.read.parquet(out).count() == 3
    assert landing_topic_batch(spark, landing, "item_topic", fmt="parquet").count() == 3


def test_reports_on_a_loaded_warehouse(spark, tmp_path):
    from playmart.operators import reports as R
    from playmart.functions.digest import digest
    from playmart.operators.fanout import fanout
    from playmart.sources.tables import read_parquet_star
    from playmart.streaming.jobs import start
    from playmart.streaming.consumers import run_to_end
    landing = str(tmp_path / "landing")
    wide = spark.createDataFrame(
        [("t1", "One", "['A']", "Al", 60000, True, 50, dt.datetime(2024, 1, 1, 10)),
         ("t1", "One", "['A']", "Al", 60000, True, 50, dt.datetime(2024, 1, 2, 10)),
         ("t2", "Two", "['B']", "Bl", 120000, False, 40, dt.datetime(2024, 1, 2, 11))],
        "track_id string, track_name string, artists string, album_name string, "
        "duration_ms int, explicit boolean, popularity int, played_ts timestamp")
    write_landing(fanout(wide), landing)
    wh = str(tmp_path / "star")
    run_to_end(start(spark, {"source": {"kind": "landing", "root": landing}, "warehouse": wh,
                             "checkpoints": str(tmp_path / "ck"),
                             "trigger": {"available_now": True}}))
    star = read_parquet_star(spark, wh)
    as_of = "2024-01-03 00:00:00"
    assert [(r.song_name, r.plays) for r in R.top_songs(star, as_of, n=10).collect()] == \
        [("One", 2), ("Two", 1)]
    assert R.listening_minutes(star.fact, as_of).first().mins == 4
    assert [r.artist_name for r in R.recent_plays(star, n=2).collect()] == ["B", "A"]
    d = digest(R.weekly_stats(star, as_of)).first()
    assert "One (2 plays), Two (1 plays)" in d.prompt


def test_job_state_modes_with_dead_letters(spark, tmp_path):
    from playmart.streaming.jobs import start
    from playmart.streaming.consumers import run_to_end
    landing = str(tmp_path / "landing")
    good = _plays(spark, 1, 3)
    bad = spark.createDataFrame([("item_topic", "s", "not json"),
                                 ("item_topic", "s", '{"played_at":"bad","song_id":"x"}')],
                                "topic string, key string, value string")
    write_landing(good.unionByName(bad).unionByName(_plays(spark, 1, 3)), landing)
    cfg = {"source": {"kind": "landing", "root": landing},
           "warehouse": str(tmp_path / "star"), "checkpoints": str(tmp_path / "ck"),
           "dedup": {"dims": "state", "fact": "watermark"}, "watermark": "1 hour",
           "rejects": True, "trigger": {"available_now": True}, "topics": ["item_topic"]}
    run_to_end(start(spark, cfg))
    star = str(tmp_path / "star")
    assert spark.read.parquet(f"{star}/fact_history").count() == 3      # copies removed
    rej = SC.read_rejects(spark, star, "item_topic").collect()
    assert sorted(r.reason for r in rej) == ["malformed", "null_key"]   # bad time -> NULL key


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_table_mode_stream_equals_batch_dedup(spark, tmp_path, order):
    import random
    from playmart.operators.dedup import dedup_batch
    from playmart.sinks.loader import Warehouse
    rnd = random.Random(7)
    plays = []
    for i in range(60):
        t = dt.datetime(2024, 1, 1 + i % 3, 10, rnd.randint(0, 5), 0)
        plays.append((t.strftime("%Y-%m-%dT%H:%M:%S.000Z"), f"s{rnd.randint(0, 4)}",
                      f"a{rnd.randint(0, 2)}", "r", 1000 * rnd.randint(1, 3), 1 + i % 3))
    rows_df = spark.createDataFrame(plays, "played_at string, song_id string, album_id string, "
                                           "artist_id string, duration_ms int, day int")
    landing = str(tmp_path / "landing")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for day in [d + 1 for d in order]:        # each slice is one day's plays
        part = rows_df.filter(F.col("day") == day).select(
            F.lit("item_topic").alias("topic"), F.col("song_id").alias("key"),
            F.to_json(F.struct("played_at", "song_id", "album_id", "artist_id",
                               "duration_ms")).alias("value"))
        write_landing(part, landing)
        SC.run_to_end([SC.start_topic_load(landing_topic_stream(spark, landing, "item_topic"),
                                           "item_topic", wh, str(tmp_path / "ck"), "t")])
    got = rows(wh.read("fact_history").select(
        F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss.000'Z'"), "song_id", "album_id",
        "artist_id", "duration_ms"))
    batch = dedup_batch(rows_df.drop("day"), ("played_at", "song_id"),
                        ("album_id", "artist_id", "duration_ms"))
    assert got == rows(batch)


def test_job_entry_point_catch_up(spark, tmp_path):
    from playmart.operators.fanout import fanout
    from playmart.streaming.jobs import main
    landing = str(tmp_path / "landing")
    wide = spark.createDataFrame(
        [("t1", "One", "['A']", "Al", 60000, True, 50, dt.datetime(2024, 1, 1, 10))],
        "track_id string, track_name string, artists string, album_name string, "
        "duration_ms int, explicit boolean, popularity int, played_ts timestamp")
    write_landing(fanout(wide), landing)
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"source": {"kind": "landing", "root": landing},
                               "warehouse": str(tmp_path / "star"),
                               "checkpoints": str(tmp_path / "ck"),
                               "trigger": {"available_now": True}}))
    main([str(cfg)])
    assert spark.read.parquet(str(tmp_path / "star" / "fact_history")).count() == 1


def test_append_rows_are_observed(spark, tmp_path):
    import time
    from playmart.streaming.progress import ProgressLog
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        landing, out, ck = (str(tmp_path / x) for x in ("landing", "out", "ck"))
        write_landing(_plays(spark, 1, 4), landing)
        SC.run_to_end([SC.start_append(landing_topic_stream(spark, landing, "item_topic"),
                                       out, ck, "observed_append")])
        time.sleep(1)
    finally:
        spark.streams.removeListener(log)
    assert log.summary()["observed_append"]["observed"]["rows_written"] == 4


def test_compacting_a_closed_day_does_not_recount_rolling_kpis(spark, tmp_path):
    from playmart.schemas import FACT_HISTORY
    from playmart.sinks.compact import compact_fact_days
    from playmart.sinks.loader import Warehouse, load_table
    wh = Warehouse(spark, str(tmp_path / "wh"))
    schema = "played_at timestamp, song_id string, album_id string, artist_id string, " \
             "duration_ms int"
    out, ck = str(tmp_path / "kpi"), str(tmp_path / "ck")

    def load(day, n, tag):
        plays = [(dt.datetime(2024, 1, day, 10, i), f"s{i}", "a", "r", 1000) for i in range(n)]
        load_table(spark.createDataFrame(plays, schema), FACT_HISTORY, wh, tag)

    def roll():
        plays = RL.fact_stream(spark, wh.path("fact_history"))
        SC.run_to_end([RL.start_update_log(RL.rolling_kpis(plays), out, ck, "kpi_test")])

    def day1_total():
        log = RL.read_latest(spark, out, ["window_start", "grouping", "key"])
        r = RL.kpi(log, "total").filter(F.dayofmonth("window_start") == 1).collect()
        return r[0].plays

    for tag in ("a", "b"):                 # two small batches on day 1
        load(1, 3, tag)
        roll()
    load(10, 1, "c")                        # moves the watermark far past day 1
    roll()
    assert day1_total() == 3
    compact_fact_days(wh, ["2024-01-01"])   # day 1 rewritten as a new file
    roll()
    assert day1_total() == 3


def _four_plays():
    """One good play, one without a song, one whose duration is text, and one without a time."""
    values = ['{"played_at": "2024-01-01T10:00:00.000Z", "song_id": "s1", "duration_ms": 12}',
              '{"played_at": "2024-01-01T10:01:00.000Z", "duration_ms": 12}',
              '{"played_at": "2024-01-01T10:02:00.000Z", "song_id": "s2", "duration_ms": "12"}',
              '{"song_id": "s3", "duration_ms": 12}']
    return [("item_topic", "k", v) for v in values]


@pytest.mark.parametrize("mode", ["table", "state", "watermark"])
def test_nullable_song_and_text_duration_load_and_rejects_are_kept(spark, tmp_path, mode):
    from playmart.streaming.jobs import start
    landing = str(tmp_path / "landing")
    write_landing(spark.createDataFrame(_four_plays(), "topic string, key string, value string"),
                  landing)
    root = str(tmp_path / "star")
    SC.run_to_end(start(spark, {"source": {"kind": "landing", "root": landing}, "warehouse": root,
                                "checkpoints": str(tmp_path / "ck"), "topics": ["item_topic"],
                                "dedup": {"fact": mode}, "trigger": {"available_now": True}}))
    got = spark.read.parquet(f"{root}/fact_history").select("song_id", "duration_ms")
    assert rows(got) == rows(spark.createDataFrame([("s1", 12), (None, 12), ("s2", None)],
                                                   "song_id string, duration_ms int"))
    assert [(r.topic, r.reason) for r in SC.read_rejects(spark, root).collect()] == [("item_topic", "null_key")]


def test_job_with_panes_reports_from_partials(spark, tmp_path):
    from playmart.streaming.jobs import main
    from playmart.streaming.refresh import read_report
    landing, out = str(tmp_path / "landing"), str(tmp_path / "kpis")
    write_landing(_plays(spark, 1, 3), landing)
    from playmart.operators.fanout import fanout
    wide = spark.createDataFrame([("t1", "One", "['A']", "Al", 1000, True, 50, dt.datetime(2024, 1, 1, 9))],
                                 "track_id string, track_name string, artists string, album_name string, "
                                 "duration_ms int, explicit boolean, popularity int, played_ts timestamp")
    write_landing(fanout(wide), landing)
    cfg = tmp_path / "cfg.json"
    cfg.write_text(json.dumps({"source": {"kind": "landing", "root": landing}, "warehouse": str(tmp_path / "star"),
                               "checkpoints": str(tmp_path / "ck"), "trigger": {"available_now": True},
                               "panes": {"out": out, "intervals": ["1 day", "6 hours"]},
                               "report_refresh": {"out": str(tmp_path / "reports")}}))
    main([str(cfg)])
    main([str(cfg)])        # the second run finds all tables loaded and the days announced
    totals = read_report(spark, str(tmp_path / "reports"), "totals").first()
    assert totals.total_plays == 0                      # the plays are older than a week
    from playmart.sinks.loader import Warehouse
    from playmart.streaming.panes import PaneTable
    held = PaneTable(Warehouse(spark, str(tmp_path / "star")), f"{out}/panes", 21_600).read()
    assert held.filter("grouping = 'total'").agg(F.sum("plays")).first()[0] == 4


def test_slices_are_derived_once_and_replayed_as_they_were(spark, tmp_path):
    from playmart.plans.staging import stage_and_run
    landing = str(tmp_path / "landing")
    times = [dt.datetime(2024, 1, 1, 0, 0, i) for i in range(10)]
    drawn = F.udf(lambda: uuid.uuid4().hex).asNondeterministic()
    records = (spark.createDataFrame([(t,) for t in times], "ts timestamp")
               .select("ts", F.explode(F.array(F.lit("song_topic"), F.lit("item_topic"))).alias("topic"),
                       F.lit("k").alias("key"), drawn().alias("value")))
    held = "spark.sql.maxConcurrentOutputFileWriters"
    before, sizes = spark.conf.get(held), []
    stage_and_run(records, landing, "ts", 3, lambda i: sizes.append(spark.read.json(landing).count()),
                  replay=True, order=(0, 2, 1))
    sent = spark.read.json(landing).groupBy("topic", "value").count().collect()
    assert len(sent) == 20 and {r["count"] for r in sent} == {2}      # the very same rows came again
    assert sizes == [8, 14, 20, 28, 34, 40] and spark.conf.get(held) == before


def test_large_batches_do_not_broadcast_the_target(spark, tmp_path, monkeypatch):
    from playmart.schemas import DIM_ARTIST, FACT_HISTORY
    from playmart.sinks import loader as L
    monkeypatch.setattr(L, "BROADCAST_BATCH_KEYS", 2)
    wh = L.Warehouse(spark, str(tmp_path / "wh"))
    at = dt.datetime(2024, 1, 1, 10)
    plays = spark.createDataFrame([(at, s, "a", "r", 1) for s in ("s1", "s2", None)],
                                  "played_at timestamp, song_id string, album_id string, artist_id string, duration_ms int")
    artists = spark.createDataFrame([("r1", "A", "u"), ("r2", "B", "u"), ("r1", "A", "u")],
                                    "artist_id string, artist_name string, external_url string")
    for batch, contract, more in ((plays, FACT_HISTORY, (at, "s3", "a", "r", 1)), (artists, DIM_ARTIST, ("r3", "C", "u"))):
        L.load_table(batch, contract, wh, "1")
        again = batch.unionByName(spark.createDataFrame([more], batch.schema))
        new = L.insert_candidates(again, contract, wh)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        assert [tuple(r)[:len(more)] for r in new.collect()] == [more]      # a NULL key is found too
