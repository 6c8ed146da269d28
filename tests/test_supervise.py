"""Supervised consumers, late plays set aside, replay of a stretch of time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from playmart.sinks.loader import Warehouse
from playmart.sinks.topics import write_landing
from playmart.sinks.versions import Files
from playmart.sources.topics import landing_path, landing_topic_stream
from playmart.streaming import consumers as SC
from playmart.streaming import late as LT
from playmart.streaming import replay as RP
from playmart.streaming.supervise import GaveUp, Supervisor

WIDE = ("track_id string, track_name string, artists string, album_name string, duration_ms int, explicit boolean, "
        "popularity int, played_ts timestamp")


def records(spark, *days, n=3):
    from playmart.operators.fanout import fanout
    wide = [(f"t{i}", f"T{i}", "['A']", "Al", 60000, True, 50, dt.datetime(2024, 1, d, 10, i)) for d in days for i in range(n)]
    return fanout(spark.createDataFrame(wide, WIDE))


def test_one_consumer_fails_twice_and_the_others_load_on(spark, tmp_path):
    from playmart.streaming.jobs import starters
    landing, star = str(tmp_path / "landing"), str(tmp_path / "star")
    write_landing(records(spark, 1), landing)
    begin = starters(spark, {"source": {"kind": "landing", "root": landing}, "warehouse": star,
                             "checkpoints": str(tmp_path / "ck"), "trigger": {"available_now": True}})
    tries = []

    def flaky():
        """The consumer of songs, whose sink is broken in its first two runs."""
        tries.append(1)
        if len(tries) > 2:
            return begin["load_song_topic"]()

        def broken(batch, batch_id):
            raise OSError("sink away")

        return (SC.parsed_records(landing_topic_stream(spark, landing, "song_topic"), "song_topic").writeStream
                .queryName("load_song_topic").option("checkpointLocation", str(tmp_path / "ck" / "load_song_topic"))
                .trigger(availableNow=True).foreachBatch(broken).start())

    s = Supervisor(spark, begin | {"load_song_topic": flaky}, first_pause=0.05)
    s.run()
    assert len(tries) == 3
    watched = {w.name: w for w in s.watched}
    assert len(watched["load_song_topic"].errors) == 2 and all(w.done for w in s.watched)
    wh = Warehouse(spark, star)
    assert [wh.read(t).count() for t in ("dim_song", "dim_album", "dim_artist", "fact_history")] == [3, 1, 1, 3]


def test_supervisor_pauses_grow_and_end(spark, tmp_path):
    def never():
        raise OSError("no source")

    s = Supervisor(spark, {"x": never}, first_pause=0.01, longest_pause=0.05, max_failures=4)
    assert [s.pause(k) for k in (1, 2, 3, 4, 9)] == [0.01, 0.02, 0.04, 0.05, 0.05]
    with pytest.raises(GaveUp, match="x failed 4 times"):
        s.run(poll=0.01)


def test_late_plays_are_set_aside_and_counted(spark, tmp_path):
    landing, ck = str(tmp_path / "landing"), str(tmp_path / "ck")
    wh = Warehouse(spark, str(tmp_path / "star"))

    def step(df):
        write_landing(df.filter(F.col("topic") == "item_topic"), landing)
        SC.run_to_end([LT.start_router(landing_topic_stream(spark, landing, "item_topic"), wh, f"{ck}/route")])
        SC.run_to_end([LT.start_routed_load(spark, wh, f"{ck}/load")])

    bad = spark.createDataFrame([("item_topic", "k", "not json")], "topic string, key string, value string")
    step(records(spark, 1))
    step(records(spark, 5).unionByName(records(spark, 5)).unionByName(bad))     # each play twice
    step(records(spark, 1, 2, n=2).unionByName(records(spark, 6, n=1)))         # two days behind, and one new play
    got = LT.accounting(wh).first().asDict()
    assert got == {"read": 3 + 7 + 5, "rejected": 1, "late": 4, "loaded": 3 + 3 + 1, "copies": 3}
    assert got["read"] == got["rejected"] + got["late"] + got["loaded"] + got["copies"]
    letters = SC.read_rejects(spark, wh.root, "item_topic")
    assert rows(letters.groupBy("reason").count()) == [("late", 4), ("malformed", 1)]
    high = LT.HighWater(spark, f"{ck}/route")
    assert high.before(1) < high.before(2) and high.before(0) is None


def test_replay_of_a_stretch(spark, tmp_path):
    landing, archive, ck = (str(tmp_path / x) for x in ("landing", "archive", "ck"))
    path = landing_path(landing, "item_topic")
    files, seen = Files(spark, path), set()
    for day in (1, 2, 3):                                # lands at noon of its day
        write_landing(records(spark, day).filter(F.col("topic") == "item_topic"), landing)
        now = {p for p, _ in files.modified(path)}
        for p in now - seen:
            files.stamp(p, 1_704_067_200_000 + 86_400_000 * (day - 1) + 43_200_000)
        seen |= now
        SC.run_to_end([SC.start_topic_load(landing_topic_stream(spark, landing, "item_topic", archive=archive), "item_topic",
                                           Warehouse(spark, str(tmp_path / "all")), ck, "all")])
    assert len(files.modified(path)) < len(seen)         # the older files have moved

    def replayed(start, end, root):
        wh = Warehouse(spark, str(tmp_path / root))
        n = RP.replay_range(spark, wh, landing, "item_topic", start, end, archive)
        assert RP.replay_range(spark, wh, landing, "item_topic", start, end, archive) == 0
        return n, sorted({r.played_at.day for r in wh.read("fact_history").collect()}) if n else []

    assert replayed("2024-01-01 12:00:00", "2024-01-02 12:00:00", "a") == (3, [1])      # half-open
    assert replayed("2024-01-01 12:00:00.001", "2024-01-03 12:00:00.001", "b") == (6, [2, 3])
    assert replayed("2024-01-04 00:00:00", "2024-01-05 00:00:00", "c") == (0, [])
    assert RP.arrived(spark, str(tmp_path / "nowhere"), "item_topic", "2024-01-01", "2024-01-02").collect() == []
