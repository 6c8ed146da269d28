"""Windows that follow the fact: late plays, panes, daily partials, versions, ids, journal, keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from playmart.operators import reports as R
from playmart.schemas import DIM_ARTIST, DIM_SONG, FACT_HISTORY
from playmart.sinks import loader as L
from playmart.sinks.versions import VersionedTable
from playmart.sources.tables import Star
from playmart.streaming import consumers as SC
from playmart.streaming import panes as PN
from playmart.streaming import partials as PT

FACT = "played_at timestamp, song_id string, album_id string, artist_id string, duration_ms int"
EPOCH = dt.datetime(1970, 1, 1)


def some_plays(n, seed=1, first_day=1, days=40):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, first_day)
    out = {}
    for _ in range(n):
        t = start + dt.timedelta(seconds=rng.randrange(days * 86400))
        s = rng.choice([None, *[f"s{i}" for i in range(9)]])
        out[t, s] = (t, s, f"a{rng.randint(0, 3)}", rng.choice([None, "r0", "r1", "r2"]), rng.randint(1, 400_000))
    return list(out.values())


def load(spark, wh, plays, batch):
    return L.load_table(spark.createDataFrame(plays, FACT), FACT_HISTORY, wh, batch)


@pytest.mark.parametrize("size,slide", [("1 day", None), ("1 day", "6 hours"), ("7 days", "1 day"), ("45 minutes", "15 minutes"),
                                        ("2 hours", "90 minutes")])
def test_windows_from_panes(spark, size, slide):
    plays = some_plays(400)
    long, step = PN.seconds(size), PN.seconds(slide or size)
    want = {}
    for t, song, album, artist, ms in plays:
        at = int((t - EPOCH).total_seconds())
        first = at // step * step
        while first > at - long:
            for g, k in (("song_id", song), ("album_id", album), ("artist_id", artist), ("total", None)):
                n, total = want.get((first, g, k), (0, 0))
                want[first, g, k] = n + 1, total + ms
            first -= step
    df = spark.createDataFrame(plays, FACT).withColumn("play_date", F.to_date("played_at"))
    got = PN.windows(PN.panes(df, PN.pane_width(size, slide or size)), size, slide)
    assert {(int((r.window_start - EPOCH).total_seconds()), r.grouping, r.key): (r.plays, r.listening_ms) for r in got.collect()} == want
    assert got.filter(F.unix_seconds("window_end") - F.unix_seconds("window_start") != long).isEmpty()


def test_sliding_windows_count_each_play_once(spark):
    """The only Expand is that of the grouping sets; windows are made from panes."""
    df = spark.createDataFrame(some_plays(50), FACT).withColumn("play_date", F.to_date("played_at"))
    plan = PN.windows(PN.panes(df, 21_600), "1 day", "6 hours")._jdf.queryExecution().optimizedPlan().toString()
    # read upwards from the plays: grouping sets, the count of the panes, then only the spreading to windows
    assert plan.index("Generate") < plan.index("Aggregate", plan.index("Generate")) < plan.index("Expand")
    with pytest.raises(ValueError):
        PN.windows(df, "1 hour", "2 hours")
    for bad in ("1 month", "day", "0 days"):
        with pytest.raises(ValueError):
            PN.seconds(bad)


def test_late_plays_reach_their_windows(spark, tmp_path):
    wh = L.Warehouse(spark, str(tmp_path / "wh"), track_days=True)
    table = PN.PaneTable(wh, str(tmp_path / "panes"), 21_600)

    def follow():
        SC.run_to_end([PN.start_pane_refresh([table], str(tmp_path / "ck"))])

    def expect(plays):
        df = spark.createDataFrame(plays, FACT).withColumn("play_date", F.to_date("played_at"))
        assert rows(table.read()) == rows(PN.panes(df, 21_600))

    late, rest = some_plays(200, days=3), some_plays(300, seed=2, first_day=10)
    follow()                                              # nothing loaded yet
    assert table.read().collect() == []
    load(spark, wh, rest, "a")
    follow()
    expect(rest)
    before = table.table.current()
    load(spark, wh, late[:150], "b")                      # a week behind what is loaded
    load(spark, wh, late[100:] + rest[:10], "c")          # part of it known
    follow()
    expect(late + rest)
    kept = [d for d in before if table.table.current()[d] == before[d]]
    assert set(kept) == set(before) - {"2024-01-01", "2024-01-02", "2024-01-03"}
    versions = table.table.current()
    assert load(spark, wh, late, "c") == 0                # a replay touches no day
    follow()
    assert table.table.current() == versions
    assert sorted({str(r.play_date) for r in table.read("2024-01-02", "2024-01-03").collect()}) == ["2024-01-02", "2024-01-03"]
    table.table.vacuum(1)
    expect(late + rest)


def star_of(wh):
    return Star(fact=wh.read("fact_history"), song=wh.read("dim_song"), artist=wh.read("dim_artist"), album=None)


@pytest.mark.parametrize("as_of", ["2024-02-09 13:30:00.000001", "2024-02-08 00:00:00.000000", "2024-03-20 00:00:00.000000"])
def test_reports_from_partials_equal_those_of_the_star(spark, tmp_path, as_of):
    wh = L.Warehouse(spark, str(tmp_path / "wh"), track_days=True)
    table = PN.PaneTable(wh, str(tmp_path / "panes"))
    sets = PT.DistinctTable(table, str(tmp_path / "sets"))

    def follow():
        SC.run_to_end([PN.start_pane_refresh([table, sets], str(tmp_path / "ck"))])

    def dims(songs, artists, batch):
        for keys, contract, key, name in ((songs, DIM_SONG, "song_id", "song_name"), (artists, DIM_ARTIST, "artist_id", "artist_name")):
            L.load_table(spark.createDataFrame([(k, "N" + k) for k in keys], f"{key} string, {name} string"), contract, wh, batch)

    dims([f"s{i}" for i in range(4)], ["r0"], "1")
    load(spark, wh, some_plays(700), "a")
    follow()
    dims(["s4", "s5"], ["r1"], "2")                       # their days were derived without them
    load(spark, wh, some_plays(100, seed=5, first_day=20, days=15), "b")
    follow()
    star = star_of(wh)
    week, month = PT.Partials(table, sets, as_of, 7), PT.Partials(table, sets, as_of, 30)
    assert rows(week.totals()) == rows(R.totals(star.fact, as_of, 7))
    assert rows(month.totals()) == rows(R.totals(star.fact, as_of, 30))
    assert week.totals().columns == R.totals(star.fact, as_of, 7).columns
    assert month.plays_by_weekday().collect() == R.plays_by_weekday(star.fact, as_of, 30).collect()
    assert rows(month.listening_hours_by_day()) == rows(R.listening_hours_by_day(star.fact, as_of, 30))
    assert week.top_songs(5).collect() == R.top_songs(star, as_of, 5).collect()
    assert week.top_artists(5).collect() == R.top_artists(star, as_of, 5).collect()


def test_reports_age_with_the_clock_and_are_never_missing(spark, tmp_path):
    from playmart.streaming import refresh as RF
    wh = L.Warehouse(spark, str(tmp_path / "wh"))
    out, ck = str(tmp_path / "reports"), str(tmp_path / "ck")
    start = 1_707_000_000_000

    def tick():
        SC.run_to_end([RF.start_report_refresh(
            RF.staged_clock(spark, start, 86_400_000), lambda at: {"totals": R.totals(spark.read.parquet(wh.path("fact_history")), at, 7)},
            out, ck, available_now=True)])

    assert RF.read_report(spark, out, "totals") is None
    tick()                                                # no fact yet: nothing is published
    assert RF.read_report(spark, out, "totals") is None
    at = dt.datetime(2024, 2, 3, 22, 40)
    load(spark, wh, [(at - dt.timedelta(days=d), "s", "a", "r", 60_000) for d in range(12)], "a")
    seen, held = [], None
    for _ in range(3):
        tick()
        now = RF.read_report(spark, out, "totals")
        seen.append(now.first().total_plays)
        if held is not None:
            assert held.first().total_plays == seen[-2]   # a reader of the version before can go on
        held = now
    assert seen[0] > seen[1] > seen[2]


def test_versions_switch_together(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    frame = lambda n: spark.range(n)
    t.replace({"a": frame(1), "b": frame(2)})
    t.replace({"a": frame(3)})
    assert (t.read("a").count(), t.read("b").count(), t.read("c")) == (3, 2, None)
    before = t.current()

    class Broken(Exception):
        pass

    class Frame:
        @property
        def write(self):
            raise Broken

    with pytest.raises(Broken):
        t.replace({"a": frame(9), "b": Frame()})
    assert t.current() == before and t.read("a").count() == 3
    gone = t.vacuum(1)
    assert len(gone) == 2 and (t.read("a").count(), t.read("b").count()) == (3, 2)


def ids_of(wh):
    return {(r.played_at, r.song_id): r.id for r in wh.read("fact_history").collect()}


def test_fact_ids_are_dense_and_stable(spark, tmp_path):
    wh = L.Warehouse(spark, str(tmp_path / "wh"))
    plays = some_plays(500)
    load(spark, wh, plays[:200], "a")
    first = ids_of(wh)
    assert sorted(first.values()) == list(range(1, 201))
    assert load(spark, wh, plays, "b") == len(plays) - 200
    assert load(spark, wh, plays, "b") == 0
    got = ids_of(wh)
    assert sorted(got.values()) == list(range(1, len(plays) + 1))
    assert all(got[k] == i for k, i in first.items())
    assert wh.journal("fact_history").state() == {"high_water": len(plays), "open": None}


@pytest.mark.parametrize("fails", ["before", "after"])
def test_a_load_that_is_cut_short_is_completed(spark, tmp_path, monkeypatch, fails):
    """Cut before the plays land: their ids are free again.  Cut after: keys and touched days follow."""
    wh = L.Warehouse(spark, str(tmp_path / "wh"), key_buckets=4, track_days=True)
    monkeypatch.setattr(L, "MAX_DAY_GLOB", 3)             # these batches go by the key table
    plays = some_plays(300)
    load(spark, wh, plays[:100], "a")

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(L.Warehouse, "add_keys" if fails == "after" else "path", broken)
        with pytest.raises(RuntimeError):
            load(spark, wh, plays, "b")
    opened = wh.journal("fact_history").state()["open"]
    assert opened["batch"] == "b" and opened["first"] == 101
    assert load(spark, wh, plays, "b") == (len(plays) - 100 if fails == "before" else 0)
    got = ids_of(wh)
    assert sorted(got.values()) == list(range(1, len(plays) + 1))
    keys = spark.table(wh.key_table())
    assert keys.count() == keys.distinct().count() == len(plays)
    touched = spark.read.parquet(f"{wh.touched_path}/batch_id=b")
    assert {r[0] for r in touched.collect()} >= {p[0].date() for p in plays[100:]}


def test_key_table_reads_the_history_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "MAX_DAY_GLOB", 3)
    wh = L.Warehouse(spark, str(tmp_path / "wh"), key_buckets=4)
    plays = some_plays(400)
    load(spark, wh, plays[:250], "a")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = L.insert_candidates(spark.createDataFrame(plays, FACT), FACT_HISTORY, wh)
        plan = new._jdf.queryExecution().executedPlan().toString()
        history = plan[plan.index("Scan parquet", plan.index("LeftAnti")):] if "Scan parquet" in plan else ""
        assert "Bucketed: true" in history
        lines = plan.splitlines()
        scan = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
        above = [x for x in lines[:scan] if "Exchange" in x]
        join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
        side = [x for x in lines[join:scan] if "Exchange hashpartitioning(load_key" in x]
        assert len(side) == 1 and len(above) >= 1         # the batch's side only
        assert {(r.played_at, r.song_id) for r in new.collect()} == {p[:2] for p in plays[250:]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sampling_by_position(spark):
    from playmart.sources.sampling import positions, sample_with_replacement
    import hashlib
    data = [(f"t{i}", i % 5) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, v int")
    order = sorted(data, key=lambda r: (hashlib.md5(r[0].encode()).hexdigest(), r[0]))
    want = sorted(order[p] for p in positions(300, 2000, 9))
    for parts in (1, 7):
        assert rows(sample_with_replacement(df.repartition(parts), 300, seed=9, keys=["k"])) == sorted(want, key=repr)
    copies = spark.createDataFrame([("same", None)] * 500 + [("other", 1)], "k string, v int")
    assert sample_with_replacement(copies, 100).count() == 100
    counts = [0] * 10
    for p in positions(20_000, 10, 3):
        counts[p] += 1
    assert max(abs(c - 2000) for c in counts) < 250       # uniform: six standard deviations


def test_a_dimension_rewrite_cut_short_leaves_a_table(spark, tmp_path, monkeypatch):
    from playmart.sinks.compact import compact_table
    wh = L.Warehouse(spark, str(tmp_path / "wh"))
    for b in range(3):
        L.load_table(spark.createDataFrame([(f"s{b}", f"S{b}")], "song_id string, song_name string"), DIM_SONG, wh, str(b))
    before = rows(wh.read("dim_song"))

    def lost(*_):
        raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(L.Warehouse, "finish_switch", lost)     # between the two renames
        with pytest.raises(RuntimeError):
            compact_table(wh, "dim_song")
    assert rows(wh.read("dim_song")) == before            # the reader completes the switch
    assert compact_table(wh, "dim_song") == 3 and rows(wh.read("dim_song")) == before
    assert wh.read("dim_none") is None


@pytest.mark.parametrize("tracked", [8, 64, 2000])
def test_top_items_from_sketches_are_exact(spark, tmp_path, tracked):
    """A skewed day is proven by a small sketch, an even one is counted in full; both are right."""
    from playmart.operators.topn import top_n_per_group
    from playmart.streaming import topk as TK
    wh = L.Warehouse(spark, str(tmp_path / "wh"), track_days=True)
    rng = random.Random(3)
    at = lambda day, i: dt.datetime(2024, 1, day) + dt.timedelta(seconds=i)
    plays = [(at(1, i), f"s{int(rng.paretovariate(0.7)) % 300}" if i % 3 else f"top{i % 9}", "a", "r", 1) for i in range(3000)]
    plays += [(at(2, i), f"s{i % 700}" if i % 50 else None, "a", "r", 1) for i in range(2000)]
    plays += [(at(4, i), f"s{i}", "a", "r", 1) for i in range(3)]
    plays += [(at(5, i), f"hit{i % 5}" if i % 8 else f"s{i}", "a", "r", 1) for i in range(2400)]
    plays += [(at(1, 7000), "s1", "a", "r", 1)]
    table = TK.SketchTable(wh, str(tmp_path / "sketches"), width=21_600, tracked=tracked)
    load(spark, wh, plays[:2500], "a")
    load(spark, wh, plays[2500:], "b")
    SC.run_to_end([PN.start_pane_refresh([table], str(tmp_path / "ck"))])
    counts = spark.createDataFrame(plays, FACT).groupBy(F.date_trunc("day", "played_at").alias("window_start"), F.col("song_id").alias("item")).count()
    want = top_n_per_group(counts, ["window_start"], [F.col("count").desc(), F.col("item").asc_nulls_last()], 5, "item", rank_col="rank")
    got = TK.top_per_window(table, "1 day", 5)
    assert rows(got.drop("proven")) == rows(want.select("window_start", "rank", "item", "count"))
    proven = {r.window_start.day: r.proven for r in got.collect()}
    # three songs; five hits and 300 others; 701 even songs
    assert (proven[4], proven[5], proven[2]) == (True, tracked >= 64, tracked == 2000)
    assert rows(TK.top_per_window(table, "1 day", 5, "2024-01-02", "2024-01-03").drop("proven")) == \
        rows(want.filter(F.dayofmonth("window_start") == 2).select("window_start", "rank", "item", "count"))
