"""What the staged stream runs leave on disk."""
import os
import random

from pyspark.sql import functions as F

from playmart.plans import streams as ST
from playmart.plans.staging import stage_and_run
from playmart.sinks import topics as TP
from playmart.sinks.loader import Warehouse, load_table
from playmart.schemas import FACT_HISTORY
from playmart.session import ensure_checkpoint_dir, freed_shuffles
from playmart.sources.topics import landing_topic_stream
from playmart.streaming import consumers as SC


def files(root):
    return [os.path.join(d, n) for d, _, names in os.walk(root.removeprefix("file:")) for n in names if not n.startswith((".", "_"))]


def songs(spark, n, text="x"):
    """Records of ``n`` songs, each with a field that no table has."""
    value = F.concat(F.lit('{"song_id":"'), F.col("id").cast("string"), F.lit('","more":"'), F.lit(text), F.lit('"}'))
    return spark.range(n).select(F.lit("song_topic").alias("topic"), F.col("id").cast("string").alias("key"), value.alias("value"))


def test_landed_text_is_compressed_into_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(TP, "FILE_RECORDS", 400, raising=False)
    sent, landing = songs(spark, 1000, "x" * 500).coalesce(1), str(tmp_path / "landing")
    TP.write_landing(sent, landing)
    found = files(landing)
    assert len(found) == 3
    assert sum(map(os.path.getsize, found)) < 1000 * 500 / 5
    assert sorted(spark.read.json(landing).select("value").collect()) == sorted(sent.select("value").collect())


def test_a_slice_goes_when_it_has_landed_for_the_last_time(spark, tmp_path, monkeypatch):
    from playmart.plans import staging
    staged = str(tmp_path / "slices")
    monkeypatch.setattr(staging, "scratch_dir", lambda *_: staged)
    records = songs(spark, 10).withColumn("ts", F.timestamp_seconds(F.col("key").cast("long")))
    kept, landed = [], []

    def run(i):
        kept.append(sorted(n for n in os.listdir(staged) if n.startswith("_slice=")))
        landed.append(spark.read.json(str(tmp_path / "landing")).count())

    stage_and_run(records, str(tmp_path / "landing"), "ts", 2, run, replay=True, order=(1, 0))
    both = ["_slice=0", "_slice=1"]
    assert kept == [both, both, ["_slice=0"], []] and landed == [5, 10, 15, 20]
    assert not os.path.exists(staged)


def test_a_batch_is_held_without_the_text_of_accepted_records(spark, tmp_path, monkeypatch):
    landing, wh = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "star"))
    noise = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz", k=1000))
    bad = spark.createDataFrame([("song_topic", "k", "not json")], "topic string, key string, value string")
    TP.write_landing(songs(spark, 2000, noise).unionByName(bad), landing)
    held, load = [], SC.load_table

    def measured(*args, **kw):
        held.extend(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
        return load(*args, **kw)

    monkeypatch.setattr(SC, "load_table", measured)
    before = sum(i.memSize() + i.diskSize() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo())
    SC.run_to_end([SC.start_topic_load(landing_topic_stream(spark, landing, "song_topic"), "song_topic", wh,
                                       str(tmp_path / "ck"), "held_songs")])
    assert sum(held) - before < 2000 * 1000 / 5
    assert wh.read("dim_song").count() == 2000
    assert [tuple(r) for r in SC.read_rejects(spark, wh.root).collect()] == [("song_topic", "not json", "malformed")]


def test_a_load_leaves_no_checkpoint(spark, tmp_path):
    folder = ensure_checkpoint_dir(spark)
    before = {f for f in files(folder) if "/rdd-" in f}
    plays = spark.range(100).select(F.timestamp_seconds("id").alias("played_at"), F.col("id").cast("string").alias("song_id"),
                                    F.lit("a").alias("album_id"), F.lit("r").alias("artist_id"), F.lit(1).alias("duration_ms"))
    wh = Warehouse(spark, str(tmp_path / "star"))
    assert [load_table(plays, FACT_HISTORY, wh, b) for b in ("1", "2")] == [100, 0]
    assert {f for f in files(folder) if "/rdd-" in f} <= before
    assert wh.read("fact_history").agg(F.count_distinct("id")).first()[0] == 100


def test_shuffle_files_go_when_an_execution_ends(spark):
    made = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    with freed_shuffles(spark):
        before = made()
        assert spark.range(1000).groupBy((F.col("id") % 7).alias("g")).count().count() == 7
        assert made() <= before
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key) == "false"


def test_the_replay_of_everything_comes_in_batches_and_is_whole(spark, tmp_path, monkeypatch):
    at = F.timestamp_seconds(1_704_067_200 + F.col("id") * 600).cast("timestamp_ntz")
    d = str(tmp_path / "data")
    (spark.range(300).select(F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 9).alias("user_id"),
                             F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
                             F.concat(F.lit('{"k": '), (F.col("id") % 5).cast("string"), F.lit("}")).alias("props"))
     .write.parquet(f"{d}/events.parquet"))
    (spark.range(5).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"),
                           F.lit("t").alias("p_type"), F.lit(3).alias("p_size"), F.lit(1.0).alias("p_retailprice"))
     .write.parquet(f"{d}/part.parquet"))
    monkeypatch.setattr(ST, "_RUNS", {})
    monkeypatch.setattr(ST, "replay_files", lambda _: 6, raising=False)
    run = ST.star_run(spark, d)
    loads = run["wh"].metrics().filter("table_name = 'fact_history' AND batch_id LIKE 'replay%'").collect()
    landed = spark.read.json(f"{run['landing']}/topic=item_topic").count()
    assert landed == 600 and sum(r["rows_in"] for r in loads) == landed
    assert len(loads) > 1 and not any(r["rows_new"] for r in loads)
    counts = {r["table_name"]: r["rows"] for r in ST._counts(run["wh"]).collect()}
    assert counts == {"dim_song": 5, "dim_album": 1, "dim_artist": 9, "fact_history": 300}
