"""Plan shape of the headline reports: pushdown, pruning, aggregation placement."""

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_songs_plan(spark):
    plan = _plan(E.queries()["top_songs_week"](spark, SF_SMALL))
    # the recency bound is a literal pushed into the fact scan, two columns read
    assert "GreaterThanOrEqual(l_shipdate,2001-10-28T00:00)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in plan
    # counts per key are pre-aggregated map-side before the join
    assert plan.index("partial_count") > plan.index("BroadcastHashJoin")
    assert "TakeOrderedAndProject" in plan


def test_totals_single_scan(spark):
    plan = _plan(E.queries()["totals_week"](spark, SF_SMALL))
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_dedup_uses_partial_aggregate_not_window(spark):
    plan = _plan(E.queries()["dedup_play_batch"](spark, SF_SMALL))
    assert "Window" not in plan
    assert "partial_min_by" in plan


def test_fanout_is_map_only(spark):
    plan = _plan(E.queries()["fanout_all_topics"](spark, SF_SMALL))
    assert "Generate explode" in plan
    # the only exchange is the catalogue join (broadcast); no shuffle of plays
    assert "Exchange hashpartitioning" not in plan


def test_fact_load_reads_only_the_batch_range(spark, tmp_path):
    import datetime as dt
    from playmart.schemas import FACT_HISTORY
    from playmart.sinks.loader import Warehouse, insert_candidates, load_table
    wh = Warehouse(spark, str(tmp_path / "wh"))
    schema = "played_at timestamp, song_id string, album_id string, artist_id string, " \
             "duration_ms int"
    days = [(dt.datetime(2024, 1, d, 10), f"s{d}", "a", "r", 1) for d in range(1, 11)]
    load_table(spark.createDataFrame(days, schema), FACT_HISTORY, wh, "1")
    batch = spark.createDataFrame([(dt.datetime(2024, 1, 5, 10), "s5", "a", "r", 1),
                                   (dt.datetime(2024, 1, 5, 11), "new", "a", "r", 1)], schema)
    cand = insert_candidates(batch, FACT_HISTORY, wh)
    plan = _plan(cand)
    # the target read is pruned to the batch's day and time range
    assert "PartitionFilters: [isnotnull(play_date" in plan and "2024-01-05" in plan
    assert "PushedFilters: [IsNotNull(played_at), GreaterThanOrEqual(played_at,2024-01-05 10:00" in plan
    assert "LeftSemi" in plan
    # batch keys are broadcast to narrow the target: the target is not shuffled
    assert "BroadcastExchange" in plan
    assert [r.song_id for r in cand.collect()] == ["new"]


def test_reports_prune_day_partitions_of_the_loaded_fact(spark, tmp_path):
    import datetime as dt
    from playmart.operators import reports as R
    from playmart.schemas import FACT_HISTORY
    from playmart.sinks.loader import Warehouse, load_table
    wh = Warehouse(spark, str(tmp_path / "wh"))
    schema = "played_at timestamp, song_id string, album_id string, artist_id string, " \
             "duration_ms int"
    plays = [(dt.datetime(2024, 1, d, 10), f"s{d}", "a", "r", 60000) for d in range(1, 21)]
    load_table(spark.createDataFrame(plays, schema), FACT_HISTORY, wh, "1")
    fact = wh.read("fact_history")
    q = R.totals(fact, "2024-01-20 12:00:00", 7)
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(play_date" in plan and "2024-01-13" in plan
    assert q.first().total_plays == 7          # days 14..20 (13th 10:00 < bound 13th 12:00)
