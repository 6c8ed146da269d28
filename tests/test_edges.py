"""Hand-written edge rows (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from playmart.functions import digest as G
from playmart.functions import scalars as S
from playmart.operators import decode as D
from playmart.operators import reports as R
from playmart.schemas import PLAY_RECORD
from playmart.sources.tables import Star

TOPIC_ROWS = T.StructType([T.StructField("id", T.IntegerType()),
                           T.StructField("value", T.StringType())])


# ------------------------------------------------------------ item_values
ITEM_VALUES = [
    (1, '{"played_at":"2024-01-01T00:00:00.000Z","song_id":"s1","album_id":"a",'
        '"artist_id":"r","duration_ms":1000}'),
    (2, "not json"),
    (3, "[]"),
    (4, '[{"song_id":"s1"},{"song_id":"s2"}]'),
    (5, None),
    (6, '{"played_at":"2024-01-01T00:00:00.000Z","song_id":"s6","duration_ms":"12"}'),
    (7, '{"played_at":"2024-01-01T00:00:00.000Z","song_id":"s7","duration_ms":99999999999}'),
    (8, '{"played_at":"2024-01-01T00:00:00.000Z","song_id":"s8","duration_ms":1.5}'),
    (9, '{"played_at":"2024-01-01T00:00:00.000Z","song_id":"s9","extra":1}'),
    (10, '{"played_at":"2024-01-01T00:00:00.000Z","duration_ms":5}'),
]


def _classified(spark, strict):
    df = spark.createDataFrame(ITEM_VALUES, TOPIC_ROWS)
    parsed = D.classify(D.parse_values(df, PLAY_RECORD, keep=("id",)), PLAY_RECORD,
                        ("song_id",), strict)
    return dict(rows(parsed.select("id", "_reject")))


def test_quarantine_strict(spark):
    got = _classified(spark, strict=True)
    assert got == {1: None, 2: "malformed", 3: "malformed", 4: "malformed", 5: "null_key",
                   6: "malformed", 7: "malformed", 8: "malformed", 9: None, 10: "null_key"}


def test_quarantine_permissive_keeps_typed_fields_null(spark):
    got = _classified(spark, strict=False)
    # a wrong-typed non-key field is kept (as NULL); structural junk is still rejected
    assert got[6] is None and got[7] is None and got[8] is None
    assert got[2] == "malformed" and got[3] == "malformed" and got[10] == "null_key"


def test_quarantine_split_keeps_raw_text(spark):
    df = spark.createDataFrame(ITEM_VALUES, TOPIC_ROWS)
    ok, bad = D.quarantine(df, PLAY_RECORD, ("song_id",), keep=("id",))
    assert sorted(r.id for r in ok.collect()) == [1, 9]
    bad_rows = {r.id: (r.raw_value, r.reason) for r in bad.collect()}
    assert bad_rows[2] == ("not json", "malformed")
    assert bad_rows[5] == (None, "null_key")


def test_decode_keeps_reference_behaviour(spark):
    df = spark.createDataFrame(ITEM_VALUES, TOPIC_ROWS)
    out = {r.id: r for r in D.decode_records(df, PLAY_RECORD, keep=("id",)).collect()}
    assert out[2].song_id is None and out[2].played_at is None   # a row of NULLs
    assert out[6].song_id == "s6" and out[6].duration_ms is None  # mismatch -> NULL field
    assert out[1].duration_ms == 1000


# ------------------------------------------------------------- plays_time
def _fact(spark, data):
    schema = "played_at timestamp, song_id string, album_id string, artist_id string, " \
             "duration_ms int"
    return spark.createDataFrame(data, schema)


AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)


def test_recency_bounds(spark):
    lo = AS_OF - dt.timedelta(days=7)
    f = _fact(spark, [
        (lo, "exact", "a", "r", 60000),
        (lo - dt.timedelta(microseconds=1), "before", "a", "r", 60000),
        (AS_OF + dt.timedelta(days=3), "future", "a", "r", 60000),
    ])
    got = sorted(r.song_id for r in R.recent(f, "2024-01-15 12:00:00", 7).collect())
    assert got == ["exact", "future"]


def test_recency_filter_reaches_the_scan(spark, tmp_path):
    f = _fact(spark, [(AS_OF, "s", "a", "r", 1)])
    p = str(tmp_path / "fact")
    f.write.parquet(p)
    plan = R.recent(spark.read.parquet(p), "2024-01-15 12:00:00", 7)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PushedFilters: [IsNotNull(played_at), GreaterThanOrEqual(played_at" in plan


def test_weekday_sunday_is_zero(spark):
    days = [dt.datetime(2024, 1, 7 + i, 10) for i in range(7)]   # Sun 7 Jan .. Sat 13 Jan
    f = _fact(spark, [(d, f"s{i}", "a", "r", 1) for i, d in enumerate(days)])
    got = {r.day_num: r.day_name for r in R.plays_by_weekday(f, "2024-01-14 00:00:00", 30).collect()}
    assert got[0] == "Sunday" and got[6] == "Saturday" and len(got) == 7
    padded = R.plays_by_weekday(f, "2024-01-14 00:00:00", 30, padded=True).collect()
    assert {len(r.day_name) for r in padded} == {9}


def test_parse_played_at_zones_and_bad_text(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00.000Z",), ("2024-01-01T12:00:00+02:00",),
                                ("yesterday",), (None,)], "t string")
    got = [r[0] for r in df.select(S.parse_played_at("t").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 10), None, None]


def test_format_played_at(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 7, 8, 9, 123456),)], "t timestamp")
    assert df.select(S.format_played_at("t")).first()[0] == "2024-03-05T07:08:09.000Z"


# ---------------------------------------------------- dims_names, ranks_tie
def _star(spark, fact, songs, artists=(("r", "Artist"),), albums=(("a", "Album"),)):
    return Star(fact=fact,
                song=spark.createDataFrame(songs, "song_id string, song_name string"),
                artist=spark.createDataFrame(list(artists), "artist_id string, artist_name string"),
                album=spark.createDataFrame(list(albums), "album_id string, album_name string"))


def test_same_name_two_ids_merge_and_unmatched_dropped(spark):
    t = AS_OF - dt.timedelta(hours=1)
    f = _fact(spark, [(t, "id1", "a", "r", 1), (t, "id2", "a", "r", 1), (t, "id3", "a", "r", 1),
                      (t, "ghost", "a", "r", 1)])
    star = _star(spark, f, [("id1", "Song"), ("id2", "Song"), ("id3", None)])
    got = rows(R.plays_by_name(f, star.song, "song_id", "song_name", AS_OF, 7))
    assert got == sorted([("Song", 2), (None, 1)], key=repr)
    totals = R.totals(f, AS_OF, 7).first()
    assert totals.total_plays == 4          # totals count the unmatched play too


def test_top_n_tie_break_by_name(spark):
    t = AS_OF - dt.timedelta(hours=1)
    names = ["f", "e", "d", "c", "b", "a"]
    f = _fact(spark, [(t, n, "a", "r", 1) for n in names])
    star = _star(spark, f, [(n, n.upper()) for n in names])
    got = [r.song_name for r in R.top_songs(star, AS_OF, n=5).collect()]
    assert got == ["A", "B", "C", "D", "E"]


# ------------------------------------------------------------ empty_window
def test_empty_window(spark):
    f = _fact(spark, [(dt.datetime(2020, 1, 1), "s", "a", "r", 60000)])
    star = _star(spark, f, [("s", "Song")])
    t = R.totals(f, AS_OF, 7).first()
    assert (t.total_plays, t.unique_songs, t.unique_artists, t.total_minutes) == (0, 0, 0, 0)
    stats = R.weekly_stats(star, AS_OF)
    s = stats.first()
    assert s.top_songs == [] and s.top_artists == [] and s.total_minutes == 0
    assert R.headline_top_song(stats).first().top_song == "none"
    d = G.digest(stats).first()
    assert "Top songs: \n" in d.prompt and d.preview.endswith("...")


def test_minutes_truncate(spark):
    t = AS_OF - dt.timedelta(hours=1)
    f = _fact(spark, [(t, "s", "a", "r", 59999), (t, "s2", "a", "r", 60000)])
    assert R.listening_minutes(f, AS_OF, 7).first().mins == 1


# ------------------------------------------------------------- digest_text
def test_digest_html_escapes_and_breaks(spark):
    stats = spark.createDataFrame(
        [([("<b>&\"x'", 3), ("line\nbreak", 1)], [("A&B", 2)], 42)],
        "top_songs array<struct<name:string,plays:bigint>>, "
        "top_artists array<struct<name:string,plays:bigint>>, total_minutes bigint")
    d = G.digest(stats).first()
    assert "<li>&lt;b&gt;&amp;&quot;x&#x27; — 3 plays</li>" in d.html
    assert "<li>A&amp;B — 2 plays</li>" in d.html
    body = d.html.split("</p>")[0]
    assert "<br>" in body and "\n" not in body
    assert "- Top songs: <b>&\"x' (3 plays), line\nbreak (1 plays)" in d.prompt


@pytest.mark.parametrize("n", [0, 199, 200, 201])
def test_preview_lengths(spark, n):
    text = "x" * n
    got = spark.createDataFrame([(text,)], "t string").select(S.preview("t")).first()[0]
    assert got == text[:200] + "..."


# ---------------------------------------------------------- payload_nested
def test_payload_flatten(spark, tmp_path):
    from playmart.sources.payload import flatten_payload, payload_counts, read_payloads
    import json
    docs = [
        {"id": 1},                                                     # no items
        {"id": 2, "items": [{"played_at": "t", "track": {"name": "n", "artists": []}}]},
        {"id": 3, "items": [{"played_at": f"t{i}", "track": {"name": f"s{i}",
                                                               "artists": [{"name": "A"}]}}
                            for i in range(51)]},
    ]
    p = tmp_path / "payloads"
    p.mkdir()
    (p / "part-0.json").write_text("\n".join(json.dumps(d) for d in docs))
    extra = T.StructType([T.StructField("id", T.IntegerType())])
    pl = read_payloads(spark, str(p), extra)
    flat = flatten_payload(pl, id_cols=("id",))
    counts = dict(rows(payload_counts(pl, id_cols=("id",))))
    assert counts == {1: 0, 2: 1, 3: 51}
    by_id = {}
    for r in flat.collect():
        by_id.setdefault(r.id, []).append(r)
    assert 1 not in by_id
    assert by_id[2][0].artist is None
    assert len(by_id[3]) == 51 and max(r.pos for r in by_id[3]) == 51


# ------------------------------------------------------------- catalog_csv
def test_catalog_csv_defaults_and_strip(spark, tmp_path):
    from playmart.sources.catalog import drop_incomplete, read_catalog_csv
    from playmart.operators.fanout import fanout
    p = tmp_path / "cat"
    p.mkdir()
    (p / "c.csv").write_text(
        "track_id,track_name,artists,album_name,duration_ms,explicit\n"
        "t1,One,['A'],Al,1000,True\n"
        "t2,,['B'],Al,2000,False\n"
        "t3,Three,[x,Al,abc,False\n"
        "t4,Four,'y',Al,4000,\n")
    cat = read_catalog_csv(spark, str(p))
    full = drop_incomplete(cat)
    got = {r.track_id: r for r in full.collect()}
    assert set(got) == {"t1", "t3", "t4"}
    assert got["t1"].popularity == 50 and got["t1"].release_date == "2023-01-01"
    assert got["t1"].track_number == 10
    assert got["t3"].duration_ms is None          # bad cell -> NULL, no abort
    recs = fanout(full.withColumn("played_ts", F.lit(AS_OF)))
    names = {r.value for r in recs.filter("topic = 'artist_topic'").collect()}
    stripped = sorted(v.split('"artist_name":"')[1].split('"')[0] for v in names)
    assert stripped == ["A", "x", "y"]
    assert recs.count() == 4 * full.count()


# -------------------------------------------------------------- plays_dups
def test_dedup_batch_is_deterministic(spark):
    from playmart.operators.dedup import dedup_batch
    t = AS_OF
    f = _fact(spark, [(t, "s", "b", "r", 1), (t, "s", "a", "r", 2), (t, None, "z", "r", 3),
                      (t, None, "y", "r", 4)])
    got = rows(dedup_batch(f, ("played_at", "song_id"), ("album_id",)))
    assert got == sorted([(t, "s", "a", "r", 2), (t, None, "y", "r", 4)], key=repr)


def test_insert_if_absent_existing_row_wins_and_replay_is_noop(spark, tmp_path):
    from playmart.schemas import FACT_HISTORY
    from playmart.sinks.loader import Warehouse, load_table
    wh = Warehouse(spark, str(tmp_path / "wh"))
    t = AS_OF
    first = _fact(spark, [(t, "s", "a", "r", 1), (t, "s", "a", "r", 1)])
    second = _fact(spark, [(t, "s", "other", "r", 9), (t + dt.timedelta(seconds=1), "s", "a", "r", 1)])
    assert load_table(first, FACT_HISTORY, wh, "b1") == 1
    assert load_table(second, FACT_HISTORY, wh, "b2") == 1
    assert load_table(second, FACT_HISTORY, wh, "b2") == 0          # replay of the same batch
    got = rows(wh.read("fact_history").select("played_at", "album_id"))
    assert got == sorted([(t, "a"), (t + dt.timedelta(seconds=1), "a")], key=repr)
    empty = first.limit(0)
    assert load_table(empty, FACT_HISTORY, wh, "b3") == 0
    m = wh.metrics().collect()
    assert {r.batch_id for r in m} == {"b1", "b2"}                   # empty batch skipped


def test_dimension_ids_continue_after_high_water(spark, tmp_path):
    from playmart.schemas import DIM_SONG
    from playmart.sinks.loader import Warehouse, load_table
    wh = Warehouse(spark, str(tmp_path / "wh"))
    songs = "song_id string, song_name string"
    load_table(spark.createDataFrame([("b", "B"), ("a", "A")], songs), DIM_SONG, wh, "1")
    load_table(spark.createDataFrame([("c", "C"), ("a", "A2")], songs), DIM_SONG, wh, "2")
    got = rows(wh.read("dim_song").select("song_id", "song_name", "id"))
    assert got == [("a", "A", 1), ("b", "B", 2), ("c", "C", 3)]


# ------------------------------------------------------------ properties
def test_row_index_dense_and_ordered(spark):
    from playmart.operators.ids import with_row_index
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7 % 5000).alias("k"))
    out = with_row_index(df, ["k"], start=1, col="rid")
    got = [(r.k, r.rid) for r in out.collect()]
    assert sorted(x[1] for x in got) == list(range(1, 5001))
    assert all(rid == k + 1 for k, rid in got)


def test_sample_with_replacement_exact_n(spark):
    from playmart.sources.sampling import sample_with_replacement
    df = spark.range(10).toDF("x")
    assert sample_with_replacement(df, 200).count() == 10          # n capped at the table size
    big = spark.range(1000).toDF("x")
    s = sample_with_replacement(big, 300, seed=7)
    assert s.count() == 300 and s.filter("x < 0 OR x >= 1000").count() == 0


def test_contract_checks(spark):
    from playmart.operators.contracts import check_contract
    from playmart.schemas import DIM_ARTIST
    df = spark.createDataFrame([("a", "x" * 301, "u"), ("a", "ok", "u"), (None, "n", "u"),
                                (None, "n", "u")], "artist_id string, artist_name string, "
                                                   "external_url string")
    got = {r.check_name: r.violations for r in check_contract(df, DIM_ARTIST).collect()}
    assert got["not_null:artist_id"] == 2
    assert got["max_len:artist_name"] == 1
    assert got["unique:artist_id"] == 1                      # NULL keys do not conflict


def test_scalar_properties(spark):
    from hypothesis import given, settings, strategies as st
    samples = []

    @settings(max_examples=200, database=None)
    @given(st.text(alphabet=st.sampled_from(list("ab []'<>&\"\n")), max_size=30))
    def collect(s):
        samples.append(s)

    collect()
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    out = df.select("t", S.strip_chars("t").alias("s"), S.preview("t", 5).alias("p"),
                    S.html_escape("t").alias("h")).collect()
    import html
    for r in out:
        assert r.s == r.t.strip("[]'")
        assert r.p == r.t[:5] + "..."
        assert html.unescape(r.h) == r.t and "<" not in r.h


def test_per_group_reports(spark):
    t = AS_OF - dt.timedelta(hours=1)
    schema = "played_at timestamp, song_id string, album_id string, artist_id string, " \
             "duration_ms int, user_id string"
    f = spark.createDataFrame([(t, "a", "x", "r", 60000, "u1"), (t, "a", "x", "r", 60000, "u1"),
                               (t, "b", "x", "r", 60000, "u1"), (t, "b", "x", "q", 120000, "u2")],
                              schema)
    star = _star(spark, f, [("a", "A"), ("b", "B")], artists=(("r", "R"), ("q", "Q")))
    stats = {r.user_id: r for r in R.weekly_stats(star, AS_OF, n=1, group_cols=("user_id",))
             .collect()}
    assert [(x.name, x.plays) for x in stats["u1"].top_songs] == [("A", 2)]
    assert [(x.name, x.plays) for x in stats["u2"].top_artists] == [("Q", 1)]
    assert stats["u1"].total_minutes == 3 and stats["u2"].total_minutes == 2
    tops = rows(R.top_songs(star, AS_OF, n=1, group_cols=("user_id",)))
    assert tops == [("u1", "A", 2), ("u2", "B", 1)]
    totals = {r.user_id: r.total_plays for r in R.totals(f, AS_OF, group_cols=("user_id",)).collect()}
    assert totals == {"u1": 3, "u2": 1}


def test_top_n_per_group_matches_single_stage(spark):
    from pyspark.sql import Window
    from playmart.operators.topn import top_n_per_group
    df = spark.range(0, 3000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") % 997).cast("string").alias("item"),
        ((F.col("id") * 7919) % 50).alias("plays"))
    order = [F.col("plays").desc(), F.col("item").asc_nulls_last()]
    got = rows(top_n_per_group(df, ["g"], order, 5, "item", buckets=7, rank_col="rank"))
    w = Window.partitionBy("g").orderBy(*order)
    want = rows(df.withColumn("rank", F.row_number().over(w)).filter("rank <= 5"))
    assert got == want


def test_default_clock_is_now(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    f = _fact(spark, [(now - dt.timedelta(hours=1), "recent", "a", "r", 1),
                      (now - dt.timedelta(days=8), "old", "a", "r", 1)])
    assert [r.song_id for r in R.recent(f, None, 7).collect()] == ["recent"]


def test_connector_options(monkeypatch):
    from playmart.sinks.jdbc import jdbc_properties
    from playmart.sources.topics import kafka_options
    monkeypatch.setenv("PLAYMART_JDBC_USER", "u")
    monkeypatch.setenv("PLAYMART_JDBC_PASSWORD", "p")
    monkeypatch.setenv("PLAYMART_JDBC_DRIVER", "org.example.Driver")
    assert jdbc_properties() == {"user": "u", "password": "p", "driver": "org.example.Driver"}
    opts = kafka_options("b:9092", "item_topic", "earliest", {"maxOffsetsPerTrigger": "1000"})
    assert opts["subscribe"] == "item_topic" and opts["startingOffsets"] == "earliest"
    assert opts["kafka.bootstrap.servers"] == "b:9092" and opts["maxOffsetsPerTrigger"] == "1000"


def test_plays_by_song_sums_to_joined_plays(spark):
    from conftest import SF_SMALL
    from playmart.plans import fixtures as X
    star = X.star(spark, SF_SMALL)
    as_of = X.fact_as_of(spark, SF_SMALL)
    by_name = R.plays_by_name(star.fact, star.song, "song_id", "song_name", as_of, 30)
    joined = R.recent(star.fact, as_of, 30).join(star.song, "song_id").count()
    assert by_name.agg(F.sum("plays")).first()[0] == joined > 0


def test_stats_list_order_puts_null_names_last(spark):
    t = AS_OF - dt.timedelta(hours=1)
    f = _fact(spark, [(t, "n", "a", "r", 1), (t, "b", "a", "r", 1), (t, "b", "a", "r", 1),
                      (t, "c", "a", "r", 1)])
    star = _star(spark, f, [("n", None), ("b", "B"), ("c", "C")])
    s = R.weekly_stats(star, AS_OF, n=5).first()
    assert [(x.name, x.plays) for x in s.top_songs] == [("B", 2), ("C", 1), (None, 1)]


def test_cluster_conf_sizes_shuffles_by_cores():
    from playmart.session import DEFAULT_CONF, cluster_conf
    c = cluster_conf(4000)
    assert c["spark.sql.shuffle.partitions"] == "12000"
    assert c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "12000"
    assert cluster_conf(8)["spark.sql.shuffle.partitions"] == "200"
    assert c["spark.sql.streaming.stateStore.providerClass"] == \
        DEFAULT_CONF["spark.sql.streaming.stateStore.providerClass"]


def test_quarantine_matches_a_plain_python_reading(spark):
    import json as _json
    from hypothesis import given, settings, strategies as st
    values = []
    field = st.one_of(st.none(), st.integers(-5, 5), st.text("ab", max_size=2),
                      st.floats(allow_nan=False, allow_infinity=False, width=16))
    record = st.fixed_dictionaries({}, optional={"song_id": field, "duration_ms": field})
    junk = st.sampled_from(["", "x", "[]", "[1]", "{", "null", "1"])

    @settings(max_examples=150, database=None)
    @given(st.one_of(record.map(_json.dumps), junk))
    def collect(v):
        values.append(v)

    collect()

    def expected(v):
        try:
            obj = _json.loads(v)
        except ValueError:
            return "malformed" if v.strip() else "null_key"
        if not isinstance(obj, dict):
            return "malformed"
        sid, dur = obj.get("song_id"), obj.get("duration_ms")
        # a string field takes any JSON scalar as its text; an int field only a JSON integer
        bad_type = dur is not None and (isinstance(dur, (bool, str, float)))
        if bad_type:
            return "malformed"
        return "null_key" if sid is None else None

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], TOPIC_ROWS)
    got = dict(rows(D.classify(D.parse_values(df, PLAY_RECORD, keep=("id",)), PLAY_RECORD,
                               ("song_id",)).select("id", "_reject")))
    mismatches = [(values[i], got[i], expected(values[i])) for i in got
                  if got[i] != expected(values[i])]
    assert not mismatches, mismatches[:5]


def test_payload_pretty_printed_documents(spark, tmp_path):
    import json
    from playmart.sources.payload import flatten_payload, read_payloads
    p = tmp_path / "docs"
    p.mkdir()
    for i in range(2):
        doc = {"items": [{"played_at": f"t{i}", "track": {"name": f"s{i}",
                                                          "artists": [{"name": "A"}]}}]}
        (p / f"resp-{i}.json").write_text(json.dumps(doc, indent=2))
    flat = flatten_payload(read_payloads(spark, str(p), multiline=True))
    assert sorted(r.name for r in flat.collect()) == ["s0", "s1"]


def test_catalog_csv_quoting(spark, tmp_path):
    from playmart.sources.catalog import read_catalog_csv
    p = tmp_path / "cat"
    p.mkdir()
    (p / "c.csv").write_text(
        'track_id,track_name,artists,album_name\n'
        't1,"Say ""Hi""","[\'A\', \'B\']","Al, Vol. 1"\n')
    r = read_catalog_csv(spark, str(p)).first()
    assert (r.track_name, r.artists, r.album_name) == ('Say "Hi"', "['A', 'B']", "Al, Vol. 1")


def test_totals_approximate_distinct_is_close(spark):
    from conftest import SF_SMALL
    from playmart.plans import fixtures as X
    star = X.star(spark, SF_SMALL)
    as_of = X.fact_as_of(spark, SF_SMALL)
    exact = R.totals(star.fact, as_of, 365).first()
    approx = R.totals(star.fact, as_of, 365, approximate=True).first()
    assert approx.total_plays == exact.total_plays
    for c in ("unique_songs", "unique_artists"):
        assert abs(approx[c] - exact[c]) <= max(2, 0.05 * exact[c])


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    import glob
    from playmart.schemas import DIM_SONG, FACT_HISTORY
    from playmart.sinks.compact import compact_fact_days, compact_table
    from playmart.sinks.loader import Warehouse, load_table
    wh = Warehouse(spark, str(tmp_path / "wh"))
    base = dt.datetime(2024, 1, 1, 10)
    for b in range(4):                       # four small batches on two days
        plays = [(base + dt.timedelta(days=i % 2, minutes=b * 10 + i), f"s{b}{i}", "a", "r", 1)
                 for i in range(4)]
        load_table(_fact(spark, plays), FACT_HISTORY, wh, f"f{b}")
        load_table(spark.createDataFrame([(f"s{b}", f"S{b}")], "song_id string, song_name string"),
                   DIM_SONG, wh, f"d{b}")
    root = str(tmp_path / "wh")
    files = lambda p: len(glob.glob(f"{root}/{p}/*.parquet"))
    before = wh.read("fact_history").orderBy("played_at", "song_id").collect()
    assert files("fact_history/play_date=2024-01-01") > 1
    assert compact_fact_days(wh, ["2024-01-01"]) == 8
    assert files("fact_history/play_date=2024-01-01") == 1
    assert files("fact_history/play_date=2024-01-02") > 1       # other days untouched
    assert wh.read("fact_history").orderBy("played_at", "song_id").collect() == before
    ids = rows(wh.read("dim_song").select("song_id", "id"))
    assert compact_table(wh, "dim_song") == 4 and files("dim_song") == 1
    assert rows(wh.read("dim_song").select("song_id", "id")) == ids


def test_compaction_of_missing_days_is_a_no_op(spark, tmp_path):
    from playmart.sinks.compact import compact_fact_days
    from playmart.sinks.loader import Warehouse
    assert compact_fact_days(Warehouse(spark, str(tmp_path / "none")), ["2024-01-01"]) == 0


def test_catalog_csv_line_breaks_and_decimal_numbers(spark, tmp_path):
    from playmart.sources.catalog import drop_incomplete, read_catalog_csv
    p = tmp_path / "cat"
    p.mkdir()
    (p / "c.csv").write_text(
        'track_id,track_name,artists,album_name,duration_ms\n'
        't1,"Two\nlines",A,Al,215000.0\n'
        't2,Short,A,Al\n'
        't3,Plain,A,Al,1000\n')
    got = {r.track_id: r for r in drop_incomplete(read_catalog_csv(spark, str(p))).collect()}
    assert set(got) == {"t1", "t2", "t3"}
    assert got["t1"].track_name == "Two\nlines" and got["t1"].duration_ms == 215000
    bad = read_catalog_csv(spark, str(p), reject_col="bad").filter("bad IS NOT NULL").collect()
    assert [(r.track_id, r.bad) for r in bad] == [("t2", "t2,Short,A,Al")]
