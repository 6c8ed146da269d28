"""DuckDB SQL twins of the registered queries (run on the driver's views).

Each string reads the pre-registered views ``lineitem part supplier orders
events`` and maps them to the star exactly as ``plans.fixtures`` does.
"""

from __future__ import annotations

FACT = """fact AS (
  SELECT l_shipdate AS played_at, l_partkey AS song_id, l_orderkey AS album_id,
         l_suppkey AS artist_id, CAST(l_quantity * 10000 AS INTEGER) AS duration_ms
  FROM lineitem)"""
SONG = "song AS (SELECT p_partkey AS song_id, p_name AS song_name FROM part)"
ARTIST = "artist AS (SELECT s_suppkey AS artist_id, s_name AS artist_name FROM supplier)"
ALBUM = "album AS (SELECT o_orderkey AS album_id, o_orderpriority AS album_name FROM orders)"
ASOF = "(SELECT max(l_shipdate) FROM lineitem)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def window(days: int) -> str:
    return f"played_at >= {ASOF} - INTERVAL {days} DAY"


def plays_by(dim_cte: str, dim: str, key: str, name: str, days: int = 7) -> str:
    return (_with(FACT, dim_cte) +
            f"SELECT d.{name}, COUNT(*) AS plays FROM fact f JOIN {dim} d ON f.{key} = d.{key}"
            f" WHERE {window(days)} GROUP BY d.{name}")


def top(dim_cte, dim, key, name, n, days=7) -> str:
    return (plays_by(dim_cte, dim, key, name, days) +
            f" ORDER BY plays DESC, {name} ASC NULLS LAST LIMIT {n}")


TOTALS = (_with(FACT) + f"""SELECT COUNT(*) AS total_plays,
  COUNT(DISTINCT song_id) AS unique_songs, COUNT(DISTINCT artist_id) AS unique_artists,
  CAST(COALESCE(SUM(duration_ms) // 60000, 0) AS BIGINT) AS total_minutes
FROM fact WHERE {window(7)}""")

MINUTES = (_with(FACT) + f"""SELECT CAST(COALESCE(SUM(duration_ms) // 60000, 0) AS BIGINT) AS mins
FROM fact WHERE {window(7)}""")

WEEKDAY = (_with(FACT) + f"""SELECT dayname(played_at) AS day_name,
  CAST(dayofweek(played_at) AS INTEGER) AS day_num, COUNT(*) AS plays
FROM fact WHERE {window(30)} GROUP BY 1, 2 ORDER BY day_num""")

WEEKDAY_PADDED = (_with(FACT) + f"""SELECT rpad(dayname(played_at), 9, ' ') AS day_name,
  CAST(dayofweek(played_at) AS INTEGER) AS day_num, COUNT(*) AS plays
FROM fact WHERE {window(30)} GROUP BY 1, 2 ORDER BY day_num""")

HOURS = (_with(FACT) + f"""SELECT CAST(played_at AS DATE) AS play_date,
  CAST(SUM(duration_ms) AS BIGINT) / 3600000.0 AS listening_hours
FROM fact WHERE {window(30)} GROUP BY 1""")

RECENT_ORDER = ("played_at DESC NULLS LAST, song_id ASC NULLS LAST, album_id ASC NULLS LAST,"
                " artist_id ASC NULLS LAST, duration_ms ASC NULLS LAST")

RECENT = (_with(FACT, SONG, ARTIST, ALBUM) + f"""SELECT played_at, song_name, artist_name, album_name
FROM fact JOIN song USING (song_id) JOIN artist USING (artist_id) JOIN album USING (album_id)
ORDER BY {RECENT_ORDER} LIMIT 20""")

LATEST = (_with(FACT) + f"SELECT * FROM fact ORDER BY {RECENT_ORDER}")

def _top_cte(dim, key, name, n=5, days=7) -> str:
    return (f"SELECT d.{name} AS name, COUNT(*) AS plays FROM fact f JOIN {dim} d"
            f" ON f.{key} = d.{key} WHERE {window(days)} GROUP BY d.{name}"
            f" ORDER BY plays DESC, name ASC NULLS LAST LIMIT {n}")


STATS = (_with(FACT, SONG, ARTIST,
               f"ts AS ({_top_cte('song', 'song_id', 'song_name')})",
               f"ta AS ({_top_cte('artist', 'artist_id', 'artist_name')})",
               f"m AS (SELECT CAST(COALESCE(SUM(duration_ms) // 60000, 0) AS BIGINT) AS mins"
               f" FROM fact WHERE {window(7)})") +
         """SELECT 'songs' AS list,
  CAST(row_number() OVER (ORDER BY plays DESC, name ASC NULLS LAST) AS INTEGER) AS pos,
  name, plays, m.mins AS total_minutes FROM ts, m
UNION ALL
SELECT 'artists' AS list,
  CAST(row_number() OVER (ORDER BY plays DESC, name ASC NULLS LAST) AS INTEGER) AS pos,
  name, plays, m.mins AS total_minutes FROM ta, m""")

HEADLINE = (_with(FACT, SONG, f"ts AS ({_top_cte('song', 'song_id', 'song_name')})",
                  f"m AS (SELECT CAST(COALESCE(SUM(duration_ms) // 60000, 0) AS BIGINT) AS mins"
                  f" FROM fact WHERE {window(7)})") +
            """SELECT m.mins AS total_minutes,
  COALESCE((SELECT name FROM ts ORDER BY plays DESC, name ASC NULLS LAST LIMIT 1), 'none') AS top_song
FROM m""")


# ------------------------------------------------------- decode fixtures
BAD = "event_id % 20 = 0"
NOKEY = "event_id % 20 = 10"
ISO_MICRO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
ISO_SEC = "'%Y-%m-%dT%H:%M:%S.000Z'"

DECODE = f"""SELECT CASE WHEN {BAD} THEN NULL ELSE strftime(ts, {ISO_MICRO}) END AS played_at,
  CASE WHEN {BAD} OR {NOKEY} THEN NULL ELSE json_extract_string(props, '$.k') END AS song_id,
  CASE WHEN {BAD} THEN NULL ELSE event_type END AS album_id,
  CASE WHEN {BAD} THEN NULL ELSE CAST(user_id AS VARCHAR) END AS artist_id,
  CASE WHEN {BAD} THEN NULL ELSE CAST(ROUND(value * 1000) AS INTEGER) END AS duration_ms
FROM events"""

PARSE = f"""SELECT CASE WHEN {BAD} THEN NULL ELSE ts END AS played_at,
  CASE WHEN {BAD} OR {NOKEY} THEN NULL ELSE json_extract_string(props, '$.k') END AS song_id,
  CASE WHEN {BAD} THEN NULL ELSE CAST(ROUND(value * 1000) AS INTEGER) END AS duration_ms
FROM events"""

QUARANTINE = f"""SELECT CASE WHEN {BAD} THEN 'malformed' WHEN {NOKEY} THEN 'null_key'
  ELSE 'accepted' END AS status, COUNT(*) AS rows FROM events GROUP BY 1"""

# --------------------------------------------------------------- catalogue
ARTISTS_TEXT = "'[''' || p_brand || ''']'"
CAT = f"""cat AS (SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_name AS track_name,
  {ARTISTS_TEXT} AS artists, p_type AS album_name, p_size * 10000 AS duration_ms,
  p_size > 25 AS explicit, p_size * 2 AS popularity, p_partkey FROM part)"""

CATALOG_SCAN = _with(CAT) + """SELECT track_id,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE track_name END AS track_name,
  artists, album_name, duration_ms, explicit, popularity,
  '2023-01-01' AS release_date, 10 AS track_number FROM cat"""

CATALOG_COMPLETE = CATALOG_SCAN + " WHERE p_partkey % 10 <> 0"

DEFAULTS = _with(CAT) + """SELECT track_id, duration_ms, explicit, popularity,
  '2023-01-01' AS release_date, 10 AS track_number FROM cat"""

STABLE_KEYS = _with(CAT) + """SELECT DISTINCT 'album' AS kind, album_name AS name,
  'album_' || substr(md5(album_name), 1, 16) AS key FROM cat
UNION
SELECT DISTINCT 'artist' AS kind, artists AS name,
  'artist_' || substr(md5(artists), 1, 16) AS key FROM cat"""

STRIP = _with(CAT) + "SELECT track_id, trim(artists, '[]''') AS artist_name FROM cat"

BOOL_LABEL = _with(CAT) + """SELECT track_id,
  CASE WHEN explicit THEN 'True' ELSE 'False' END AS explicit_label FROM cat"""

TRUNC = """SELECT event_id, CAST(trunc(value) AS INTEGER) AS value_int,
  CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
  TRY_CAST(event_type AS INTEGER) AS type_int FROM events"""

FORMAT_TS = _with(FACT) + f"SELECT played_at, strftime(played_at, {ISO_SEC}) AS played_at_text FROM fact"

# ----------------------------------------------------------------- fan-out
WIDE = """w AS (SELECT cat.*, l.l_shipdate AS played_ts,
  'album_' || substr(md5(album_name), 1, 16) AS album_id,
  'artist_' || substr(md5(artists), 1, 16) AS artist_id
  FROM lineitem l JOIN cat ON CAST(l.l_partkey AS VARCHAR) = cat.track_id)"""

ARTIST_URL = "https://open.example.com/artist/"
RECORD_SQL = {
    "song_topic": ("track_id", """json_object('song_id', track_id, 'song_name', track_name,
      'duration', duration_ms, 'explicit', CASE WHEN explicit THEN 'True' ELSE 'False' END,
      'popularity', popularity)"""),
    "album_topic": ("album_id", """json_object('album_id', album_id, 'album_name', album_name,
      'album_type', 'album', 'release_date', '2023-01-01', 'total_tracks', 10)"""),
    "artist_topic": ("artist_id", f"""json_object('artist_id', artist_id,
      'artist_name', trim(artists, '[]'''), 'external_url', '{ARTIST_URL}' || artist_id)"""),
    "item_topic": ("track_id", f"""json_object('played_at', strftime(played_ts, {ISO_SEC}),
      'song_id', track_id, 'album_id', album_id, 'artist_id', artist_id,
      'duration_ms', duration_ms)"""),
}


def topic_sql(topic: str, with_topic: bool) -> str:
    key, val = RECORD_SQL[topic]
    t = f"'{topic}' AS topic, " if with_topic else ""
    return f"SELECT {t}{key} AS key, CAST({val} AS VARCHAR) AS value FROM w"


ALL_TOPICS = "\nUNION ALL\n".join(topic_sql(t, True) for t in RECORD_SQL)
FANOUT_ALL = _with(CAT, WIDE) + ALL_TOPICS
ENCODE = (_with(CAT, WIDE, f"r AS ({ALL_TOPICS})") + """SELECT topic, hex(encode(key)) AS key_hex,
  md5(value) AS value_md5 FROM r""")

# ----------------------------------------------------------------- payload
PAYLOAD_ROWS = f"""SELECT l_orderkey AS payload_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber,
    l_partkey, l_suppkey, l_quantity) AS INTEGER) AS pos,
  p_name AS name, s_name AS artist, strftime(l_shipdate, {ISO_SEC}) AS played_at
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey"""

PAYLOAD_COUNTS = """SELECT l_orderkey AS payload_id, CAST(COUNT(*) AS INTEGER) AS count
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
GROUP BY 1"""


# ------------------------------------------------------------------ digest
def _esc(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'),"
            f" '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')")


def _lists(src: str) -> str:
    order = "ORDER BY plays DESC, name ASC NULLS LAST"
    return (f"SELECT COALESCE(string_agg(COALESCE(name, '') || ' (' || plays || ' plays)', ', '"
            f" {order}), '') AS txt, COALESCE(string_agg('<li>' || {_esc('COALESCE(name, ' + chr(39) * 2 + ')')}"
            f" || ' — ' || plays || ' plays</li>', '' {order}), '') AS li FROM {src}")


DIGEST_BASE = _with(
    FACT, SONG, ARTIST,
    f"ts AS ({_top_cte('song', 'song_id', 'song_name')})",
    f"ta AS ({_top_cte('artist', 'artist_id', 'artist_name')})",
    f"m AS (SELECT CAST(COALESCE(SUM(duration_ms) // 60000, 0) AS BIGINT) AS mins"
    f" FROM fact WHERE {window(7)})",
    f"sl AS ({_lists('ts')})",
    f"al AS ({_lists('ta')})",
    """p AS (SELECT 'Write a short, upbeat weekly listening summary for one listener.' || chr(10)
    || 'Listening in the past 7 days:' || chr(10)
    || '- Total listening time: ' || m.mins || ' minutes' || chr(10)
    || '- Top songs: ' || sl.txt || chr(10)
    || '- Top artists: ' || al.txt || chr(10)
    || 'Three paragraphs of prose, under 200 words.' AS prompt,
    m.mins AS mins, sl.li AS sli, al.li AS ali FROM m, sl, al)""")

DIGEST_PROMPT = DIGEST_BASE + "SELECT prompt FROM p"
DIGEST_HTML = DIGEST_BASE + (
    "SELECT '<html><body><h1>Your Weekly Listening</h1><p>' || replace(" + _esc("prompt")
    + ", chr(10), '<br>') || '</p><h3>By the Numbers</h3>"
    "<p><strong>Total listening time:</strong> ' || mins || ' minutes</p>"
    "<h4>Top Songs</h4><ol>' || sli || '</ol><h4>Top Artists</h4><ol>' ||"
    " ali || '</ol></body></html>' AS html FROM p")
PREVIEW = DIGEST_BASE + "SELECT substr(prompt, 1, 200) || '...' AS preview FROM p"
NL_BREAK = DIGEST_BASE + "SELECT replace(prompt, chr(10), '<br>') AS text_html FROM p"


# ------------------------------------------------------------ stream fixtures
EW = """ew AS (SELECT e.ts AS played_ts, json_extract_string(e.props, '$.k') AS track_id,
  'user_' || CAST(e.user_id AS VARCHAR) AS artists, e.event_type AS album_name,
  p.p_name AS track_name, p.p_size * 10000 AS duration_ms, p.p_size > 25 AS explicit,
  p.p_size * 2 AS popularity,
  'album_' || substr(md5(e.event_type), 1, 16) AS album_id,
  'artist_' || substr(md5('user_' || CAST(e.user_id AS VARCHAR)), 1, 16) AS artist_id
  FROM events e JOIN part p ON CAST(p.p_partkey AS VARCHAR) = json_extract_string(e.props, '$.k'))"""

EV_SONG = """SELECT DISTINCT track_id AS song_id, track_name AS song_name, duration_ms AS duration,
  CASE WHEN explicit THEN 'True' ELSE 'False' END AS explicit, popularity FROM ew"""
EV_ALBUM = """SELECT DISTINCT album_id, album_name, 'album' AS album_type,
  '2023-01-01' AS release_date, 10 AS total_tracks FROM ew"""
EV_ARTIST = f"""SELECT DISTINCT artist_id, trim(artists, '[]''') AS artist_name,
  '{ARTIST_URL}' || artist_id AS external_url FROM ew"""
EV_PLAY_KEYS = "SELECT DISTINCT date_trunc('second', played_ts) AS played_at, track_id AS song_id FROM ew"
EV_FACT = """SELECT date_trunc('second', played_ts) AS played_at, track_id AS song_id, album_id,
  artist_id, duration_ms FROM ew
QUALIFY row_number() OVER (PARTITION BY date_trunc('second', played_ts), track_id
  ORDER BY album_id, artist_id, duration_ms) = 1"""

EV_COUNTS = _with(EW) + """SELECT 'dim_song' AS table_name, COUNT(DISTINCT track_id) AS rows FROM ew
UNION ALL SELECT 'dim_album', COUNT(DISTINCT album_id) FROM ew
UNION ALL SELECT 'dim_artist', COUNT(DISTINCT artist_id) FROM ew
UNION ALL SELECT 'fact_history', COUNT(*) FROM (SELECT DISTINCT date_trunc('second', played_ts),
  track_id FROM ew)"""

EV_ITEM_JSON = f"""SELECT 'item_topic' AS topic, track_id AS key,
  CAST(json_object('played_at', strftime(played_ts, {ISO_SEC}), 'song_id', track_id,
  'album_id', album_id, 'artist_id', artist_id, 'duration_ms', duration_ms) AS VARCHAR) AS value
FROM ew"""

EV_SONG_ALL = """SELECT track_id AS song_id, track_name AS song_name, duration_ms AS duration,
  CASE WHEN explicit THEN 'True' ELSE 'False' END AS explicit, popularity FROM ew"""

DAY = "CAST(date_trunc('day', played_ts) AS TIMESTAMP)"


# one row per play: the loader keeps one of the copies of a (second, song)
PLAYS = """plays AS (SELECT * FROM ew
QUALIFY row_number() OVER (PARTITION BY date_trunc('second', played_ts), track_id
  ORDER BY album_id, artist_id, duration_ms) = 1)"""


def _roll_sql(group: str | None, cols: str) -> str:
    g = f", {group}" if group else ""
    return (_with(EW, PLAYS) + f"SELECT {DAY} AS window_start{g}, {cols} FROM plays GROUP BY {DAY}{g}")


ROLL_SONG = _roll_sql("track_id AS song_id", "COUNT(*) AS plays").replace(
    "GROUP BY " + DAY + ", track_id AS song_id", "GROUP BY " + DAY + ", track_id")
ROLL_TIME = _roll_sql(None, "COUNT(*) AS plays, CAST(SUM(duration_ms) AS BIGINT) AS listening_ms")
ROLL_ARTIST = _roll_sql("artist_id", "COUNT(*) AS plays, CAST(SUM(duration_ms) AS BIGINT) AS listening_ms")
ROLL_DISTINCT = _with(EW, PLAYS) + f"""SELECT {DAY} AS window_start, COUNT(DISTINCT track_id) AS distinct_items
FROM plays GROUP BY 1"""


def _roll_top(item_expr: str, item: str) -> str:
    return (_with(EW, PLAYS) + f"""SELECT window_start, rank, {item}, plays FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start
    ORDER BY plays DESC, {item} ASC NULLS LAST) AS INTEGER) AS rank
  FROM (SELECT {DAY} AS window_start, {item_expr} AS {item}, COUNT(*) AS plays
        FROM plays GROUP BY 1, 2)) WHERE rank <= 5""")


ROLL_TOP_SONGS = _roll_top("track_id", "song_id")
ROLL_TOP_ALBUMS = _roll_top("album_id", "album_id")


REFRESH_TOP = _with(EW, """plays AS (SELECT DISTINCT date_trunc('second', played_ts) AS played_at,
  track_id FROM ew)""", """named AS (SELECT p.played_at, pt.p_name AS song_name FROM plays p
  JOIN part pt ON CAST(pt.p_partkey AS VARCHAR) = p.track_id)""") + """SELECT song_name,
  COUNT(*) AS plays FROM named
WHERE played_at >= (SELECT max(played_at) FROM plays) - INTERVAL 7 DAY
GROUP BY song_name ORDER BY plays DESC, song_name ASC NULLS LAST LIMIT 10"""


# a window of a day starts every six hours; a play is in the four that hold it
ROLL_SLIDING = _with(EW, PLAYS) + """SELECT window_start, artist_id, COUNT(*) AS plays,
  CAST(SUM(duration_ms) AS BIGINT) AS listening_ms
FROM (SELECT artist_id, duration_ms, unnest([time_bucket(INTERVAL 6 HOUR, date_trunc('second', played_ts),
        TIMESTAMP '1970-01-01') - k * INTERVAL 6 HOUR for k in range(4)]) AS window_start FROM plays)
GROUP BY window_start, artist_id"""


def _refresh_sql(select: str, days_back: int) -> str:
    return (_with(EW, PLAYS, "facts AS (SELECT date_trunc('second', played_ts) AS played_at, track_id,"
                  " artist_id, duration_ms FROM plays)",
                  f"live AS (SELECT * FROM facts WHERE played_at >= (SELECT max(played_at) FROM facts)"
                  f" - INTERVAL {days_back} DAY)") + select)


TOTALS_SELECT = """SELECT COUNT(*) AS total_plays, COUNT(DISTINCT track_id) AS unique_songs,
  COUNT(DISTINCT artist_id) AS unique_artists,
  CAST(COALESCE(SUM(duration_ms), 0) // 60000 AS BIGINT) AS total_minutes FROM live"""
WEEKDAY_SELECT = """SELECT strftime(played_at, '%A') AS day_name,
  CAST(date_part('dow', played_at) AS INTEGER) AS day_num, COUNT(*) AS plays FROM live GROUP BY ALL"""


def _sliced(n: int) -> str:
    """The plays as sent (whole seconds), with the slice in which they arrive."""
    return f"""sent AS (SELECT date_trunc('second', played_ts) AS played_at, track_id AS song_id, album_id, artist_id,
  duration_ms, epoch_ms(date_trunc('second', played_ts)) // 1000 AS sec FROM ew),
sliced AS (SELECT *, least(CAST(floor((sec - (SELECT min(sec) FROM sent))
  / ((SELECT max(sec) - min(sec) + 1 FROM sent) / {n})) AS INTEGER), {n - 1}) AS slice FROM sent),
behind AS (SELECT *, slice = 1 AND sec <= (SELECT max(sec) FROM sliced WHERE slice <> 1) - 3600 AS late FROM sliced)"""


LATE_COUNTS = _with(EW, _sliced(3)) + """SELECT COUNT(*) AS read, CAST(0 AS BIGINT) AS rejected,
  COUNT(*) FILTER (WHERE late) AS late,
  COUNT(DISTINCT (played_at, song_id)) FILTER (WHERE NOT late) AS loaded,
  COUNT(*) FILTER (WHERE NOT late) - COUNT(DISTINCT (played_at, song_id)) FILTER (WHERE NOT late) AS copies
FROM behind"""
LATE_LETTERS = _with(EW, _sliced(3)) + f"""SELECT 'item_topic' AS topic,
  CAST(json_object('played_at', strftime(played_at, {ISO_SEC}), 'song_id', song_id, 'album_id', album_id,
  'artist_id', artist_id, 'duration_ms', duration_ms) AS VARCHAR) AS raw_value, 'late' AS reason
FROM behind WHERE late"""
REPLAYED = _with(EW, _sliced(5)) + """SELECT played_at, song_id, album_id, artist_id, duration_ms FROM sliced
WHERE slice BETWEEN 1 AND 3
QUALIFY row_number() OVER (PARTITION BY played_at, song_id ORDER BY album_id, artist_id, duration_ms) = 1"""


def stream_oracles() -> dict[str, str]:
    return {
        "four_streams_load_star": EV_COUNTS,
        "resume_from_checkpoint": EV_COUNTS,
        "replay_is_idempotent": EV_COUNTS,
        "batch_row_metrics": EV_COUNTS,
        "foreach_batch_load": _with(EW) + EV_FACT,
        "dim_song_upsert": _with(EW) + EV_SONG,
        "dim_album_upsert": _with(EW) + EV_ALBUM,
        "dim_artist_upsert": _with(EW) + EV_ARTIST,
        "stream_topic_source": _with(EW) + EV_ITEM_JSON + "\nUNION ALL\n" + EV_ITEM_JSON,
        "stream_song_append": _with(EW) + EV_SONG_ALL + "\nUNION ALL\n" + EV_SONG_ALL,
        "stream_dedup_album": _with(EW) + EV_ALBUM,
        "stream_dedup_artist": _with(EW) + EV_ARTIST,
        "stream_dedup_play": _with(EW) + EV_PLAY_KEYS,
        "stream_dedup_within_watermark": _with(EW) + EV_PLAY_KEYS,
        "empty_batch_guard": _with(EW) + """SELECT 'fact_history' AS table_name,
  COUNT(*) AS loaded_rows, CAST(0 AS BIGINT) AS zero_row_batches
FROM (SELECT DISTINCT date_trunc('second', played_ts), track_id FROM ew)""",
        "rolling_song_plays": ROLL_SONG,
        "rolling_listening_time": ROLL_TIME,
        "rolling_artist_metrics": ROLL_ARTIST,
        "rolling_distinct_items": ROLL_DISTINCT,
        "rolling_top_songs": ROLL_TOP_SONGS,
        "rolling_top_albums": ROLL_TOP_ALBUMS,
        "rolling_sliding_plays": ROLL_SLIDING,
        "rolling_top_songs_sketched": ROLL_TOP_SONGS,
        "late_rows_accounted": LATE_COUNTS,
        "late_dead_letters": LATE_LETTERS,
        "replay_range": REPLAYED,
        "report_refresh": REFRESH_TOP,
        "report_refresh_totals": _refresh_sql(TOTALS_SELECT, 7),
        "report_refresh_aged": _refresh_sql(TOTALS_SELECT, 4),
        "report_refresh_weekdays": _refresh_sql(WEEKDAY_SELECT, 27),
    }


# ------------------------------------------------ batch dedup, load, checks
DEDUP_PLAY = _with(FACT) + """SELECT * FROM fact QUALIFY row_number() OVER (
  PARTITION BY played_at, song_id ORDER BY album_id, artist_id, duration_ms) = 1"""

NEW_ROWS = _with(FACT) + """SELECT * FROM fact f WHERE NOT EXISTS (
  SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R'
    AND l.l_shipdate = f.played_at AND l.l_partkey = f.song_id)"""

DAMAGED = """dfact AS (SELECT
  CASE WHEN l_orderkey % 10 = 4 THEN NULL ELSE l_shipdate END AS played_at,
  CASE WHEN l_orderkey % 10 = 0 THEN l_partkey + 1000000000
       WHEN l_orderkey % 10 = 3 THEN NULL ELSE l_partkey END AS song_id,
  CASE WHEN l_orderkey % 10 = 2 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS album_id,
  CASE WHEN l_orderkey % 10 = 1 THEN l_suppkey + 1000000000 ELSE l_suppkey END AS artist_id,
  CAST(l_quantity * 10000 AS INTEGER) AS duration_ms FROM lineitem)"""

UNMATCHED = _with(DAMAGED, SONG, ARTIST, ALBUM) + """SELECT 'dim_song' AS dimension,
  COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM song s WHERE s.song_id = f.song_id)) AS unmatched
FROM dfact f
UNION ALL SELECT 'dim_artist', COUNT(*) FILTER (WHERE NOT EXISTS (
  SELECT 1 FROM artist a WHERE a.artist_id = f.artist_id)) FROM dfact f
UNION ALL SELECT 'dim_album', COUNT(*) FILTER (WHERE NOT EXISTS (
  SELECT 1 FROM album a WHERE a.album_id = f.album_id)) FROM dfact f"""

SONG_FULL = """song AS (SELECT p_partkey AS song_id, p_name AS song_name,
  CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS explicit FROM part)"""


def _contract_sql(table: str, src: str, not_null, max_len: dict, keys) -> str:
    parts = []
    for c in not_null:
        parts.append(f"SELECT '{table}' AS table_name, 'not_null:{c}' AS check_name,"
                     f" COUNT(*) FILTER (WHERE {c} IS NULL) AS violations FROM {src}")
    for c, n in max_len.items():
        parts.append(f"SELECT '{table}', 'max_len:{c}',"
                     f" COUNT(*) FILTER (WHERE length(CAST({c} AS VARCHAR)) > {n}) FROM {src}")
    k = ", ".join(keys)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
    parts.append(f"SELECT '{table}', 'unique:{','.join(keys)}',"
                 f" CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM {src}"
                 f" WHERE {nn} GROUP BY {k})")
    return "\nUNION ALL\n".join(parts)


CONTRACTS_SQL = _with(DAMAGED, SONG_FULL, ARTIST, ALBUM) + "\nUNION ALL\n".join([
    _contract_sql("fact_history", "dfact", ["played_at"],
                  {"song_id": 100, "album_id": 100, "artist_id": 100}, ["played_at", "song_id"]),
    _contract_sql("dim_song", "song", ["song_id"],
                  {"song_id": 100, "song_name": 300, "explicit": 10}, ["song_id"]),
    _contract_sql("dim_album", "album", ["album_id"],
                  {"album_id": 100, "album_name": 300}, ["album_id"]),
    _contract_sql("dim_artist", "artist", ["artist_id"],
                  {"artist_id": 100, "artist_name": 300}, ["artist_id"]),
])

SURROGATE = """SELECT COUNT(*) AS ids, CAST(1 AS BIGINT) AS min_id, COUNT(*) AS max_id,
  COUNT(*) AS distinct_ids FROM part"""


FACT_IDS = _with(FACT) + """SELECT COUNT(*) AS ids, CAST(1 AS BIGINT) AS min_id, COUNT(*) AS max_id,
  COUNT(*) AS distinct_ids, COUNT(*) FILTER (WHERE played_at < (SELECT max(played_at) FROM fact)
    - INTERVAL 365 DAY) AS first_block_max
FROM (SELECT DISTINCT played_at, song_id FROM fact)"""


def batch_oracles() -> dict[str, str]:
    return {
        "dedup_play_batch": DEDUP_PLAY,
        "fact_insert_if_absent": DEDUP_PLAY,
        "new_rows_only": NEW_ROWS,
        "unmatched_fact_rows": UNMATCHED,
        "contract_violations": CONTRACTS_SQL,
        "surrogate_ids": SURROGATE,
        "fact_surrogate_ids": FACT_IDS,
    }


# 200 draws at positions given by digests of seed and counter, in the order of the key's digest
SAMPLE = _with(CAT) + """, ranked AS (SELECT *, row_number() OVER (ORDER BY md5(track_id), track_id) - 1 AS pos,
  COUNT(*) OVER () AS n FROM cat),
draws AS (SELECT (CAST(CAST('0x' || substr(md5('42:' || i), 1, 13) AS UBIGINT) AS HUGEINT)
  * (SELECT COUNT(*) FROM cat)) // 4503599627370496 AS pos FROM range(200) AS r(i)
  WHERE i < (SELECT COUNT(*) FROM cat))
SELECT r.* EXCLUDE (pos, n, p_partkey) FROM ranked r JOIN draws d USING (pos)"""


def oracle_sql() -> dict[str, str]:
    return {
        "top_songs_week": top(SONG, "song", "song_id", "song_name", 5),
        "top_artists_week": top(ARTIST, "artist", "artist_id", "artist_name", 5),
        "top10_songs_week": top(SONG, "song", "song_id", "song_name", 10),
        "top10_artists_week": top(ARTIST, "artist", "artist_id", "artist_name", 10),
        "plays_by_song": plays_by(SONG, "song", "song_id", "song_name"),
        "plays_by_artist": plays_by(ARTIST, "artist", "artist_id", "artist_name"),
        "totals_week": TOTALS,
        "listening_minutes": MINUTES,
        "plays_by_weekday": WEEKDAY,
        "weekday_padded": WEEKDAY_PADDED,
        "listening_hours_by_day": HOURS,
        "recent_plays": RECENT,
        "latest_events": LATEST,
        "weekly_stats": STATS,
        "headline_top_song": HEADLINE,
        "decode_json_records": DECODE,
        "parse_played_at": PARSE,
        "quarantine_bad_records": QUARANTINE,
        "format_played_at": FORMAT_TS,
        "bool_label": BOOL_LABEL,
        "truncate_to_int": TRUNC,
        "stable_keys": STABLE_KEYS,
        "strip_char_set": STRIP,
        "fanout_all_topics": FANOUT_ALL,
        "fanout_song_records": _with(CAT, WIDE) + topic_sql("song_topic", False),
        "fanout_album_records": _with(CAT, WIDE) + topic_sql("album_topic", False),
        "fanout_artist_records": _with(CAT, WIDE) + topic_sql("artist_topic", False),
        "fanout_play_records": _with(CAT, WIDE) + topic_sql("item_topic", False),
        "encode_records": ENCODE,
        "default_missing_columns": DEFAULTS,
        "scan_csv_catalog": CATALOG_SCAN,
        "drop_incomplete_rows": CATALOG_COMPLETE,
        "flatten_nested_payload": PAYLOAD_ROWS,
        "payload_counts": PAYLOAD_COUNTS,
        "digest_prompt": DIGEST_PROMPT,
        "digest_html": DIGEST_HTML,
        "preview_text": PREVIEW,
        "newline_to_break": NL_BREAK,
        "filter_last_7_days": _with(FACT) + f"SELECT * FROM fact WHERE {window(7)}",
        "filter_last_30_days": _with(FACT) + f"SELECT * FROM fact WHERE {window(30)}",
        "scan_star_tables": _with(FACT) + "SELECT * FROM fact",
        "join_fact_song": _with(FACT, SONG) + "SELECT * FROM fact JOIN song USING (song_id)",
        "sample_with_replacement": SAMPLE,
        "join_fact_artist": _with(FACT, ARTIST) + "SELECT * FROM fact JOIN artist USING (artist_id)",
        **stream_oracles(),
        **batch_oracles(),
    }
