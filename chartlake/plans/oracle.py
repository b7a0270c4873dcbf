"""Independent DuckDB SQL for every registered query (the correctness gate).

Written from the rules in ``binding.py`` and the reference's model SQL, not
generated from the Spark code. Tables are the driver's pre-registered views.
Array columns are compared as ``|``-joined sorted text."""
from __future__ import annotations

ALBUM_FIELDS = """    CASE WHEN o.o_orderdate IS NULL THEN NULL
         WHEN o.o_orderpriority = '1-URGENT'
           THEN printf('%04d-%02d-%02d', ry, month(o.o_orderdate), day(o.o_orderdate))
         WHEN o.o_orderpriority = '2-HIGH' THEN printf('%04d-%02d', ry, month(o.o_orderdate))
         ELSE printf('%04d', ry) END AS album_release_date,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'day' WHEN '2-HIGH' THEN 'month'
         WHEN '3-MEDIUM' THEN 'year' WHEN '5-LOW' THEN 'decade' END
      AS album_release_date_precision,
    CASE o.o_orderstatus WHEN 'F' THEN 'album' WHEN 'O' THEN 'single'
         WHEN 'P' THEN 'compilation' END AS album_type,"""

TRACK_FROM = """  FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS sd FROM lineitem) l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN (SELECT *, CAST(year(o_orderdate) AS INTEGER)
                        - CAST(floor(o_totalprice / 50000) AS INTEGER) * 10 AS ry
             FROM orders) o ON l.l_orderkey = o.o_orderkey"""

STG_TRACKS = """
stg_top_tracks AS (
  SELECT
    'T' || l.l_partkey AS track_id,
    p.p_name AS track_name,
    'A' || l.l_suppkey AS primary_artist_id,
    'L' || l.l_orderkey AS album_id,
    CAST(least(100, floor(l.l_quantity * 2)) AS INTEGER) AS track_popularity,
    CAST(floor(l.l_extendedprice) AS BIGINT) + 60000 AS duration_ms,
    l.l_returnflag = 'R' AS explicit,
    'track:' || l.l_partkey AS track_uri,
    s.s_name AS primary_artist_name,
    'artist:' || l.l_suppkey AS primary_artist_uri,
    'Album ' || l.l_orderkey AS album_name,
{ALBUM_FIELDS}
    'album:' || l.l_orderkey AS album_uri,
    'img/L' || l.l_orderkey AS album_image_url,
    CAST(year(sd) AS INTEGER) AS snapshot_year,
    CAST(month(sd) AS INTEGER) AS snapshot_month,
    CAST(day(sd) AS INTEGER) AS snapshot_day,
    sd AS track_snapshot_date
{TRACK_FROM}
)"""

STG_TRACKS = STG_TRACKS.replace("{ALBUM_FIELDS}", ALBUM_FIELDS).replace("{TRACK_FROM}", TRACK_FROM)

# Raw track rows as landed (fields staging does not keep included).
RAW_TRACKS_SCAN = """
SELECT
  'T' || l.l_partkey AS id, p.p_name AS name, 'track' AS type,
  CAST(least(100, floor(l.l_quantity * 2)) AS INTEGER) AS popularity,
  CAST(floor(l.l_extendedprice) AS BIGINT) + 60000 AS duration_ms,
  l.l_returnflag = 'R' AS explicit, 'track:' || l.l_partkey AS uri,
  '/tracks/' || l.l_partkey AS href, l.l_linenumber AS track_number,
  l.l_linestatus = 'O' AS is_playable, '/tracks/' || l.l_partkey AS web_url,
  'N' || s.s_nationkey AS markets,
  'A' || l.l_suppkey AS primary_artist_id, s.s_name AS primary_artist_name,
  'L' || l.l_orderkey AS album_id,
""" + ALBUM_FIELDS + """
  'img/L' || l.l_orderkey AS album_image_url,
  CAST(year(l.sd) AS INTEGER) AS year, CAST(month(l.sd) AS INTEGER) AS month,
  CAST(day(l.sd) AS INTEGER) AS day
""" + TRACK_FROM

STG_ARTISTS = """
stg_top_artists AS (
  SELECT
    'A' || l.l_suppkey AS artist_id,
    s.s_name AS artist_name,
    'artist:' || l.l_suppkey AS artist_uri,
    CAST(least(100, count(*) * 5) AS INTEGER) AS artist_popularity,
    list_sort(list_distinct(list(p.p_type))) AS artist_genres,
    CAST(sum(l.l_quantity) AS BIGINT) AS artist_follower_count,
    'img/A' || l.l_suppkey AS artist_image_url,
    CAST(year(l.sd) AS INTEGER) AS snapshot_year,
    CAST(month(l.sd) AS INTEGER) AS snapshot_month,
    CAST(day(l.sd) AS INTEGER) AS snapshot_day,
    l.sd AS artist_snapshot_date
  FROM (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS sd FROM lineitem) l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey AND s.s_acctbal > 0
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.sd, l.l_suppkey, s.s_name
)"""

DIM_ALBUMS = """
dim_albums AS (
  SELECT album_id, album_name, album_release_date_parsed, album_type,
         track_snapshot_date AS last_seen_album_snapshot_date
  FROM (
    SELECT *,
      CASE album_release_date_precision
        WHEN 'day' THEN CAST(try_strptime(album_release_date, '%Y-%m-%d') AS DATE)
        WHEN 'month' THEN CAST(try_strptime(album_release_date, '%Y-%m') AS DATE)
        WHEN 'year' THEN CAST(try_strptime(album_release_date, '%Y') AS DATE)
        ELSE NULL END AS album_release_date_parsed,
      row_number() OVER (PARTITION BY album_id ORDER BY track_snapshot_date DESC NULLS LAST,
        album_name DESC NULLS LAST, album_release_date DESC NULLS LAST,
        album_release_date_precision DESC NULLS LAST, album_type DESC NULLS LAST) AS rn
    FROM stg_top_tracks WHERE album_id IS NOT NULL) x
  WHERE rn = 1
)"""

DIM_ARTISTS = """
dim_artists AS (
  SELECT artist_id, artist_name, artist_popularity, artist_genres, artist_uri,
         artist_image_url, artist_snapshot_date AS last_seen_artist_snapshot_date
  FROM (
    SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY artist_snapshot_date DESC NULLS LAST,
        artist_name DESC NULLS LAST, artist_popularity DESC NULLS LAST,
        artist_genres DESC NULLS LAST, artist_uri DESC NULLS LAST,
        artist_image_url DESC NULLS LAST) AS rn
    FROM stg_top_artists WHERE artist_id IS NOT NULL) x
  WHERE rn = 1
)"""

FACT = """
fct AS (
  SELECT t.track_snapshot_date, t.track_id, t.primary_artist_id AS artist_id, t.album_id,
         t.track_name, t.track_popularity, t.duration_ms, t.explicit, t.track_uri,
         al.album_name, al.album_release_date_parsed, al.album_type,
         ar.artist_name, ar.artist_popularity, ar.artist_genres, ar.artist_uri,
         ar.artist_image_url
  FROM stg_top_tracks t
  LEFT JOIN dim_albums al ON t.album_id = al.album_id
  LEFT JOIN dim_artists ar ON t.primary_artist_id = ar.artist_id
)"""

DETAILS = """
details AS (
  SELECT 'A' || s.s_suppkey AS id, s.s_name AS name, 'artist:' || s.s_suppkey AS uri,
         CAST(least(100, greatest(0, floor(s.s_acctbal / 100))) AS INTEGER) AS popularity,
         [lower(n.n_name)] AS genres, 'img/A' || s.s_suppkey AS image_url
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""

CANDIDATES = """
latest AS (SELECT max(track_snapshot_date) AS d FROM stg_top_tracks),
candidates AS (
  SELECT DISTINCT primary_artist_id AS artist_id FROM stg_top_tracks
  WHERE track_snapshot_date = (SELECT d FROM latest) AND primary_artist_id IS NOT NULL
  EXCEPT
  SELECT artist_id FROM dim_artists WHERE artist_id IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


BASE = (STG_TRACKS, STG_ARTISTS, DIM_ALBUMS, DIM_ARTISTS, FACT)


def _txt(c: str) -> str:
    return f"array_to_string(list_sort({c}), '|')"


def _share(bucket_sql: str, bucket: str, where: str, source: str) -> str:
    return _with(*BASE) + f""",
u AS (SELECT track_snapshot_date, track_id, {bucket_sql} AS {bucket} FROM {source} WHERE {where}),
c AS (SELECT track_snapshot_date, {bucket}, count(DISTINCT track_id) AS track_count
      FROM u GROUP BY track_snapshot_date, {bucket}),
t AS (SELECT track_snapshot_date, count(DISTINCT track_id) AS total_tracks
      FROM u GROUP BY track_snapshot_date)
SELECT c.track_snapshot_date, c.{bucket}, c.track_count, t.total_tracks,
       CAST(c.track_count AS DOUBLE) / t.total_tracks * 100 AS percentage_of_tracks
FROM c JOIN t ON c.track_snapshot_date = t.track_snapshot_date"""


# Decade label by arithmetic (an independent check of the Spark when-chain):
# open-ended from 2020, catch-all before 1920.
DECADE_SQL = """CASE
  WHEN year(album_release_date_parsed) >= 2020 THEN '2020s'
  WHEN year(album_release_date_parsed) < 1920 THEN 'Older or Unknown'
  ELSE CAST(year(album_release_date_parsed) // 10 * 10 AS VARCHAR) || 's' END"""

TOPK = """
ranked AS (
  SELECT snapshot_date, 'T' || l_partkey AS item_id, score,
         CAST(row_number() OVER (PARTITION BY snapshot_date ORDER BY score DESC NULLS LAST,
                                 l_partkey ASC NULLS LAST) AS INTEGER) AS item_rank
  FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date,
               l_partkey, CAST(sum(l_quantity) AS BIGINT) AS score
        FROM lineitem GROUP BY 1, 2) a
)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_tracks"] = RAW_TRACKS_SCAN
    q["scan_artists"] = _with(STG_ARTISTS) + f"""
SELECT artist_id AS id, artist_name AS name, 'artist' AS type, artist_uri AS uri,
       artist_popularity AS popularity, {_txt('artist_genres')} AS genres,
       artist_follower_count AS followers_total, artist_image_url AS image_url,
       '/artists/' || substr(artist_id, 2) AS web_url,
       snapshot_year AS year, snapshot_month AS month, snapshot_day AS day
FROM stg_top_artists"""
    q["snapshot_top_k"] = _with(TOPK) + "SELECT * FROM ranked WHERE item_rank <= 10"
    q["landing_items"] = _with(TOPK) + """
SELECT printf('%04d', year(snapshot_date)) AS year, printf('%02d', month(snapshot_date)) AS month,
       printf('%02d', day(snapshot_date)) AS day,
       CAST(to_json(struct_pack(item_rank := item_rank, id := item_id, score := score)) AS VARCHAR)
         AS value
FROM ranked WHERE item_rank <= 10"""
    q["stg_top_tracks"] = _with(STG_TRACKS) + "SELECT * FROM stg_top_tracks"
    q["stg_top_artists"] = _with(STG_ARTISTS) + f"""
SELECT * REPLACE ({_txt('artist_genres')} AS artist_genres) FROM stg_top_artists"""
    q["partial_date"] = _with(STG_TRACKS) + """
SELECT DISTINCT album_release_date, album_release_date_precision,
  CASE album_release_date_precision
    WHEN 'day' THEN CAST(try_strptime(album_release_date, '%Y-%m-%d') AS DATE)
    WHEN 'month' THEN CAST(try_strptime(album_release_date, '%Y-%m') AS DATE)
    WHEN 'year' THEN CAST(try_strptime(album_release_date, '%Y') AS DATE)
    ELSE NULL END AS album_release_date_parsed
FROM stg_top_tracks"""
    q["latest_by_key"] = """
SELECT l_partkey, ship_date, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, l_orderkey, l_linenumber, l_quantity,
         row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC,
                            l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem WHERE l_partkey IS NOT NULL) x
WHERE rn = 1"""
    q["dim_albums"] = _with(STG_TRACKS, DIM_ALBUMS) + "SELECT * FROM dim_albums"
    q["dim_artists"] = _with(STG_ARTISTS, DIM_ARTISTS) + f"""
SELECT * REPLACE ({_txt('artist_genres')} AS artist_genres) FROM dim_artists"""
    q["stream_dim_artists"] = q["dim_artists"]
    q["stream_dim_albums"] = q["dim_albums"]
    q["upsert_albums"] = q["dim_albums"]
    q["upsert_parts"] = q["dim_albums"]
    q["upsert_artists"] = q["dim_artists"]
    q["fct_snapshot_top_items"] = _with(*BASE) + f"""
SELECT * REPLACE ({_txt('artist_genres')} AS artist_genres) FROM fct"""
    q["fct_bucketed"] = q["fct_snapshot_top_items"]
    q["mart_avg_popularity_trends"] = _with(*BASE) + """
SELECT track_snapshot_date, avg(track_popularity) AS avg_track_popularity,
       avg(artist_popularity) AS avg_artist_popularity
FROM fct GROUP BY track_snapshot_date"""
    q["mart_genre_distribution"] = _share(
        "unnest(artist_genres)", "genre",
        "track_id IS NOT NULL AND len(artist_genres) > 0", "fct")
    q["mart_track_vintages"] = _share(
        DECADE_SQL, "release_decade", "album_release_date_parsed IS NOT NULL", "fct")
    q["mart_list_changes"] = _with(STG_TRACKS, STG_ARTISTS) + """,
all_dates AS (SELECT track_snapshot_date AS d FROM stg_top_tracks
              UNION SELECT artist_snapshot_date FROM stg_top_artists),
pair AS (SELECT max(d) AS c, (SELECT max(d) FROM all_dates
                              WHERE d < (SELECT max(d) FROM all_dates)) AS p FROM all_dates),
t_now AS (SELECT track_id AS i, track_name AS n FROM stg_top_tracks
          WHERE track_snapshot_date = (SELECT c FROM pair)),
t_before AS (SELECT track_id AS i, track_name AS n FROM stg_top_tracks
             WHERE track_snapshot_date = (SELECT p FROM pair)),
a_now AS (SELECT artist_id AS i, artist_name AS n FROM stg_top_artists
          WHERE artist_snapshot_date = (SELECT c FROM pair) AND artist_id IS NOT NULL),
a_before AS (SELECT artist_id AS i, artist_name AS n FROM stg_top_artists
             WHERE artist_snapshot_date = (SELECT p FROM pair) AND artist_id IS NOT NULL),
changes AS (
  SELECT 'Track' AS k, 'New Entry' AS st, * FROM (SELECT * FROM t_now EXCEPT SELECT * FROM t_before)
  UNION ALL
  SELECT 'Track', 'Dropped Off', * FROM (SELECT * FROM t_before EXCEPT SELECT * FROM t_now)
  UNION ALL
  SELECT 'Artist', 'New Entry', * FROM (SELECT * FROM a_now EXCEPT SELECT * FROM a_before)
  UNION ALL
  SELECT 'Artist', 'Dropped Off', * FROM (SELECT * FROM a_before EXCEPT SELECT * FROM a_now))
SELECT pair.c AS snapshot_date, k AS item_type, i AS item_id, n AS item_name,
       st AS change_status
FROM changes, pair WHERE pair.p IS NOT NULL"""
    q["mart_track_persistence"] = _with(*BASE) + """,
seen AS (SELECT DISTINCT track_snapshot_date AS d, track_id, track_name
         FROM fct WHERE track_id IS NOT NULL),
numbered AS (
  SELECT track_id, track_name, d,
         dense_rank() OVER (ORDER BY d)
           - row_number() OVER (PARTITION BY track_id ORDER BY d, track_name NULLS FIRST) AS island
  FROM seen),
islands AS (SELECT track_id, track_name, island, count(*) AS len, max(d) AS last_d
            FROM numbered GROUP BY track_id, track_name, island)
SELECT track_id, track_name, len AS consecutive_snapshots_in_top_10
FROM islands WHERE last_d = (SELECT max(d) FROM seen)"""
    for name, order in (
            ("track_persistence", "consecutive_snapshots_in_top_10 DESC NULLS LAST, track_name ASC NULLS FIRST, "
                                  "track_id ASC NULLS FIRST"),
            ("track_vintages", "track_snapshot_date DESC NULLS LAST, "
                               "CASE WHEN release_decade = 'Older or Unknown' THEN 0 "
                               "ELSE CAST(left(release_decade, 4) AS INTEGER) END DESC"),
            ("genre_distribution", "track_snapshot_date DESC NULLS LAST, track_count DESC, genre ASC NULLS FIRST")):
        q[f"ordered_{name}"] = f"SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({q['mart_' + name]})"
    q["latest_snapshot"] = _with(STG_TRACKS) + """
SELECT max(track_snapshot_date) AS latest_snapshot_date FROM stg_top_tracks"""
    q["snapshot_entities"] = _with(STG_TRACKS) + """
SELECT DISTINCT primary_artist_id AS artist_id FROM stg_top_tracks
WHERE track_snapshot_date = (SELECT max(track_snapshot_date) FROM stg_top_tracks)
  AND primary_artist_id IS NOT NULL"""
    q["enrichment_candidates"] = _with(STG_TRACKS, STG_ARTISTS, DIM_ARTISTS, CANDIDATES) + \
        "SELECT artist_id FROM candidates"
    q["lookup_details"] = _with(STG_TRACKS, STG_ARTISTS, DIM_ARTISTS, CANDIDATES, DETAILS) + f"""
SELECT id, name, uri, popularity, {_txt('genres')} AS genres, image_url
FROM details WHERE id IN (SELECT artist_id FROM candidates)"""
    q["enrich_artists"] = _with(STG_TRACKS, STG_ARTISTS, DIM_ARTISTS, CANDIDATES, DETAILS) + f""",
found AS (SELECT * FROM details WHERE id IN (SELECT artist_id FROM candidates))
SELECT artist_id, artist_name, artist_popularity, {_txt('artist_genres')} AS artist_genres,
       artist_uri, artist_image_url, last_seen_artist_snapshot_date
FROM dim_artists WHERE artist_id NOT IN (SELECT id FROM found)
UNION ALL
SELECT id, name, popularity, {_txt('genres')}, uri, image_url, (SELECT d FROM latest)
FROM found"""
    q["zip_arrays"] = _with(DETAILS) + """
SELECT id, name, popularity,
       CASE WHEN k % 7 = 3 THEN NULL WHEN k % 5 = 2 THEN '' ELSE array_to_string(genres, '|') END AS genres,
       uri, image_url,
       CASE WHEN k % 9 = 4 OR k % 8 = 5 THEN NULL
            ELSE make_date(1997, CAST(k % 12 + 1 AS INTEGER), CAST(k % 28 + 1 AS INTEGER)) END AS snapshot_date
FROM (SELECT *, CAST(substr(id, 2) AS BIGINT) AS k FROM details)"""
    q["merge_counts"] = _with(STG_ARTISTS) + """
SELECT count(*) FILTER (older AND newest) AS matched, count(*) FILTER (newest AND NOT older) AS inserted,
       count(*) FILTER (newest) AS affected
FROM (SELECT artist_id, bool_or(artist_snapshot_date = top) AS newest, bool_or(artist_snapshot_date < top) AS older
      FROM stg_top_artists, (SELECT max(artist_snapshot_date) AS top FROM stg_top_artists)
      WHERE artist_id IS NOT NULL GROUP BY artist_id)"""
    q["quarantine_lines"] = _with(STG_ARTISTS) + """
SELECT snapshot_year AS year, snapshot_month AS month, snapshot_day AS day, count(*) FILTER (NOT damaged) AS good_lines,
       CAST(sum(artist_popularity) FILTER (NOT damaged) AS BIGINT) AS good_popularity, count(*) FILTER (damaged) AS bad_lines
FROM (SELECT *, CAST(substr(artist_id, 2) AS BIGINT) % 5 < 2 AS damaged FROM stg_top_artists)
GROUP BY ALL"""
    drifted = _with(STG_ARTISTS) + """, drifted AS (
  SELECT artist_id AS id, artist_popularity AS popularity,
         CASE WHEN k % 7 <> 0 THEN artist_image_url END AS image_url,
         CASE WHEN k % 4 = 0 THEN 'label ' || k END AS label, CASE WHEN k % 3 = 0 THEN k END AS rank,
         CAST(CASE k % 6 WHEN 1 THEN k + 0.5 WHEN 2 THEN k END AS DOUBLE) AS weight,
         CASE k % 8 WHEN 3 THEN CAST(k AS VARCHAR) WHEN 5 THEN '"none"' END AS mixed,
         CASE WHEN k % 5 = 1 THEN '{"stop":' || k || '}' END AS tour,
         snapshot_year AS year, snapshot_month AS month, snapshot_day AS day
  FROM (SELECT *, CAST(substr(artist_id, 2) AS BIGINT) AS k FROM stg_top_artists))"""
    q["scan_detected"] = drifted + "\nSELECT * FROM drifted"
    types = {"label": "STRING", "rank": "BIGINT", "weight": "DECIMAL(21,1)", "mixed": "VARIANT",
             "tour": "OBJECT<stop: BIGINT>"}
    q["detected_fields"] = drifted + "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, '{t}' AS type, count({f}) AS lines FROM drifted HAVING count({f}) > 0"
        for f, t in types.items()).join(["\n", ""])
    return q
