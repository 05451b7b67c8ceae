"""SQL counterparts of the named queries, written for DuckDB.

They state the wanted rows on their own terms (ranking windows, integer rounding)
and share no code with the Spark side.
"""

from __future__ import annotations

_BRONZE = """
bronze AS (
  SELECT
    CASE WHEN e.event_id % 101 <> 0 THEN CAST(e.event_id AS VARCHAR) END AS event_id,
    CASE WHEN e.event_id % 103 <> 0 THEN CAST(c.c_custkey AS VARCHAR) END AS user_id,
    CASE WHEN e.event_id % 107 <> 0 THEN CAST(p.p_partkey AS VARCHAR) END AS song_id,
    p.p_brand AS artist_name,
    p.p_name AS song_name,
    CASE e.event_type WHEN 'view' THEN 'play' WHEN 'purchase' THEN 'play'
      WHEN 'click' THEN 'skip' WHEN 'signup' THEN 'add_to_playlist'
      WHEN 'error' THEN 'pause' END AS event_type,
    ['mobile', 'desktop', 'web'][CAST(e.event_id % 3 AS INTEGER) + 1] AS device_type,
    ['US', 'UK', 'CA', 'AU', 'IN', 'DE', 'VN', 'JP'][n.n_nationkey % 8 + 1] AS country,
    CASE WHEN e.event_id % 109 = 0 THEN NULL
      WHEN e.event_id % 113 = 0 THEN 'not-a-timestamp'
      ELSE strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS "timestamp",
    c.c_name AS username,
    CAST(16 + c.c_custkey % 30 AS INTEGER) AS age,
    CASE WHEN c.c_custkey % 3 = 2 THEN 'premium' ELSE 'free' END AS subscription_type,
    CAST(DATE '2021-01-01' + CAST(c.c_custkey % 1000 AS INTEGER) AS VARCHAR) AS registration_date,
    p.p_type AS genre,
    CAST(180 + p.p_size AS INTEGER) AS duration_seconds,
    CAST(2000 + p.p_partkey % 25 AS INTEGER) AS release_year,
    'Album ' || CAST(p.p_partkey % 10 AS VARCHAR) AS album_name
  FROM events e
  JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
  JOIN customer c ON c.c_custkey = e.user_id * 10 + e.event_id % 10
  JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

_TWICE = """
twice AS (
  SELECT * FROM bronze
  UNION ALL
  SELECT * FROM bronze WHERE CAST(event_id AS BIGINT) % 97 = 0
)"""

_FOREIGN = """
dirty AS (
  SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 127 = 0 THEN 'like'
                         ELSE event_type END AS event_type)
  FROM twice
)"""

# What is left of a damaged message: nothing if cut, no age if the age was a text.
_PARSED = """
numbered AS (SELECT *, CAST(event_id AS BIGINT) AS num FROM bronze),
parsed AS (
  SELECT
    CASE WHEN cut THEN NULL ELSE event_id END AS event_id,
    CASE WHEN cut THEN NULL ELSE user_id END AS user_id,
    CASE WHEN cut THEN NULL ELSE song_id END AS song_id,
    CASE WHEN cut THEN NULL ELSE artist_name END AS artist_name,
    CASE WHEN cut THEN NULL ELSE song_name END AS song_name,
    CASE WHEN cut THEN NULL ELSE event_type END AS event_type,
    CASE WHEN cut THEN NULL ELSE device_type END AS device_type,
    CASE WHEN cut THEN NULL ELSE country END AS country,
    CASE WHEN cut THEN NULL ELSE "timestamp" END AS "timestamp",
    CASE WHEN cut THEN NULL ELSE username END AS username,
    CASE WHEN cut OR mistyped THEN NULL ELSE age END AS age,
    CASE WHEN cut THEN NULL ELSE subscription_type END AS subscription_type,
    CASE WHEN cut THEN NULL ELSE registration_date END AS registration_date,
    CASE WHEN cut THEN NULL ELSE genre END AS genre,
    CASE WHEN cut THEN NULL ELSE duration_seconds END AS duration_seconds,
    CASE WHEN cut THEN NULL ELSE release_year END AS release_year,
    CASE WHEN cut THEN NULL ELSE album_name END AS album_name,
    coalesce(try_cast("timestamp" AS TIMESTAMP), TIMESTAMP '2024-01-31 00:00:00')
      AS kafka_ingest_time,
    cut,
    mistyped
  FROM (SELECT *, coalesce(num % 131 = 0, false) AS cut,
               coalesce(num % 131 <> 0 AND num % 137 = 0, false) AS mistyped
        FROM numbered)
),
zoned AS (
  SELECT *,
    CASE WHEN event_id IS NULL THEN 'missing_event_id'
      WHEN user_id IS NULL THEN 'missing_user_id'
      WHEN song_id IS NULL THEN 'missing_song_id'
      WHEN "timestamp" IS NULL THEN 'missing_timestamp' END AS _reject_reason,
    CASE WHEN event_id IS NULL OR user_id IS NULL OR song_id IS NULL OR "timestamp" IS NULL
      THEN 'quarantine' ELSE 'clean' END AS zone
  FROM parsed
)"""

_EVENT = """event_id, user_id, song_id, artist_name, song_name, event_type, device_type,
  country, "timestamp", username, age, subscription_type, registration_date, genre,
  duration_seconds, release_year, album_name"""
_LEGACY = """event_id, user_id, song_id, artist_name, song_name, event_type, device_type,
  country, "timestamp\""""
_SILVER_COLUMNS = _EVENT.replace('"timestamp"', "event_ts")


def _silver_cte(name: str, of: str) -> str:
    return f"""
{name} AS (
  SELECT {_SILVER_COLUMNS}
  FROM (SELECT *, try_cast("timestamp" AS TIMESTAMP) AS event_ts FROM {of})
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND song_id IS NOT NULL
    AND event_ts IS NOT NULL
)"""


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + body


def _bronze(body: str) -> str:
    return _with(_BRONZE, body=body)


def _zoned(body: str) -> str:
    return _with(_BRONZE, _PARSED, body=body)


def _silver(body: str, *more: str) -> str:
    return _with(_BRONZE, _silver_cte("silver", "bronze"), *more, body=body)


def _dirty(body: str, *more: str) -> str:
    return _with(_BRONZE, _TWICE, _FOREIGN, _silver_cte("silver", "dirty"), *more, body=body)


def _n(kind: str) -> str:
    return f"count(*) FILTER (WHERE event_type = '{kind}')"


def _ratio(part: str, whole: str) -> str:
    """Two decimals, half up, in whole numbers."""
    return (
        f"CASE WHEN {whole} = 0 THEN NULL ELSE "
        f"CAST((200 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 100 END"
    )


_SONG = "song_id, song_name, artist_name"


def _report_rows(source: str, rules: list[tuple[str, str, list[str] | None]]) -> str:
    parts = []
    for check, column, values in rules:
        if check == "not_null":
            bad = f"SELECT count(*) AS f, count(*) AS r FROM {source} WHERE {column} IS NULL"
        elif check == "unique":
            bad = (
                f"SELECT count(*) AS f, coalesce(sum(n), 0) AS r FROM (SELECT count(*) AS n "
                f"FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
            )
        else:
            listed = ", ".join(f"'{v}'" for v in values or [])
            bad = (
                f"SELECT count(DISTINCT {column}) AS f, count(*) AS r FROM {source} "
                f"WHERE {column} NOT IN ({listed})"
            )
        parts.append(
            f"""SELECT '{check}' AS "check", '{column}' AS "column",
            CAST(f AS BIGINT) AS failures, CAST(r AS BIGINT) AS failing_rows, f = 0 AS passed
            FROM ({bad})"""
        )
    return "\nUNION ALL\n".join(parts)


_SILVER_RULES: list[tuple[str, str, list[str] | None]] = [
    ("not_null", "event_id", None),
    ("unique", "event_id", None),
    ("not_null", "user_id", None),
    ("not_null", "song_id", None),
    ("accepted_values", "event_type", ["play", "pause", "skip", "add_to_playlist"]),
    ("not_null", "event_ts", None),
    ("accepted_values", "subscription_type", ["free", "premium"]),
    ("accepted_values", "country", ["US", "UK", "CA", "AU", "IN", "DE", "VN", "JP"]),
]


def _forecast_ctes(key: str, horizon: int, fill: bool = False) -> str:
    """Trend plus weekday residual by plain aggregates and joins, per ``key``."""
    seen = f"""
seen AS (
  SELECT {key} AS k, CAST(event_ts AS DATE) AS ds, {_n("play")} AS y
  FROM silver GROUP BY 1, 2
)"""
    daily = """
daily AS (SELECT * FROM seen)"""
    if fill:
        daily = """
daily AS (
  SELECT keys.k, days.ds, coalesce(s.y, 0) AS y
  FROM (SELECT DISTINCT k FROM seen) AS keys
  CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT min(ds) FROM seen),
    (SELECT max(ds) FROM seen), INTERVAL 1 DAY)) AS DATE) AS ds) AS days
  LEFT JOIN seen s ON s.k = keys.k AND s.ds = days.ds
)"""
    return f"""{seen},{daily},
span AS (
  SELECT k, min(ds) AS lo, max(ds) AS hi FROM daily GROUP BY k HAVING count(*) >= 2
),
timed AS (
  SELECT d.k, d.ds, d.y, d.ds - s.lo AS t FROM daily d JOIN span s ON s.k = d.k
),
line AS (SELECT k, regr_slope(y, t) AS b, regr_intercept(y, t) AS a FROM timed GROUP BY k),
week AS (
  SELECT t.k, dayofweek(t.ds) AS dow, avg(t.y - (l.a + l.b * t.t)) AS w
  FROM timed t JOIN line l ON l.k = t.k GROUP BY 1, 2
),
ahead AS (
  SELECT k, ds, y, t FROM timed
  UNION ALL
  SELECT k, hi + i, NULL, (hi - lo) + i
  FROM span CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(1, {horizon + 1}))
),
fit AS (
  SELECT p.k, p.ds, p.y, l.a + l.b * p.t + coalesce(w.w, 0) AS yhat
  FROM ahead p JOIN line l ON l.k = p.k
  LEFT JOIN week w ON w.k = p.k AND w.dow = dayofweek(p.ds)
),
spread AS (
  SELECT k, 1.2816 * coalesce(stddev_samp(y - yhat), 0) AS s FROM fit
  WHERE y IS NOT NULL GROUP BY k
),
forecast AS (
  SELECT f.k, f.ds, f.y, f.yhat, f.yhat - s.s AS yhat_lower, f.yhat + s.s AS yhat_upper
  FROM fit f JOIN spread s ON s.k = f.k
)"""


_ALL = "'all'"
# Adding 0.0 turns a negative zero into zero.
_BANDS = """round(yhat, 6) + 0.0 AS yhat, round(yhat_lower, 6) + 0.0 AS yhat_lower,
  round(yhat_upper, 6) + 0.0 AS yhat_upper"""

# Hinges at six points of the first 80 % of the history, a penalty of 0.5 on each bend; the
# normal equations are reduced row by row.
_CHANGEPOINTS = """
daily AS (
  SELECT CAST(event_ts AS DATE) AS ds, count(*) FILTER (WHERE event_type = 'play') AS y
  FROM silver GROUP BY 1
),
span AS (SELECT min(ds) AS lo, max(ds) AS hi FROM daily HAVING count(*) >= 2),
points AS (
  SELECT ds, y FROM daily
  UNION ALL
  SELECT hi + i, NULL FROM span CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(1, 8))
),
scaled AS (
  SELECT p.ds, p.y, CAST(p.ds - s.lo AS DOUBLE) / (s.hi - s.lo) AS u FROM points p CROSS JOIN span s
),
based AS (
  SELECT ds, y, u, b, CASE b WHEN 1 THEN 1.0 WHEN 2 THEN u
    ELSE greatest(u - CAST(0.8 AS DOUBLE) * (b - 2) / 7, 0.0) END AS x
  FROM scaled CROSS JOIN (SELECT CAST(range AS INTEGER) AS b FROM range(1, 9))
),
cells AS (
  SELECT l.b AS i, r.b AS j, sum(l.x * r.x) + CASE WHEN l.b = r.b AND l.b > 2 THEN 0.5 ELSE 0 END AS v
  FROM based l JOIN based r ON l.ds = r.ds WHERE l.y IS NOT NULL GROUP BY 1, 2, l.b = r.b AND l.b > 2
  UNION ALL
  SELECT b, 9, sum(x * y) FROM based WHERE y IS NOT NULL GROUP BY 1
),
lines AS (SELECT i, list(v ORDER BY j) AS line FROM cells GROUP BY i),
reduced AS (
  SELECT 0 AS p, list(line ORDER BY i) AS m FROM lines
  UNION ALL
  SELECT p + 1, list_transform(m, lambda line, i: CASE WHEN i = p + 1
    THEN list_transform(line, lambda x: x / m[p + 1][p + 1])
    ELSE list_transform(line, lambda x, j: x - line[p + 1] * m[p + 1][j] / m[p + 1][p + 1]) END)
  FROM reduced WHERE p < 8
),
weights AS (SELECT b, m[b][9] AS w FROM reduced CROSS JOIN (SELECT CAST(range AS INTEGER) AS b FROM range(1, 9)) WHERE p = 8),
bent AS (
  SELECT ds, y, sum(w * x) AS trend FROM based JOIN weights USING (b) GROUP BY ds, y
),
fit AS (
  SELECT a.ds, a.y, a.trend + coalesce((SELECT avg(b.y - b.trend) FROM bent b WHERE dayofweek(b.ds) = dayofweek(a.ds)), 0) AS yhat
  FROM bent a
),
spread AS (SELECT 1.2816 * coalesce(stddev_samp(y - yhat), 0) AS s FROM fit WHERE y IS NOT NULL)"""

# One row per series, triple and day: level, trend and the seven effects go from day to day.
_SEASONAL = """
seen AS (
  SELECT song_id AS k, CAST(event_ts AS DATE) AS ds, count(*) FILTER (WHERE event_type = 'play') AS y
  FROM silver GROUP BY 1, 2
),
span AS (SELECT k, min(ds) AS lo, max(ds) AS hi, max(ds) - min(ds) + 1 AS n FROM seen GROUP BY k),
days AS (
  SELECT g.k, g.t, CAST(coalesce(s.y, 0) AS DOUBLE) AS y
  FROM (SELECT k, lo, unnest(range(n)) AS t FROM span) g LEFT JOIN seen s ON s.k = g.k AND s.ds = g.lo + CAST(g.t AS INTEGER)
),
triples(number, a, b, c) AS (VALUES (0, 0.1e0, 0.01e0, 0.1e0), (1, 0.1e0, 0.05e0, 0.3e0),
  (2, 0.3e0, 0.01e0, 0.1e0), (3, 0.3e0, 0.05e0, 0.3e0), (4, 0.6e0, 0.05e0, 0.1e0)),
begun AS (
  SELECT k, avg(y) AS mean, list(y ORDER BY t) AS week FROM days WHERE t < 7 GROUP BY k
),
state AS (
  SELECT k, number, a, b, c, CAST(7 AS BIGINT) AS t, mean AS level, CAST(0 AS DOUBLE) AS trend, CAST(0 AS DOUBLE) AS sse,
    list_transform(range(1, 8), lambda i: coalesce(week[i] - mean, 0)) AS season
  FROM begun CROSS JOIN triples
  UNION ALL
  SELECT k, number, a, b, c, t + 1, fresh, b * (fresh - level) + (1 - b) * trend,
    sse + (y - level - trend - effect) * (y - level - trend - effect),
    list_transform(season, lambda x, i: CASE WHEN i = t % 7 + 1 THEN c * (y - fresh) + (1 - c) * effect ELSE x END)
  FROM (
    SELECT s.*, d.y, s.season[s.t % 7 + 1] AS effect,
      s.a * (d.y - s.season[s.t % 7 + 1]) + (1 - s.a) * (s.level + s.trend) AS fresh
    FROM state s JOIN days d ON d.k = s.k AND d.t = s.t
  )
),
best AS (
  SELECT s.*, p.hi, p.n FROM state s JOIN span p ON p.k = s.k AND s.t = greatest(p.n, 7)
  QUALIFY row_number() OVER (PARTITION BY s.k ORDER BY round(sse, 6), number) = 1
)"""

# Joint least squares of a trend and weekly harmonics: three sine/cosine pairs span
# the same space as seven weekday levels, so the slope is the within-weekday slope.
_FOURIER = """
daily AS (
  SELECT CAST(event_ts AS DATE) AS ds, count(*) FILTER (WHERE event_type = 'play') AS y
  FROM silver GROUP BY 1
),
timed AS (
  SELECT ds, y, ds - (SELECT min(ds) FROM daily) AS t, dayofweek(ds) AS dow FROM daily
),
level AS (SELECT dow, avg(y) AS ym, avg(t) AS tm FROM timed GROUP BY dow),
slope AS (
  SELECT sum((t - tm) * (y - ym)) / sum((t - tm) * (t - tm)) AS b
  FROM timed JOIN level USING (dow)
),
ahead AS (
  SELECT ds, y, t FROM timed
  UNION ALL
  SELECT ds + i, NULL, t + i
  FROM (SELECT max(ds) AS ds, max(t) AS t FROM timed)
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS i FROM range(1, 8))
),
fit AS (
  SELECT a.ds, a.y, l.ym + s.b * (a.t - l.tm) AS yhat
  FROM ahead a JOIN level l ON l.dow = dayofweek(a.ds) CROSS JOIN slope s
),
spread AS (SELECT 1.2816 * stddev_samp(y - yhat) AS s FROM fit WHERE y IS NOT NULL)"""

_WEEKS = f"""
weeks AS (
  SELECT {_SONG}, CAST(date_trunc('week', event_ts) AS DATE) AS week, {_n("play")} AS plays
  FROM silver GROUP BY ALL
)"""

_ZONE_ROWS = 'event_id, user_id, song_id, "timestamp", zone, _reject_reason'


_MART_SUMS = """
top_songs: total_plays total_skips
user_engagement: plays skips playlist_adds
artist_performance: total_plays total_skips skip_rate unique_listeners
churn_risk: days_inactive skip_rate
country_stats: total_plays unique_users
peak_hours: hour total_events
playlist_conversion: plays playlist_adds conversion_rate
user_loyalty: active_days
user_loyalty_monthly: active_days
dim_users: age
dim_songs: duration_seconds
dim_date: hour day_of_week
dim_devices:
daily_plays: y
listening_overview: total_plays total_skips total_playlist_adds active_users
song_skip_rate: total_skips skip_rate
preferred_device: events
country_top_device: events
song_trend_weekly: plays previous_plays change
weekly_top_songs: plays place
fact_play_events: date_key
quarantine_events: age
"""


def _mart_sums(sql: dict[str, str]) -> list[str]:
    """Per mart its rows and a hundred times the sum of each measure."""
    selects = []
    for line in _MART_SUMS.split("\n")[1:-1]:
        mart, measures = line.split(":")
        totals = ", ".join(["count(*)", *[f"CAST(round(sum({m} * 100)) AS BIGINT)" for m in measures.split()]])
        names = ", ".join(f"'{m}'" for m in ["rows", *measures.split()])
        query = sql["silver_quarantine" if mart == "quarantine_events" else mart]
        selects.append(
            f"SELECT mart, unnest(measures) AS measure, unnest(totals) AS total FROM"
            f" (SELECT '{mart}' AS mart, [{names}] AS measures, [{totals}] AS totals FROM ({query}))"
        )
    return selects


# Skips of each user in the minute up to each skip, to the microsecond.
_PEAKS = """SELECT user_id, CAST(max(n) AS BIGINT) AS peak_skips, max(n) >= 20 AS is_bot
  FROM (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(event_ts)
          RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS n
        FROM skipped WHERE event_type = 'skip')
  GROUP BY user_id"""

_BURSTS = """
skipped AS (
  SELECT user_id, event_type, CASE WHEN CAST(user_id AS BIGINT) % 7 = 0 THEN event_ts + to_microseconds(
      i * [2500000, 3157894, 3200000][CAST(CAST(user_id AS BIGINT) % 3 AS INTEGER) + 1]) ELSE event_ts END AS event_ts
  FROM silver, range(25) AS r(i)
  WHERE event_type = 'skip' AND (i = 0 OR CAST(user_id AS BIGINT) % 7 = 0)
)"""


# The twenty songs whose listeners are most alike: cosine in millionths.
_NEAR = """
heard AS (SELECT DISTINCT user_id, song_id FROM silver WHERE event_type = 'play'),
listeners AS (SELECT song_id, count(*) AS n FROM heard GROUP BY song_id),
shared AS (
  SELECT a.song_id, b.song_id AS other_id, count(*) AS common
  FROM heard a JOIN heard b ON a.user_id = b.user_id AND a.song_id <> b.song_id GROUP BY 1, 2
),
scored AS (
  SELECT s.song_id, other_id,
    CAST(floor(common * 1000000 / sqrt(CAST(x.n * y.n AS DOUBLE))) AS BIGINT) AS similarity
  FROM shared s JOIN listeners x ON x.song_id = s.song_id JOIN listeners y ON y.song_id = s.other_id
),
near AS (
  SELECT song_id, other_id, similarity, CAST(place AS INTEGER) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY similarity DESC, other_id) AS place FROM scored)
  WHERE place <= 20
)"""


def oracle_sql() -> dict[str, str]:
    sql = {
        "bronze_events": _bronze(f" SELECT {_EVENT} FROM bronze"),
        "landing_parse": _zoned(f" SELECT {_EVENT}, kafka_ingest_time FROM parsed"),
        "landing_clean": _zoned(
            f" SELECT {_EVENT}, kafka_ingest_time FROM zoned WHERE zone = 'clean'"
        ),
        "landing_quarantine": _zoned(
            f" SELECT {_EVENT}, kafka_ingest_time, _reject_reason FROM zoned"
            " WHERE zone = 'quarantine'"
        ),
        "landing_clean_strict": _bronze("""
            SELECT *, CASE WHEN _reject_reason IS NULL THEN 'clean' ELSE 'quarantine' END AS zone
            FROM (
              SELECT event_id, user_id, song_id, "timestamp",
                CASE WHEN event_id IS NULL THEN 'missing_event_id'
                  WHEN user_id IS NULL OR trim(user_id) = '' THEN 'missing_user_id'
                  WHEN song_id IS NULL THEN 'missing_song_id'
                  WHEN "timestamp" IS NULL THEN 'missing_timestamp' END AS _reject_reason
              FROM (
                SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 127 = 0 THEN ' '
                                       ELSE user_id END AS user_id)
                FROM bronze))"""),
        "zone_totals": _zoned(
            " SELECT zone, count(*) AS plays FROM zoned WHERE event_type = 'play' GROUP BY zone"
        ),
        "contract_violations": _zoned("""
            SELECT event_id, user_id, song_id, "timestamp",
              CASE WHEN cut THEN 'malformed_json' WHEN mistyped THEN 'wrong_type'
                ELSE _reject_reason END AS violation
            FROM zoned WHERE cut OR mistyped OR zone = 'quarantine'"""),
        "ndjson_clean_zone": _zoned(f" SELECT {_EVENT} FROM zoned WHERE zone = 'clean'"),
        "ndjson_quarantine_zone": _zoned(
            f" SELECT {_LEGACY}, _reject_reason FROM zoned WHERE zone = 'quarantine'"
        ),
        "ndjson_drop_undecodable": _zoned(f" SELECT {_EVENT} FROM parsed WHERE NOT cut"),
        "ndjson_hourly_archive": _zoned(f"""
            SELECT {_LEGACY}, CAST(kafka_ingest_time AS DATE) AS date,
              CAST(hour(kafka_ingest_time) AS INTEGER) AS hour FROM parsed"""),
        "clean_zone_by_country": _zoned(
            f" SELECT {_EVENT} FROM zoned WHERE zone = 'clean'"
        ),
        "bronze_load_twice": _bronze(f"""
            SELECT {_EVENT} FROM bronze WHERE event_id IS NOT NULL AND user_id IS NOT NULL
              AND song_id IS NOT NULL AND "timestamp" IS NOT NULL"""),
        "bronze_load_append": _zoned(
            " SELECT event_id, 2 * count(*) AS copies FROM zoned WHERE zone = 'clean'"
            " GROUP BY event_id"
        ),
        "bronze_load_redelivered": _zoned(f" SELECT {_EVENT} FROM zoned WHERE zone = 'clean'"),
        "bronze_load_incremental": _zoned("""
            SELECT CAST(event_id AS BIGINT) % 3 AS part, CAST(1 AS BIGINT) AS files,
              count(*) AS events, count(*) AS ids
            FROM zoned WHERE zone = 'clean' GROUP BY 1"""),
        "refresh_emptied_day": _silver(f"""
            SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS events, {_n("play")} AS plays
            FROM silver WHERE CAST(event_ts AS DATE) <> DATE '2024-01-12'
              AND (CAST(event_ts AS DATE) <> DATE '2024-01-13' OR CAST(event_id AS BIGINT) % 2 = 0)
            GROUP BY 1"""),
        "contract_drift": _zoned("""
            SELECT key, seen_type, expected_type, count(*) AS "rows" FROM (
              SELECT CAST(NULL AS VARCHAR) AS key, 'malformed' AS seen_type, CAST(NULL AS VARCHAR) AS expected_type
              FROM parsed WHERE cut
              UNION ALL SELECT 'age', 'text', 'integer' FROM parsed WHERE mistyped
              UNION ALL SELECT key, seen_type, NULL
              FROM parsed JOIN (VALUES (11, 'mood', 'text'), (13, 'device', 'object'), (17, 'tags', 'array'),
                (19, 'score', 'number'), (23, 'offline', 'boolean')) AS x(step, key, seen_type)
                ON NOT cut AND CAST(event_id AS BIGINT) % step = 0)
            GROUP BY 1, 2, 3"""),
        "silver_timestamp_texts": _bronze("""
            SELECT event_id, event_ts FROM (
              SELECT *, CASE CAST(event_id AS BIGINT) % 10 WHEN 2 THEN TIMESTAMP '2024-01-05 00:00:00'
                  WHEN 3 THEN TIMESTAMP '2024-01-05 10:00:00' WHEN 4 THEN TIMESTAMP '2024-01-05 03:00:00'
                  WHEN 9 THEN try_cast("timestamp" AS TIMESTAMP) END AS event_ts
              FROM bronze)
            WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND song_id IS NOT NULL AND event_ts IS NOT NULL"""),
        "similar_songs": _silver(" SELECT * FROM near", _NEAR),
        "recommend_similar": _silver("""
            SELECT user_id, song_id, score, CAST(place AS INTEGER) AS place FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, song_id) AS place FROM (
                SELECT user_id, other_id AS song_id, CAST(sum(similarity) AS BIGINT) AS score
                FROM heard JOIN near ON near.song_id = heard.song_id GROUP BY 1, 2) c
              WHERE NOT EXISTS (FROM heard h WHERE h.user_id = c.user_id AND h.song_id = c.song_id))
            WHERE place <= 5""", _NEAR),
        "quarantine_load_twice": _zoned(
            f" SELECT {_LEGACY}, _reject_reason FROM zoned WHERE zone = 'quarantine'"
        ),
        "legacy_bronze_load": _zoned(f" SELECT {_LEGACY} FROM zoned WHERE zone = 'clean'"),
        "silver_events": _silver(" SELECT * FROM silver"),
        "silver_quarantine": _bronze("""
            SELECT *, CASE WHEN event_id IS NULL THEN 'missing event_id'
                WHEN user_id IS NULL THEN 'missing user_id'
                WHEN song_id IS NULL THEN 'missing song_id'
                WHEN "timestamp" IS NULL THEN 'missing timestamp'
                ELSE 'invalid timestamp' END AS reject_reason
            FROM bronze
            WHERE event_id IS NULL OR user_id IS NULL OR song_id IS NULL
              OR try_cast("timestamp" AS TIMESTAMP) IS NULL"""),
        "silver_parquet_days": _silver(" SELECT * FROM silver"),
        "top_songs": _silver(f"""
            SELECT {_SONG}, {_n("play")} AS total_plays, {_n("skip")} AS total_skips
            FROM silver GROUP BY {_SONG} ORDER BY total_plays DESC, {_SONG}"""),
        "user_engagement": _silver(f"""
            SELECT user_id, device_type, country, {_n("play")} AS plays, {_n("skip")} AS skips,
              {_n("add_to_playlist")} AS playlist_adds,
              CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS day
            FROM silver GROUP BY user_id, device_type, country, date_trunc('day', event_ts)"""),
        "artist_performance": _silver(f"""
            SELECT artist_name, {_n("play")} AS total_plays, {_n("skip")} AS total_skips,
              {_ratio(_n("skip"), _n("play"))} AS skip_rate,
              count(DISTINCT user_id) AS unique_listeners
            FROM silver GROUP BY artist_name"""),
        "churn_risk": _silver(f"""
            SELECT *, CASE WHEN days_inactive > 7 THEN 'high' WHEN skip_rate > 0.7 THEN 'medium'
                ELSE 'low' END AS churn_risk
            FROM (
              SELECT user_id, max(CAST(event_ts AS DATE)) AS last_active_date,
                CAST(date_diff('day', max(CAST(event_ts AS DATE)), DATE '2024-01-31') AS INTEGER)
                  AS days_inactive,
                {_ratio(_n("skip"), "count(*)")} AS skip_rate
              FROM silver GROUP BY user_id)"""),
        "country_stats": _silver(f"""
            SELECT country, {_n("play")} AS total_plays, count(DISTINCT user_id) AS unique_users,
              max(device_type) AS top_device
            FROM silver GROUP BY country"""),
        "peak_hours": _silver("""
            SELECT country, CAST(hour(event_ts) AS INTEGER) AS hour, count(*) AS total_events
            FROM silver WHERE event_type = 'play' GROUP BY 1, 2"""),
        "playlist_conversion": _silver(f"""
            SELECT {_SONG}, {_n("play")} AS plays, {_n("add_to_playlist")} AS playlist_adds,
              {_ratio(_n("add_to_playlist"), _n("play"))} AS conversion_rate
            FROM silver GROUP BY {_SONG}"""),
        "user_loyalty": _silver("""
            SELECT *, CASE WHEN active_days >= 5 THEN 'Power' WHEN active_days >= 3 THEN 'Regular'
                ELSE 'Casual' END AS loyalty_tier
            FROM (SELECT user_id, count(DISTINCT CAST(event_ts AS DATE)) AS active_days
                  FROM silver GROUP BY user_id)"""),
        "user_loyalty_monthly": _silver("""
            SELECT *, CASE WHEN active_days >= 5 THEN 'Power' WHEN active_days >= 3 THEN 'Regular'
                ELSE 'Casual' END AS loyalty_tier
            FROM (SELECT user_id, CAST(date_trunc('month', event_ts) AS DATE) AS month,
                    count(DISTINCT CAST(event_ts AS DATE)) AS active_days
                  FROM silver GROUP BY 1, 2)"""),
        "dim_users": _silver(
            " SELECT DISTINCT user_id, country, device_type, subscription_type, age FROM silver"
        ),
        "dim_songs": _silver(f" SELECT DISTINCT {_SONG}, genre, duration_seconds FROM silver"),
        "dim_date": _silver("""
            SELECT DISTINCT CAST(date_trunc('hour', event_ts) AS TIMESTAMP) AS date_hour,
              CAST(event_ts AS DATE) AS date_day, CAST(hour(event_ts) AS INTEGER) AS hour,
              CAST(extract(dow FROM event_ts) AS INTEGER) AS day_of_week,
              extract(dow FROM event_ts) IN (0, 6) AS is_weekend
            FROM silver"""),
        "dim_devices": _silver(" SELECT DISTINCT device_type FROM silver"),
        "daily_plays": _silver(f"""
            SELECT CAST(event_ts AS DATE) AS ds, {_n("play")} AS y
            FROM silver GROUP BY 1 ORDER BY 1"""),
        "listening_overview": _silver(f"""
            SELECT {_n("play")} AS total_plays, {_n("skip")} AS total_skips,
              {_n("add_to_playlist")} AS total_playlist_adds,
              count(DISTINCT user_id) AS active_users FROM silver"""),
        "top10_songs": _silver(f"""
            SELECT {_SONG}, {_n("play")} AS total_plays, {_n("skip")} AS total_skips
            FROM silver GROUP BY {_SONG} ORDER BY total_plays DESC, {_SONG} LIMIT 10"""),
        "song_skip_rate": _silver(f"""
            SELECT {_SONG}, {_n("play")} AS total_plays, {_n("skip")} AS total_skips,
              {_ratio(_n("skip"), _n("play"))} AS skip_rate
            FROM silver GROUP BY {_SONG}"""),
        "preferred_device": _silver("""
            SELECT user_id, device_type AS preferred_device, n AS events
            FROM (SELECT user_id, device_type, count(*) AS n, row_number() OVER (
                    PARTITION BY user_id ORDER BY count(*) DESC, device_type) AS place
                  FROM silver GROUP BY user_id, device_type)
            WHERE place = 1"""),
        "country_top_device": _silver("""
            SELECT country, device_type AS top_device, n AS events
            FROM (SELECT country, device_type, count(*) AS n, row_number() OVER (
                    PARTITION BY country ORDER BY count(*) DESC, device_type) AS place
                  FROM silver GROUP BY country, device_type)
            WHERE place = 1"""),
        "song_trend_weekly": _silver(f"""
            SELECT w.*, coalesce(b.plays, 0) AS previous_plays,
              w.plays - coalesce(b.plays, 0) AS change
            FROM weeks w LEFT JOIN weeks b ON b.song_id = w.song_id
              AND b.song_name = w.song_name AND b.artist_name = w.artist_name
              AND b.week = w.week - 7""", _WEEKS),
        "weekly_top_songs": _silver(f"""
            SELECT {_SONG}, week, plays, CAST(place AS INTEGER) AS place
            FROM (SELECT *, row_number() OVER (
                    PARTITION BY week ORDER BY plays DESC, {_SONG}) AS place FROM weeks)
            WHERE place <= 10""", _WEEKS),
        "fact_play_events": _silver("""
            SELECT event_id, user_id, song_id, device_type,
              CAST(strftime(event_ts, '%Y%m%d%H') AS BIGINT) AS date_key, event_type, event_ts
            FROM silver"""),
        "star_plays_by_genre": _silver(f"""
            SELECT genre, extract(dow FROM event_ts) IN (0, 6) AS is_weekend,
              {_n("play")} AS plays FROM silver GROUP BY 1, 2"""),
        "skip_bursts": _silver(f" {_PEAKS}".replace("skipped", "silver")),
        "skip_bursts_bot": _silver(f" {_PEAKS}", _BURSTS),
        "stream_skip_bots": _silver(f" SELECT user_id FROM ({_PEAKS}) WHERE is_bot", _BURSTS),
        "song_keys": _silver("""
            SELECT song_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3)
              || '-' || ['8', '9', 'a', 'b'][(strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1]
              || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS song_uuid
            FROM (SELECT song_id, sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8')
                    || encode(artist_name || '::' || song_name)) AS h
                  FROM (SELECT DISTINCT song_id, song_name, artist_name, genre,
                          duration_seconds FROM silver))"""),
        "dedup_events": _bronze(f" SELECT {_EVENT} FROM bronze"),
        "catalog_query": _silver(f"""
            SELECT artist_name, count(*) AS songs, CAST(sum(p) AS BIGINT) AS total_plays
            FROM (SELECT {_SONG}, {_n("play")} AS p FROM silver GROUP BY {_SONG})
            GROUP BY artist_name"""),
        "dq_report": _silver(" " + _report_rows("silver", _SILVER_RULES)),
        "dq_report_dirty": _dirty(" " + _report_rows("silver", _SILVER_RULES)),
        "dq_report_bronze": _bronze(
            " "
            + _report_rows(
                "bronze",
                [("not_null", c, None) for c in ("event_id", "user_id", "song_id")]
                + [("not_null", '"timestamp"', None), ("unique", "event_id", None)],
            ).replace("'\"timestamp\"'", "'timestamp'")
        ),
        "dq_duplicate_ids": _dirty("""
            SELECT event_id, count(*) AS copies FROM silver
            GROUP BY event_id HAVING count(*) > 1"""),
        "dq_unexpected_values": _dirty("""
            SELECT 'event_type' AS "column", event_type AS value, count(*) AS "rows" FROM silver
            WHERE event_type NOT IN ('play', 'pause', 'skip', 'add_to_playlist')
            GROUP BY event_type"""),
        "forecast_trend_baseline": _silver(
            f" SELECT ds, {_BANDS} FROM forecast", _forecast_ctes(_ALL, 7)
        ),
        "forecast_last_rows": _silver(
            f" SELECT ds, {_BANDS} FROM forecast ORDER BY ds DESC LIMIT 10",
            _forecast_ctes(_ALL, 7),
        ),
        "forecast_metrics": _silver("""
            SELECT round(avg(abs(yhat - y)), 2) AS mae,
              round(sqrt(avg((yhat - y) * (yhat - y))), 2) AS rmse,
              count(*) AS data_days, CAST(sum(y) AS BIGINT) AS total_plays
            FROM forecast WHERE y IS NOT NULL""", _forecast_ctes(_ALL, 7)),
        "forecast_run_log": _silver(f"""
            SELECT 'daily-plays' AS run_id, kind, name, value FROM (
              SELECT 'metric' AS kind, 'data_days' AS name,
                CAST(count(DISTINCT CAST(event_ts AS DATE)) AS VARCHAR) AS value FROM silver
              UNION ALL
              SELECT 'metric', 'total_plays', CAST({_n("play")} AS VARCHAR) FROM silver
              UNION ALL
              SELECT 'metric', 'mae', CAST(round(avg(abs(yhat - y)), 2) AS VARCHAR)
                FROM forecast WHERE y IS NOT NULL
              UNION ALL
              SELECT 'metric', 'rmse', CAST(round(sqrt(avg((yhat - y) * (yhat - y))), 2) AS VARCHAR)
                FROM forecast WHERE y IS NOT NULL
              UNION ALL
              SELECT * FROM (VALUES ('param', 'forecast_periods', '7'),
                ('param', 'weekly_seasonality', 'True'), ('param', 'daily_seasonality', 'False'),
                ('param', 'yearly_seasonality', 'False'),
                ('param', 'model_type', 'linear trend with weekday effect')))""", _forecast_ctes(_ALL, 7)),
        "forecast_fourier": _silver("""
            SELECT ds, round(yhat, 3) AS yhat, round(yhat - s, 3) AS yhat_lower,
              round(yhat + s, 3) AS yhat_upper FROM fit CROSS JOIN spread""", _FOURIER),
        "forecast_by_song": _silver(
            f" SELECT k AS song_id, ds, {_BANDS} FROM forecast", _forecast_ctes("song_id", 7)
        ),
        "forecast_changepoints": _silver("""
            SELECT ds, round(yhat, 4) + 0.0 AS yhat, round(yhat - s, 4) + 0.0 AS yhat_lower,
              round(yhat + s, 4) + 0.0 AS yhat_upper FROM fit CROSS JOIN spread""", _CHANGEPOINTS).replace("WITH ", "WITH RECURSIVE ", 1),
        "forecast_seasonal_by_song": _silver("""
            SELECT k AS song_id, hi + step AS ds,
              round(level + step * trend + season[(n + step - 1) % 7 + 1], 4) + 0.0 AS yhat,
              number AS smoothing, round(CASE WHEN n > 7 THEN sse / (n - 7) END, 4) AS mse
            FROM best CROSS JOIN (SELECT CAST(range AS INTEGER) AS step FROM range(1, 8))""", _SEASONAL).replace("WITH ", "WITH RECURSIVE ", 1),
        "unique_listeners": _silver("""
            SELECT artist_name, count(DISTINCT user_id) AS exact, true AS within_bound FROM silver
            WHERE CAST(event_ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-15'
            GROUP BY artist_name"""),
        "forecast_peak_hour": _silver("""
            SELECT ds, CAST(hour AS INTEGER) AS peak_hour, yhat
            FROM (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY yhat DESC, hour) AS place
                  FROM (SELECT ds, k AS hour, round(yhat, 6) AS yhat FROM forecast
                        WHERE y IS NULL))
            WHERE place = 1""", _forecast_ctes("hour(event_ts)", 1, fill=True)),
        "forecast_table": _silver(
            f" SELECT ds, {_BANDS} FROM forecast WHERE y IS NULL", _forecast_ctes(_ALL, 7)
        ),
        "stream_zones_single_scan": _zoned(f" SELECT {_ZONE_ROWS} FROM zoned"),
        "stream_zones_two_queries": _zoned(f" SELECT {_ZONE_ROWS} FROM zoned"),
        "stream_table_load": _zoned(f" SELECT {_EVENT} FROM zoned WHERE zone = 'clean'"),
        "stream_plays_per_minute": _silver(f"""
            SELECT CAST(date_trunc('minute', event_ts) AS TIMESTAMP) AS window_start,
              CAST(date_trunc('minute', event_ts) AS TIMESTAMP) + INTERVAL 1 MINUTE AS window_end,
              {_n("play")} AS plays
            FROM silver GROUP BY 1, 2"""),
        "stream_skip_windows": _silver("""
            SELECT user_id, window_start, window_start + INTERVAL 60 SECOND AS window_end,
              count(*) AS skips, count(*) >= 20 AS is_bot
            FROM (SELECT user_id, CAST(time_bucket(INTERVAL 30 SECOND, event_ts) AS TIMESTAMP)
                    - back * INTERVAL 30 SECOND AS window_start
                  FROM silver CROSS JOIN (VALUES (0), (1)) AS b(back)
                  WHERE event_type = 'skip')
            GROUP BY user_id, window_start"""),
        "stream_unique_events": _silver(
            " SELECT * EXCLUDE (album_name) FROM silver"
        ),
    }
    sql["rollup_churn_risk"] = sql["churn_risk"]
    sql["rollup_artist_performance"] = sql["artist_performance"]
    for mart in ("churn_risk", "user_loyalty", "user_engagement", "preferred_device"):
        sql[f"bucketed_{mart}"] = sql[mart]
    sql["gold_build"] = "\nUNION ALL\n".join(_mart_sums(sql))
    sql["publish_after_gate"] = "\nUNION ALL\n".join(
        [*_mart_sums(sql), f"SELECT 'silver' AS mart, 'rows' AS measure, count(*) AS total FROM ({sql['silver_events']})"]
    )
    return sql
