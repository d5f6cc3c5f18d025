"""SQL for each registered query, written against the plain tables (DuckDB dialect).

The statements share nothing with the Spark side but the fixed list of halves:
ranges are joined with BETWEEN, roll-ups are UNION ALL or grouping sets, session
numbers come from event-level windows.
"""

from __future__ import annotations

from ..functions.ratios import BELOW_HALF

# --- fixed values, stated here once more so that a wrong bound on the Spark side shows: column, packed name, bounds
TIME_BUCKETS = {
    "time_1s_3s": ("1s_3s", 0, 3), "time_4s_6s": ("4s_6s", 4, 6), "time_7s_9s": ("7s_9s", 7, 9),
    "time_10s_30s": ("10s_30s", 10, 30), "time_30s_60s": ("30s_60s", 31, 60), "time_1m_3m": ("1m_3m", 61, 180),
    "time_3m_10m": ("3m_10m", 181, 600), "time_10m_30m": ("10m_30m", 601, 1800), "time_30m": ("30m", 1801, None),
}
STEP_BUCKETS = {
    "step_1_3": ("1_3", 1, 3), "step_4_6": ("4_6", 4, 6), "step_7_9": ("7_9", 7, 9),
    "step_10_30": ("10_30", 10, 30), "step_30_60": ("30_60", 31, 60), "step_60": ("60", 61, None),
}
# ------------------------------------------------------------------------------

VISITS = """
src AS (
    SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS ms,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           (user_id // 27 + CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END) % 4 AS slot
    FROM events),
visits AS (
    SELECT event_id, 'u' || user_id AS uid,
           ms - ms % 86400000 + (ms % 86400000) // 40 AS access_time,
           strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS dt,
           'u' || user_id || '-' || (ms // 86400000) AS sid,
           CASE event_type WHEN 'signup' THEN 'e_l' WHEN 'view' THEN 'e_pv' WHEN 'click' THEN 'e_pv'
                           WHEN 'purchase' THEN 'e_bp' ELSE 'e_s' END AS en,
           CASE user_id % 3 WHEN 0 THEN 'pc' WHEN 1 THEN 'ios' ELSE 'android' END AS pl,
           CASE WHEN event_type = 'purchase' AND k % 10 <> 0 THEN CAST(k AS VARCHAR) END AS pid,
           (user_id % 27 + 1) * 16777216 + slot * 65536 + user_id AS ip_num
    FROM src),
addressed AS (
    SELECT *, (ip_num >> 24) || '.' || ((ip_num >> 16) & 255) || '.' || ((ip_num >> 8) & 255) || '.'
              || (ip_num & 255) AS ip
    FROM visits)
"""

RULES = """
rules AS (
    SELECT (n_nationkey + 1)::BIGINT * 16777216 + c * 65536 AS start_ip,
           (n_nationkey + 1)::BIGINT * 16777216 + c * 65536 + 65535 AS end_ip,
           r_name AS country, n_name AS province, 'CITY_' || n_nationkey || '_' || c AS city
    FROM nation JOIN region ON n_regionkey = r_regionkey, range(4) AS g(c))
"""

WEBLOG = f"""
{VISITS}, {RULES},
located AS (
    SELECT a.*, coalesce(r.country, 'unknown') AS country, coalesce(r.province, 'unknown') AS province,
           coalesce(r.city, 'unknown') AS city
    FROM addressed a LEFT JOIN rules r ON a.ip_num BETWEEN r.start_ip AND r.end_ip),
weblog AS (
    SELECT * REPLACE (
        CASE WHEN event_id % 97 = 0 THEN 'all' WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'pc'
             ELSE pl END AS pl,
        CASE WHEN event_id % 83 <> 0 THEN uid END AS uid, CASE WHEN event_id % 79 <> 0 THEN sid END AS sid,
        CASE WHEN event_id % 101 = 0 THEN 'all' ELSE province END AS province,
        CASE WHEN event_id % 101 = 0 THEN 'all' ELSE city END AS city)
    FROM located)
"""

# what a correct parser makes of the raw lines, by kind of line
PARSED = f"""
{WEBLOG},
parsed AS (
    SELECT * REPLACE (CASE WHEN event_id % 50 = 7 THEN 'Far Away!' ELSE country END AS country),
           CASE WHEN event_id % 50 = 12 THEN 'café au lait' END AS tt,
           4 + CASE WHEN pid IS NULL THEN 0 ELSE 1 END
             + CASE WHEN event_id % 50 IN (7, 12) THEN 1 ELSE 0 END AS n_params
    FROM located WHERE event_id % 50 NOT IN (2, 3, 5, 8, 9, 11))
"""

GRAIN = f"""
{WEBLOG},
grain AS (
    SELECT dt, pl, country, province, city, uid, sid, count(*) AS n,
           count(*) FILTER (en = 'e_l') AS n_launch, count(*) FILTER (en IN ('e_pv', 'e_bp')) AS n_view,
           count(*) FILTER (en = 'e_bp') AS n_bp, min(access_time) AS min_ts, max(access_time) AS max_ts
    FROM weblog GROUP BY ALL)
"""

# a total is told by GROUPING(), not by its label
PL = "CASE WHEN GROUPING(pl) = 1 THEN 'all' ELSE pl END AS pl, CAST(GROUPING(pl) AS INTEGER) AS level"

METRICS = f"""
{WEBLOG},
metrics AS (
    SELECT dt, {PL}, sid, (max(access_time) - min(access_time)) // 1000 AS length_s,
           count(*) FILTER (en IN ('e_pv', 'e_bp')) AS steps
    FROM weblog GROUP BY GROUPING SETS ((dt, pl, sid), (dt, sid)))
"""


def _bucket_counts(value: str, buckets: dict) -> str:
    return ", ".join(
        f"count(*) FILTER ({value} >= {lo}" + (f" AND {value} <= {hi}" if hi is not None else "") + f") AS {name}"
        for name, (_, lo, hi) in buckets.items()
    )


HIST = f"""
{METRICS},
hist AS (
    SELECT dt, pl, level, count(*) AS session_count, {_bucket_counts('length_s', TIME_BUCKETS)},
           {_bucket_counts('steps', STEP_BUCKETS)}
    FROM metrics GROUP BY dt, pl, level)
"""


def _ratio(name: str) -> str:
    halves = ", ".join(map(str, BELOW_HALF))
    return (
        f"((200 * {name} + session_count) // (2 * session_count) - CASE WHEN (200 * {name}) % session_count = 0 "
        f"AND (200 * {name}) // session_count IN ({halves}) THEN 1 ELSE 0 END) / 100.0::DOUBLE AS {name}"
    )


RATIOS = ", ".join(_ratio(name) for name in [*TIME_BUCKETS, *STEP_BUCKETS])
PACKED = " || '|' || ".join(
    f"'{packed}=' || {name}" for name, (packed, _, _) in {**TIME_BUCKETS, **STEP_BUCKETS}.items()
)


# missing users and sessions count as one
USERS, SESSIONS = "count(DISTINCT coalesce(uid, '-'))", "count(DISTINCT coalesce(sid, '-'))"


def _user_stats(length: str, name: str = "") -> str:
    query = f"""
    SELECT dt, {PL}, {USERS} AS active_users, count(*) FILTER (en = 'e_l') AS new_install_users,
           {SESSIONS} AS session_count, count(*) FILTER (en IN ({length})) // {SESSIONS} AS session_length
    FROM weblog GROUP BY GROUPING SETS ((dt, pl), (dt))"""
    return f"WITH {WEBLOG}" + (f", {name} AS ({query})" if name else query)


def _rolled(dims: list[str], sets: list[str], more: str = "") -> tuple[str, str]:
    """Labels and level of roll-up rows, and the grouping sets."""
    labels = ", ".join(f"CASE WHEN GROUPING({d}) = 1 THEN 'all' ELSE {d} END AS {d}" for d in dims)
    return (f"dt, {labels}, CAST(GROUPING({', '.join(dims)}) AS INTEGER) AS level",
            f"GROUPING SETS ({', '.join(f'(dt, {s}{more})' for s in sets)})")


PLACES = ["country", "country, province", "country, province, city"]
PLACED = ["country", "province", "city"]


def _places(name: str, dims: list[str], sets: list[str], values: str) -> str:
    """Statistics per place with one-event sessions, as the table ``name``."""
    labels, groups = _rolled(dims, sets)
    _, with_session = _rolled(dims, sets, ", sid")
    same = " AND ".join(f"t.{c} IS NOT DISTINCT FROM s.{c}" for c in ["dt", *dims, "level"])
    return f"""
{WEBLOG},
totals_{name} AS (SELECT {labels}, {values} FROM weblog GROUP BY {groups}),
per_session AS (SELECT {labels}, sid, count(*) AS n FROM weblog GROUP BY {with_session}),
singles AS (SELECT dt, {', '.join(dims)}, level, count(*) FILTER (n = 1) AS n_single FROM per_session
            GROUP BY dt, {', '.join(dims)}, level),
{name} AS (SELECT t.*, s.n_single FROM totals_{name} t JOIN singles s ON {same})
"""


DEVICE = _places("device", ["pl", *PLACED], [*PLACES, *[f"pl, {p}" for p in PLACES]],
                 f"{USERS} AS active_users, {SESSIONS} AS session_count")
FLOW = _places("flow", PLACED, PLACES,
               f"count(*) FILTER (en = 'e_l') AS nu, {USERS} AS uv, count(*) FILTER (en IN ('e_pv', 'e_bp')) AS pv, "
               f"{SESSIONS} AS sn")

TOTALS = """
area_counts AS (
    SELECT dt, country, province, city, pid AS product_id, count(*) AS browser_count
    FROM {source} WHERE en = 'e_bp' AND pid IS NOT NULL GROUP BY ALL),
totals AS (
    SELECT dt, country, province, product_id, CAST(sum(browser_count) AS BIGINT) AS browser_count,
           string_agg(city, ',' ORDER BY city) AS city_infos
    FROM area_counts GROUP BY dt, country, province, product_id)
"""


def _top3(base: str, source: str, name: str = "") -> str:
    query = """
    SELECT dt, country, province, product_id, browser_count, city_infos FROM totals
    QUALIFY row_number() OVER (PARTITION BY dt, country, province ORDER BY browser_count DESC, product_id) <= 3"""
    return f"WITH {base}, {TOTALS.format(source=source)}" + (f", {name} AS ({query})" if name else query)


def _dim_ids(table: str, *key: str) -> str:
    order = ", ".join(f"{k} NULLS FIRST" for k in key)
    return f"SELECT row_number() OVER (ORDER BY {order}) AS id, {', '.join(key)} FROM {table}"


def _sessions(gap: int, opener: str) -> str:
    # events of one millisecond act together
    return f"""WITH {VISITS},
    moments AS (SELECT uid, access_time, bool_or({opener}) AS opens, count(*) AS n FROM visits GROUP BY ALL),
    flagged AS (
        SELECT *, CASE WHEN lag(access_time) OVER w IS NULL THEN 1
                       WHEN access_time - lag(access_time) OVER w > {gap} AND opens THEN 1 ELSE 0 END AS starts
        FROM moments WINDOW w AS (PARTITION BY uid ORDER BY access_time)),
    numbered AS (
        SELECT uid, access_time, n, CAST(sum(starts) OVER (PARTITION BY uid ORDER BY access_time) AS BIGINT)
               AS session_no
        FROM flagged)"""


DATE_PARTS = """
    CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS season, CAST(month(d) AS INTEGER) AS month,
    CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day,
    strftime(d, '%Y-%m-%d') AS calendar, 'day' AS type
"""

DATE_KEY = ("year", "season", "month", "week", "day", "calendar", "type")


def _ids(stat: str, platform: bool = False, city: str = "") -> str:
    """Dimension tables over the keys of one statistic."""
    parts = [
        f"days AS (SELECT DISTINCT CAST(dt AS DATE) AS d FROM {stat})",
        f"parts AS (SELECT {DATE_PARTS} FROM days)",
        f"dates AS ({_dim_ids('parts', *DATE_KEY)})",
    ]
    if platform:
        parts += [f"named AS (SELECT DISTINCT pl AS platform_name FROM {stat})",
                  f"platforms AS ({_dim_ids('named', 'platform_name')})"]
    if city:
        parts += [f"place_keys AS (SELECT DISTINCT country, province, {city} AS city FROM {stat})",
                  f"places AS ({_dim_ids('place_keys', 'country', 'province', 'city')})"]
    return ", ".join(parts)


# ranges over several slices
_WIDE = f"""WITH {VISITS},
    wide AS (SELECT n_nationkey, n_name, k, low, high, name
             FROM nation, (VALUES (0, 0, 150000, 'NEAR'), (1, 150001, 226608, 'FAR')) AS r(k, low, high, name)),
    wide_rules AS (SELECT (n_nationkey + 1)::BIGINT * 16777216 + low AS start_ip,
                          (n_nationkey + 1)::BIGINT * 16777216 + high AS end_ip,
                          name AS country, n_name AS province, 'WIDE_' || n_nationkey || '_' || k AS city FROM wide)
    SELECT event_id, coalesce(country, 'unknown') AS country, coalesce(province, 'unknown') AS province,
           coalesce(city, 'unknown') AS city
    FROM visits LEFT JOIN wide_rules ON ip_num BETWEEN start_ip AND end_ip"""

ORACLES: dict[str, str] = {
    "ip_rules": f"WITH {RULES} SELECT * FROM rules",
    "parse_log": f"""WITH {PARSED}
        SELECT ip, access_time, country, province, city, uid, sid, en, pl, pid, tt, n_params FROM parsed""",
    "bad_records": f"""WITH {VISITS}
        SELECT CASE event_id % 50 WHEN 8 THEN 'bad_escape' WHEN 9 THEN 'bad_ip' WHEN 11 THEN 'bad_time'
                                  ELSE 'no_uid' END AS reason, count(*) AS n
        FROM visits WHERE event_id % 50 IN (5, 8, 9, 11) GROUP BY 1""",
    "parse_params": """
        WITH items AS (
            SELECT page_id, unnest(string_split(split_part(url, '?', 2), '&')) AS item,
                   generate_subscripts(string_split(split_part(url, '?', 2), '&'), 1) AS i
            FROM pages WHERE length(url) - length(replace(rtrim(url, '?'), '?', '')) - (length(url) - length(rtrim(url, '?'))) = 1),
        sides AS (
            SELECT page_id, i, string_split(rtrim(item, '='), '=') AS kv FROM items)
        SELECT page_id, url_decode(kv[1]) AS name, url_decode(kv[2]) AS val FROM sides
        WHERE len(kv) = 2 AND trim(kv[1]) <> '' AND trim(kv[2]) <> ''
        QUALIFY row_number() OVER (PARTITION BY page_id, url_decode(kv[1]) ORDER BY i DESC) = 1""",
    "ip_to_long": f"WITH {VISITS} SELECT event_id, ip, ip_num AS ip_number FROM addressed",
    "ip_region": f"WITH {WEBLOG} SELECT event_id, ip, country, province, city FROM weblog",
    "event_day_scan": f"""WITH {WEBLOG}
        SELECT uid, sid, access_time, en, country, province, city, pl, pid FROM weblog WHERE dt = '2024-01-15'
        QUALIFY row_number() OVER (PARTITION BY access_time, uid, en ORDER BY event_id DESC) = 1""",
    "ip_region_wide": _WIDE, "ip_region_by_shuffle": _WIDE,
    "event_dedup": f"""WITH {VISITS},
        twice AS (
            SELECT *, event_id AS ingest_seq FROM addressed
            UNION ALL
            SELECT * REPLACE ('pc' AS pl), event_id + 1000000000 FROM addressed WHERE event_id % 10 = 0)
        SELECT access_time, uid, en, sid, pl, pid, ip, ingest_seq FROM twice
        QUALIFY row_number() OVER (PARTITION BY access_time, uid, en ORDER BY ingest_seq DESC) = 1""",
    "date_ops": f"""WITH {VISITS}
        SELECT event_id, replace(dt, '-', '/') AS day_path,
               strftime(CAST(dt AS DATE) + 1, '%Y-%m-%d') AS next_day,
               epoch_ms(CAST(dt AS TIMESTAMP)) AS day_ms,
               epoch_ms(CAST(dt AS TIMESTAMP)) + 86400000 AS next_day_ms
        FROM visits""",
    "date_dimension": f"""
        WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
        parts AS (SELECT {DATE_PARTS} FROM days)
        {_dim_ids('parts', *DATE_KEY)}""",
    "valid_date": """
        WITH moved AS (
            SELECT o_orderkey,
                   CASE WHEN o_orderkey % 11 = 0 THEN '0000' WHEN o_orderkey % 13 = 0 THEN '2000'
                        ELSE strftime(o_orderdate, '%Y') END || '-' ||
                   CASE WHEN o_orderkey % 3 = 0 THEN lpad(CAST(o_orderkey % 14 AS VARCHAR), 2, '0')
                        ELSE strftime(o_orderdate, '%m') END || '-' ||
                   CASE WHEN o_orderkey % 2 = 0 THEN lpad(CAST(o_orderkey % 33 AS VARCHAR), 2, '0')
                        WHEN o_orderkey % 17 = 0 THEN '1' ELSE strftime(o_orderdate, '%d') END AS day_text
            FROM orders)
        SELECT o_orderkey, day_text,
               CASE WHEN regexp_full_match(day_text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND day_text NOT LIKE '0000%'
                         AND TRY_CAST(day_text AS DATE) IS NOT NULL THEN 1 ELSE 0 END AS valid
        FROM moved""",
    "ua_class": f"""WITH {VISITS}
        SELECT event_id, 'Mozilla/5.0 (' || CASE WHEN pl = 'android' THEN 'Linux; Android 13'
                   WHEN pl = 'ios' AND event_id % 2 = 0 THEN 'iPhone; CPU OS 17'
                   WHEN pl = 'ios' THEN 'iPad; CPU OS 17' ELSE 'X11; Linux x86_64' END || ') r/' || event_id AS b_usa,
               CASE WHEN pl = 'android' THEN 'android' WHEN pl = 'ios' AND event_id % 2 = 0 THEN 'iphone'
                    ELSE 'pc' END AS device
        FROM visits""",
    "session_grain": f"WITH {GRAIN} SELECT * FROM grain",
    "session_metrics": f"WITH {METRICS} SELECT * FROM metrics",
    "session_hist": f"WITH {HIST} SELECT * FROM hist",
    "session_aggr_stat": f"WITH {HIST} SELECT dt, pl, level, session_count, {RATIOS} FROM hist",
    "session_hist_packed": f"""WITH {HIST}
        SELECT dt, pl, level, 'session_count=' || session_count || '|' || {PACKED} AS packed FROM hist""",
    "stats_user": _user_stats("'e_bp'"),
    "stats_user_all_views": _user_stats("'e_pv', 'e_bp'"),
    "stats_device_location": f"WITH {DEVICE} SELECT * RENAME (n_single AS bounce_sessions) FROM device",
    "location_flow": f"WITH {FLOW} SELECT * RENAME (n_single AS \"on\") FROM flow",
    "event_cube": f"""WITH {WEBLOG}
        SELECT dt, CASE WHEN GROUPING(pl) = 1 THEN 'all' ELSE pl END AS pl,
               CASE WHEN GROUPING(en) = 1 THEN 'all' ELSE en END AS en, CAST(GROUPING(pl, en) AS INTEGER) AS level,
               count(*) AS event_count
        FROM weblog GROUP BY GROUPING SETS ((dt, pl, en), (dt, pl), (dt, en), (dt))""",
    "product_area_count": f"WITH {WEBLOG}, {TOTALS.format(source='weblog')} SELECT * FROM area_counts",
    "city_concat": f"WITH {WEBLOG}, {TOTALS.format(source='weblog')} SELECT * FROM totals",
    "area_top3_product": _top3(PARSED, "parsed"),
    "topk_per_group": f"""WITH {VISITS},
        per_user AS (SELECT dt, uid, count(*) AS n FROM visits GROUP BY ALL)
        SELECT dt, uid, n, CAST(row_number() OVER (PARTITION BY dt ORDER BY n DESC, uid) AS INTEGER) AS rank
        FROM per_user QUALIFY rank <= 5""",
    "sql_surface": _top3(WEBLOG, "weblog"),
    "sessionize": f"""{_sessions(18 * 60 * 1000, 'true')}
        SELECT v.event_id, uid, access_time, session_no FROM visits v JOIN numbered USING (uid, access_time)""",
    "sessionize_page_opened": f"""{_sessions(18 * 60 * 1000, "en IN ('e_pv', 'e_l')")}
        SELECT v.event_id, uid, access_time, session_no FROM visits v JOIN numbered USING (uid, access_time)""",
    "session_summary": f"""{_sessions(2 * 60 * 1000, 'true')}
        SELECT uid, session_no, min(access_time) AS start_ts, max(access_time) AS end_ts,
               CAST(sum(n) AS BIGINT) AS n
        FROM numbered GROUP BY uid, session_no""",
    "first_visit": f"""WITH {VISITS}
        SELECT uid, event_id, access_time, en, pl FROM visits
        QUALIFY row_number() OVER (PARTITION BY uid ORDER BY access_time, event_id) = 1""",
    "word_count": """
        SELECT word, count(*) AS n FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents)
        GROUP BY word""",
    "dim_platform": f"""WITH {VISITS},
        named AS (SELECT DISTINCT pl AS platform_name FROM visits UNION SELECT 'all' FROM visits)
        {_dim_ids('named', 'platform_name')}""",
    "dim_location": f"""WITH {WEBLOG},
        placed AS (SELECT DISTINCT country, province, city FROM weblog)
        {_dim_ids('placed', 'country', 'province', 'city')}""",
    "packed_fields": f"WITH {HIST} SELECT * REPLACE (CAST(-1 AS BIGINT) AS step_60) FROM hist",
    "fact_session_aggr_stat": f"""WITH {HIST}, stat AS (SELECT dt, pl, level, session_count, {RATIOS} FROM hist),
        {_ids('stat', platform=True)}
        SELECT d.id AS date_dimension_id, p.id AS platform_dimension_id, v.* EXCLUDE (dt, pl)
        FROM stat v JOIN dates d ON d.calendar = v.dt JOIN platforms p ON p.platform_name IS NOT DISTINCT FROM v.pl""",
    "fact_stats_user": f"""{_user_stats("'e_bp'", 'stat')}, {_ids('stat', platform=True)}
        SELECT d.id AS date_dimension_id, p.id AS platform_dimension_id, v.* EXCLUDE (dt, pl), dt AS created
        FROM stat v JOIN dates d ON d.calendar = v.dt JOIN platforms p ON p.platform_name IS NOT DISTINCT FROM v.pl""",
    "fact_stats_device_location": f"""WITH {DEVICE}, {_ids('device', platform=True, city='city')}
        SELECT d.id AS date_dimension_id, p.id AS platform_dimension_id, l.id AS location_dimension_id, level,
               active_users, session_count, n_single AS bounce_sessions, dt AS created
        FROM device v JOIN dates d ON d.calendar = v.dt JOIN platforms p ON p.platform_name IS NOT DISTINCT FROM v.pl
        JOIN places l ON l.country = v.country AND l.province = v.province AND l.city = v.city""",
    "fact_area_top3_product": f"""{_top3(WEBLOG, 'weblog', 'top')}, {_ids('top', city="'all'")}
        SELECT d.id AS date_dimension_id, l.id AS location_dimension_id, CAST(product_id AS BIGINT) AS product_id,
               browser_count AS browser_product_count, city_infos
        FROM top v JOIN dates d ON d.calendar = v.dt
        JOIN places l ON l.country = v.country AND l.province = v.province""",
    "fact_stats_location_flow": f"""WITH {FLOW}, {_ids('flow', city='city')}
        SELECT d.id AS date_dimension_id, l.id AS location_dimension_id, level, nu, uv, pv, sn,
               n_single AS "on", dt AS created
        FROM flow v JOIN dates d ON d.calendar = v.dt
        JOIN places l ON l.country = v.country AND l.province = v.province AND l.city = v.city""",
    "flow_upsert_latest": f"""WITH {VISITS}
        SELECT dt, pl, count(*) FILTER (en = 'e_l') AS nu, count(*) FILTER (en IN ('e_pv', 'e_bp')) AS pv,
               'batch ' || min(access_time // 60000) AS created
        FROM visits GROUP BY dt, pl""",
}
