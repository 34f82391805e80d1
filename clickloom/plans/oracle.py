"""SQL for an independent engine: each registered query over the same tables."""

from __future__ import annotations

from clickloom.plans import parameters as P
from clickloom.sources import testdata as D

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_ACTIONS = f"""
actions AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         k % 10 AS page_id, ts AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k END AS click_product_id,
         CASE WHEN event_type = 'signup'
              THEN CAST(k % 20 AS VARCHAR) || ',' || CAST((k * 7) % 20 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase'
              THEN CAST(k % 20 AS VARCHAR) || ',' || CAST((k * 3) % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id, event_id
  FROM (SELECT *, {_K} AS k FROM events)
)"""

_PROFILE = """
profile AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time, max(action_time) AS end_time,
         date_diff('second', min(action_time), max(action_time)) AS visit_length,
         count(*) AS step_length,
         coalesce(string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword), '') AS search_keywords,
         coalesce(list_sort(list(DISTINCT click_category_id) FILTER (click_category_id IS NOT NULL)),
                  CAST([] AS BIGINT[])) AS category_list,
         coalesce(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL),
                  CAST([] AS VARCHAR[])) AS keyword_list
  FROM actions GROUP BY session_id
)"""

_USERS = """
users AS (
  SELECT c_custkey AS user_id, CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || CAST(c_nationkey AS VARCHAR) AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer
)"""

_USER_PROFILE = """
user_profile AS (
  SELECT p.*, u.age, u.professional, u.sex, u.city FROM profile p JOIN users u ON p.user_id = u.user_id
)"""


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


_PROFILE_COLUMNS = f"""session_id, user_id, {_time('start_time')} AS start_time, {_time('end_time')} AS end_time,
  visit_length, step_length, search_keywords,
  array_to_string(category_list, ',') AS click_category_ids"""


def _conditions(chosen) -> str:
    tests = []
    if chosen.start_age is not None and chosen.end_age is not None:
        tests.append(f"age BETWEEN {chosen.start_age} AND {chosen.end_age}")
    if chosen.professionals:
        tests.append(f"professional IN ({_in(chosen.professionals)})")
    if chosen.cities:
        tests.append(f"city IN ({_in(chosen.cities)})")
    if chosen.sex:
        tests.append(f"sex = '{chosen.sex}'")
    if chosen.keywords:
        tests.append(f"list_has_any(keyword_list, [{_in(chosen.keywords)}])")
    if chosen.category_ids:
        tests.append(f"list_has_any(category_list, [{_in(chosen.category_ids)}])")
    return " AND ".join(tests) or "TRUE"


# Names and inclusive bounds of the buckets, written out once more for the check.
_BUCKETS = [
    ("visit_length", "visit_length_1s_3s", 1, 3),
    ("visit_length", "visit_length_4s_6s", 4, 6),
    ("visit_length", "visit_length_7s_9s", 7, 9),
    ("visit_length", "visit_length_10s_30s", 10, 30),
    ("visit_length", "visit_length_30s_60s", 31, 60),
    ("visit_length", "visit_length_1m_3m", 61, 180),
    ("visit_length", "visit_length_3m_10m", 181, 600),
    ("visit_length", "visit_length_10m_30m", 601, 1800),
    ("visit_length", "visit_length_30m", 1801, None),
    ("step_length", "step_length_1_3", 1, 3),
    ("step_length", "step_length_4_6", 4, 6),
    ("step_length", "step_length_7_9", 7, 9),
    ("step_length", "step_length_10_30", 10, 30),
    ("step_length", "step_length_30_60", 31, 60),
    ("step_length", "step_length_60", 61, None),
]


def _bucket_counts(chosen) -> str:
    counts = ",\n".join(
        f"count(*) FILTER ({length} >= {low}{'' if high is None else f' AND {length} <= {high}'}) AS {name}"
        for length, name, low, high in _BUCKETS
    )
    return f"SELECT count(*) AS session_count,\n{counts}\nFROM user_profile WHERE {_conditions(chosen)}"


def _half_up(n: str, d: str) -> str:
    return f"CAST((200 * {n} + {d}) // (2 * {d}) AS DOUBLE) / CAST(100 AS DOUBLE)"


def _sessions(tail: str, *more: str) -> str:
    return "WITH " + ",".join([_ACTIONS, _PROFILE, _USERS, _USER_PROFILE, *more]) + "\n" + tail


_HOURS = f"""
hour_counts AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, CAST(hour(start_time) AS INTEGER) AS hour,
         count(*) AS session_count
  FROM user_profile GROUP BY ALL
),
days AS (
  SELECT date, CAST(sum(session_count) AS BIGINT) AS n FROM hour_counts GROUP BY date
),
level AS (
  -- the most that every day can give, as far as it has so many, within the sample size
  SELECT max(l) AS l FROM range(0, {P.SAMPLE_SIZE} + 1) r(l)
  WHERE (SELECT sum(least(n, l)) FROM days) <= {P.SAMPLE_SIZE}
),
day_quotas AS (
  SELECT date, n, least(n, l) + CASE WHEN n > l AND row_number() OVER (ORDER BY n > l DESC, n DESC, date)
           <= {P.SAMPLE_SIZE} - sum(least(n, l)) OVER () THEN 1 ELSE 0 END AS day_quota
  FROM days, level
),
parts AS (
  SELECT h.*, n AS day_count, day_quota, session_count * day_quota // n AS share,
         row_number() OVER (PARTITION BY date ORDER BY session_count * day_quota % n DESC, hour) AS place
  FROM hour_counts h JOIN day_quotas USING (date)
),
quotas AS (
  SELECT date, hour, session_count, day_count,
         CAST(share + CASE WHEN place <= day_quota - sum(share) OVER (PARTITION BY date) THEN 1 ELSE 0 END AS BIGINT) AS quota
  FROM parts
)"""

_SAMPLE = f"""
sampled AS (
  SELECT s.* FROM (
    SELECT *, strftime(start_time, '%Y-%m-%d') AS date, CAST(hour(start_time) AS INTEGER) AS hour,
           row_number() OVER (PARTITION BY strftime(start_time, '%Y-%m-%d'), hour(start_time)
                              ORDER BY md5('{P.SAMPLE_SEED}' || session_id), session_id) AS draw
    FROM user_profile) s
  JOIN quotas q ON s.date = q.date AND s.hour = q.hour AND s.draw <= q.quota
)"""

_DETAIL = f"""SELECT '{P.TASK_ID}' AS task_id, user_id, session_id, page_id, {_time('action_time')} AS action_time,
  search_keyword, click_category_id, click_product_id, order_category_ids, order_product_ids,
  pay_category_ids, pay_product_ids FROM actions"""

_CATEGORIES = """
items AS (
  SELECT 'click' AS kind, click_category_id AS category_id FROM actions WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM actions
  WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM actions
  WHERE pay_category_ids IS NOT NULL
),
category_counts AS (
  SELECT category_id, count(*) FILTER (kind = 'click') AS click_count,
         count(*) FILTER (kind = 'order') AS order_count, count(*) FILTER (kind = 'pay') AS pay_count
  FROM items GROUP BY category_id
),
top_categories AS (
  SELECT * FROM category_counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
)"""

_TOP_SESSIONS = """
session_counts AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM actions WHERE click_category_id IS NOT NULL GROUP BY ALL
),
top_sessions AS (
  SELECT category_id, session_id, click_count FROM session_counts
  WHERE category_id IN (SELECT category_id FROM top_categories)
  QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10
)"""

_STEPS = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(D.PAGE_FLOW, D.PAGE_FLOW[1:]), start=1))

_PAGES = f"""
moves AS (
  SELECT page_id AS a, lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS b FROM actions
),
steps AS (
  SELECT CAST(s.step AS INTEGER) AS step, CAST(s.a AS BIGINT) AS from_page, CAST(s.b AS BIGINT) AS to_page,
         (SELECT count(*) FROM moves m WHERE m.a = s.a AND m.b = s.b) AS pair_count
  FROM (VALUES {_STEPS}) s(step, a, b)
),
bases AS (
  SELECT *, coalesce(lag(pair_count) OVER (ORDER BY step),
                     (SELECT count(*) FROM actions WHERE page_id = {D.PAGE_FLOW[0]})) AS base_count FROM steps
),
rates AS (
  SELECT step, from_page, to_page, pair_count, base_count,
         CASE WHEN base_count > 0 THEN {_half_up('pair_count', 'base_count')} END AS convert_rate FROM bases
)"""

_CITIES = """
cities AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_AREAS = """
clicked AS (
  SELECT a.city_id, c.city_name, c.area, a.click_product_id AS product_id, a.date
  FROM actions a JOIN cities c ON a.city_id = c.city_id WHERE a.click_product_id IS NOT NULL
),
area_counts AS (
  SELECT area, product_id, count(*) AS click_count,
         string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ','
                    ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos
  FROM clicked GROUP BY area, product_id
),
area_full AS (
  SELECT area, product_id, click_count, city_infos, p_name AS product_name,
         CASE WHEN p_partkey % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status
  FROM area_counts JOIN part ON product_id = p_partkey
)"""

_LEVELS = " ".join(f"WHEN area IN ({_in(areas)}) THEN '{level}'" for level, areas in D.AREA_LEVELS.items())

_CLICKS = f"""
clicks AS (
  SELECT ts, strftime(ts, '%Y-%m-%d') AS date, CAST(user_id % 5 AS VARCHAR) AS province,
         CAST(user_id % 25 AS VARCHAR) AS city, user_id AS userid, {_K} % 10 AS adid
  FROM events WHERE event_type = 'click'
),
daily AS (
  SELECT date, userid, adid, count(*) AS click_count FROM clicks GROUP BY ALL
),
blacklist AS (
  SELECT DISTINCT userid FROM daily WHERE click_count >= {D.BLACKLIST_THRESHOLD}
),
kept AS (
  SELECT * FROM clicks WHERE userid NOT IN (SELECT userid FROM blacklist)
),
stat AS (
  SELECT date, province, city, adid, count(*) AS click_count FROM kept GROUP BY ALL
),
top3 AS (
  SELECT date, province, adid, click_count FROM (
    SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count FROM stat GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) <= 3
),
trend AS (
  SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid, count(*) AS click_count
  FROM clicks GROUP BY ALL
)"""

# The ad streams come in parts of the month; a click counts unless its user was listed from an
# earlier part, that is, had reached the threshold on a day by the end of that part.
_FEEDBACK = f"""
parts AS (
  SELECT *, least((day(ts) - 1) // 10, 2) AS part FROM clicks
),
so_far AS (
  SELECT p.part, d.userid FROM (SELECT DISTINCT part FROM parts) p
  JOIN (SELECT part, date, userid, adid, count(*) AS n FROM parts GROUP BY ALL) d ON d.part < p.part
  GROUP BY p.part, d.date, d.userid, d.adid HAVING sum(d.n) >= {D.BLACKLIST_THRESHOLD}
),
let_through AS (
  SELECT * FROM parts c WHERE NOT EXISTS (SELECT 1 FROM so_far s WHERE s.part = c.part AND s.userid = c.userid)
),
fed_stat AS (
  SELECT date, province, city, adid, count(*) AS click_count FROM let_through GROUP BY ALL
)"""

_LOG_COLUMNS = f"{_time('ts')} AS ts, province, city, userid, adid"

_SERIES = f"""
of_hour AS (
  SELECT adid, CAST(minute AS INTEGER) AS minute, click_count FROM trend
  WHERE date = '{D.SERIES_DATE}' AND hour = '{D.SERIES_HOUR:02d}'
),
dense AS (
  SELECT a.adid, CAST(m.minute AS INTEGER) AS minute, coalesce(o.click_count, 0) AS click_count
  FROM (SELECT DISTINCT adid FROM of_hour) a CROSS JOIN range(0, 60) m(minute)
  LEFT JOIN of_hour o ON o.adid = a.adid AND o.minute = m.minute
)"""

_RECENT = """SELECT date, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute, adid,
  count(*) AS click_count FROM clicks
WHERE date_trunc('minute', ts) > (SELECT date_trunc('minute', max(ts)) FROM clicks) - INTERVAL 1 HOUR GROUP BY ALL"""

# Every click in each of the twelve windows that it lies in.
_SLIDING = """SELECT strftime(make_timestamp(CAST((epoch_us(ts) // 5000000 + w.k) * 5000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS window_end,
  adid, count(*) AS click_count FROM clicks, range(1, 13) w(k) GROUP BY ALL"""

_REJECTS = """SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) || ' ' || CAST(user_id % 5 AS VARCHAR) AS value
FROM events WHERE event_type = 'error'"""

# The day is cut in two for the sink queries: morning clicks come first, later ones second.
_HALVES = """
halves AS (
  SELECT *, CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END AS half FROM clicks
),
half_stat AS (
  SELECT half, date, province, city, adid, count(*) AS click_count FROM halves GROUP BY ALL
),
half_top AS (
  SELECT half, date, province, adid, click_count FROM (
    SELECT half, date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count
    FROM half_stat GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY half, date, province ORDER BY click_count DESC, adid) <= 3
)"""


def _with(*parts: str, tail: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + tail


def oracle_queries() -> dict[str, str]:
    stat = _with(_CLICKS, tail="SELECT date, province, city, adid, click_count FROM stat")
    blacklist = _with(_CLICKS, tail="SELECT userid FROM blacklist")
    daily = _with(_CLICKS, tail="SELECT date, userid, adid, click_count FROM daily")
    top3 = _with(_CLICKS, tail="SELECT date, province, adid, click_count FROM top3")
    profile = _with(_ACTIONS, _PROFILE, tail=f"SELECT {_PROFILE_COLUMNS} FROM profile")
    sample_detail = _sessions(f"{_DETAIL} WHERE session_id IN (SELECT session_id FROM sampled)", _HOURS, _SAMPLE)
    trend = _with(_CLICKS, tail="SELECT date, hour, minute, adid, click_count FROM trend")
    ratios = ",\n".join(
        f"{_half_up(name, 'greatest(session_count, 1)')} AS {name}_ratio" for _, name, _, _ in _BUCKETS
    )
    task = f"'{P.TASK_ID}' AS task_id"
    return {
        "action_clean": _with(
            _ACTIONS,
            tail=f"""SELECT date, user_id, session_id, page_id, {_time('action_time')} AS action_time,
  '词 ' || search_keyword AS search_keyword, click_category_id, click_product_id, order_category_ids,
  order_product_ids, pay_category_ids, pay_product_ids, city_id, event_id
FROM actions WHERE date BETWEEN '{D.START_DATE}' AND '{D.END_DATE}'""",
        ),
        "session_profile": profile,
        "bucketed_session_profile": profile,
        "session_items": _with(
            _ACTIONS,
            tail="""SELECT DISTINCT session_id, 'keyword' AS kind, search_keyword AS value FROM actions WHERE search_keyword IS NOT NULL
UNION ALL
SELECT DISTINCT session_id, 'category', CAST(click_category_id AS VARCHAR) FROM actions WHERE click_category_id IS NOT NULL""",
        ),
        "session_user_profile": _sessions(
            f"SELECT {_PROFILE_COLUMNS}, age, professional, sex, city FROM user_profile"
        ),
        "session_filtered": _sessions(
            f"SELECT {_PROFILE_COLUMNS}, age, professional, sex, city FROM user_profile "
            f"WHERE {_conditions(P.FULL_FILTER)}"
        ),
        "session_bucket_counts": _sessions(_bucket_counts(P.FULL_FILTER)),
        "session_ratio_stat": _sessions(
            f"SELECT {task}, greatest(session_count, 1) AS session_count,\n{ratios}\n"
            f"FROM ({_bucket_counts(P.AGE_FILTER)})"
        ),
        "session_hour_counts": _sessions("SELECT * FROM quotas", _HOURS),
        "session_sample": _sessions(
            f"""SELECT {task}, session_id, {_time('start_time')} AS start_time, search_keywords,
  array_to_string(category_list, ',') AS click_category_ids FROM sampled""",
            _HOURS,
            _SAMPLE,
        ),
        "session_sample_detail": sample_detail,
        "bucketed_sample_detail": sample_detail,
        "category_counts": _with(_ACTIONS, _CATEGORIES, tail="SELECT * FROM category_counts"),
        "category_top10": _with(_ACTIONS, _CATEGORIES, tail=f"SELECT {task}, * FROM top_categories"),
        "category_session_counts": _with(
            _ACTIONS, _CATEGORIES, _TOP_SESSIONS, tail="SELECT * FROM session_counts"
        ),
        "category_top_sessions": _with(
            _ACTIONS, _CATEGORIES, _TOP_SESSIONS, tail=f"SELECT {task}, * FROM top_sessions"
        ),
        "top_session_detail": _with(
            _ACTIONS,
            _CATEGORIES,
            _TOP_SESSIONS,
            tail=f"{_DETAIL} WHERE session_id IN (SELECT session_id FROM top_sessions)",
        ),
        "page_transition_counts": _with(
            _ACTIONS, _PAGES, tail="SELECT step, from_page, to_page, pair_count FROM steps"
        ),
        "page_start_pv": _with(
            _ACTIONS,
            tail=f"""SELECT CAST({D.PAGE_FLOW[0]} AS BIGINT) AS page_id, count(*) AS start_pv
FROM actions WHERE page_id = {D.PAGE_FLOW[0]}""",
        ),
        "page_convert_rate": _with(_ACTIONS, _PAGES, tail="SELECT * FROM rates"),
        "page_convert_rate_text": _with(
            _ACTIONS,
            _PAGES,
            tail=f"""SELECT {task}, string_agg(CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) || '='
  || coalesce(CAST(convert_rate AS VARCHAR), ''), '|' ORDER BY step) AS convert_rate FROM rates""",
        ),
        "area_clicks": _with(
            _ACTIONS,
            _CITIES,
            _AREAS,
            tail=f"""SELECT city_id, city_name, area, product_id FROM clicked
WHERE date BETWEEN '{D.START_DATE}' AND '{D.END_DATE}'""",
        ),
        "area_product_counts": _with(_ACTIONS, _CITIES, _AREAS, tail="SELECT * FROM area_counts"),
        "area_product_full": _with(_ACTIONS, _CITIES, _AREAS, tail="SELECT * FROM area_full"),
        "area_top3_product": _with(
            _ACTIONS,
            _CITIES,
            _AREAS,
            tail=f"""SELECT {task}, area, CASE {_LEVELS} ELSE 'D Level' END AS area_level, product_id,
  city_infos, click_count, product_name, product_status FROM area_full
QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3""",
        ),
        "ad_log_parse": _with(_CLICKS, tail=f"SELECT {_LOG_COLUMNS} FROM clicks"),
        "ad_log_rejects": _REJECTS,
        "stream_ad_rejects": _REJECTS,
        "ad_sliding_trend": _with(_CLICKS, tail=_SLIDING),
        "stream_ad_sliding_trend": _with(_CLICKS, tail=_SLIDING),
        "stream_running_ad_stat": stat,
        "stream_running_click_trend": trend,
        "ad_user_daily_counts": daily,
        "ad_blacklist": blacklist,
        "ad_filtered_log": _with(_CLICKS, tail=f"SELECT {_LOG_COLUMNS} FROM kept"),
        "ad_stat": stat,
        "ad_province_top3": top3,
        "ad_click_trend": trend,
        "ad_click_trend_recent": _with(
            _CLICKS,
            tail=_RECENT,
        ),
        "stream_ad_click_trend_recent": _with(_CLICKS, tail=_RECENT),
        "ad_trend_series": _with(
            _CLICKS,
            _SERIES,
            tail="""SELECT adid, minute, click_count, max(click_count) OVER (PARTITION BY adid) AS max_count,
  min(click_count) OVER (PARTITION BY adid) AS min_count,
  CAST(sum(click_count) OVER (PARTITION BY adid) AS DOUBLE) / CAST(60 AS DOUBLE) AS avg_count FROM dense""",
        ),
        "stream_ad_stat": stat,
        "stream_ad_blacklist": blacklist,
        "stream_ad_filtered_log": _with(_CLICKS, _FEEDBACK, tail=f"SELECT {_LOG_COLUMNS} FROM let_through"),
        "stream_all_ad_stat": _with(_CLICKS, _FEEDBACK, tail="SELECT * FROM fed_stat"),
        "stream_all_ad_province_top3": _with(
            _CLICKS,
            _FEEDBACK,
            tail="""SELECT date, province, adid, click_count FROM (
  SELECT date, province, adid, CAST(sum(click_count) AS BIGINT) AS click_count FROM fed_stat GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, adid) <= 3""",
        ),
        "stream_all_ad_blacklist": blacklist,
        "stream_ad_province_top3": top3,
        "stream_ad_click_trend": trend,
        "stream_ad_user_daily_counts": daily,
        "sink_append": _with(
            _CLICKS,
            tail=f"""SELECT date, province, city, adid, click_count, '{P.TASK_ID}' AS task_id FROM stat
UNION ALL
SELECT date, province, city, adid, click_count, '{P.OTHER_TASK_ID}' AS task_id FROM (
  SELECT date, province, city, adid, count(*) AS click_count FROM clicks GROUP BY ALL)""",
        ),
        "sink_upsert_add": daily,
        "sink_upsert_overwrite": _with(
            _CLICKS,
            _HALVES,
            tail="""SELECT date, province, city, adid, click_count FROM half_stat
QUALIFY row_number() OVER (PARTITION BY date, province, city, adid ORDER BY half DESC) = 1""",
        ),
        "sink_insert_ignore": _with(_CLICKS, tail="SELECT DISTINCT userid FROM clicks"),
        "sink_replace_slice": _with(
            _CLICKS,
            _HALVES,
            tail="""SELECT date, province, adid, click_count FROM half_top
QUALIFY half = max(half) OVER (PARTITION BY date, province)""",
        ),
    }
