"""The same results in ANSI SQL, for the check against DuckDB.

Each statement is written on its own from the definition of the result; it shares the fixtures and
parameters with `queries.py`, none of its steps.
"""

from __future__ import annotations

# Views of the given tables.
_ACTIONS = """
e AS (SELECT event_id, ts, user_id, event_type,
             CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
all_actions AS (
  SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, user_id,
    concat(user_id, '_', CAST(ts AS DATE)) AS session_id, k % 10 AS page_id,
    CAST(ts AS DATE) + ((user_id % 24) * 3600 + (event_id * 37 + k)
      % ([4,10,31,61,181,601,1801,3540][user_id % 8 + 1])) * INTERVAL 1 SECOND AS action_time,
    CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword,
    CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_category_id,
    CASE WHEN event_type = 'click' THEN event_id * 7 % 100 ELSE -1 END AS click_product_id,
    CASE WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0
      THEN concat(k, ',', (k * 3 + 1) % 100) ELSE CAST(k AS VARCHAR) END END
      AS order_category_ids,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id * 7 % 100 AS VARCHAR) END
      AS order_product_ids,
    CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
    CASE WHEN event_type = 'signup' THEN CAST(event_id * 7 % 100 AS VARCHAR) END
      AS pay_product_ids,
    event_id % 10 AS city_id
  FROM e),
actions AS (SELECT * FROM all_actions WHERE date BETWEEN '2024-01-05' AND '2024-01-25')"""

_USERS = """
users AS (
  SELECT c_custkey + 3 AS user_id, concat('user', c_custkey) AS username, c_name AS name,
    CAST(c_custkey % 60 AS INTEGER) AS age,
    concat('professional', c_custkey * 7 % 100) AS professional,
    concat('city', c_nationkey) AS city,
    CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer)"""

_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
    concat('{"product_status": ', p_size % 2, '}') AS extend_info
  FROM part)"""

_CITIES = """
cities(city_id, city_name, area) AS (VALUES
  (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
  (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
  (8, '成都', '西南'), (9, '哈尔滨', '东北'))"""

_AD_CLICKS = """
clicks AS (
  SELECT event_id, ts, event_type, CAST(user_id % 10 AS VARCHAR) AS province,
    CAST(user_id % 20 AS VARCHAR) AS city, user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS ad_id
  FROM events)"""

# Intermediate results.
_SESSIONS = """
sessions AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS started,
    date_diff('second', min(action_time), max(action_time)) AS visit_length,
    count(*) AS step_length,
    list_sort(list(DISTINCT search_keyword) FILTER (search_keyword IS NOT NULL)) AS kws,
    list_sort(list(DISTINCT click_category_id) FILTER (click_category_id <> -1)) AS cats
  FROM actions GROUP BY session_id),
info AS (
  SELECT session_id, user_id, strftime(started, '%Y-%m-%d %H:%M:%S') AS start_time, started,
    visit_length, step_length, array_to_string(kws, ',') AS keywords,
    array_to_string(cats, ',') AS categories, kws, cats, age, professional, city, sex
  FROM sessions JOIN users USING (user_id)),
matching AS (SELECT * FROM info WHERE age BETWEEN 20 AND 50)"""

_ITEMS = """
items AS (
  SELECT session_id, click_category_id AS category_id, 'click' AS kind FROM actions
  WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT), 'order'
  FROM actions WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT), 'pay'
  FROM actions WHERE pay_category_ids IS NOT NULL)"""

_CATEGORY = """
session_counts AS (
  SELECT category_id, session_id, count(*) FILTER (kind = 'click') AS click_count,
    count(*) FILTER (kind = 'order') AS order_count, count(*) FILTER (kind = 'pay') AS pay_count
  FROM items WHERE session_id IN (SELECT session_id FROM matching)
  GROUP BY category_id, session_id),
counts AS (
  SELECT category_id, CAST(sum(click_count) AS BIGINT) AS click_count,
    CAST(sum(order_count) AS BIGINT) AS order_count, CAST(sum(pay_count) AS BIGINT) AS pay_count
  FROM session_counts GROUP BY category_id),
top_categories AS (
  SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id
  LIMIT 10)"""

_AREA = """
area_clicks AS (
  SELECT area, click_product_id AS pid, count(*) AS click_count,
    string_agg(DISTINCT concat(city_id, ':', city_name), ',' ORDER BY concat(city_id, ':', city_name))
      AS city_infos
  FROM actions JOIN cities USING (city_id) WHERE click_product_id <> -1 GROUP BY area, pid),
area_products AS (
  SELECT area, city_infos, pid, product_name,
    CASE WHEN json_extract_string(extend_info, '$.product_status') = '0' THEN 'Self'
      ELSE 'Third Party' END AS product_status, click_count
  FROM area_clicks JOIN products ON pid = product_id)"""

_AREA_LEVEL = """CASE WHEN area IN ('华北', '华东') THEN 'A_Level'
  WHEN area IN ('华中', '华南') THEN 'B_Level'
  WHEN area IN ('西南', '西北') THEN 'C_Level' ELSE 'D_Level' END"""

_REGIONAL_TOP3 = f"""SELECT area, {_AREA_LEVEL} AS area_level, pid, city_infos, click_count,
  product_name, product_status FROM (SELECT *, row_number() OVER (
    PARTITION BY area ORDER BY click_count DESC, pid) AS place FROM area_products)
WHERE place <= 3"""

_SAMPLE = """
hours AS (SELECT CAST(started AS DATE) AS d, CAST(hour(started) AS INTEGER) AS hour,
            count(*) AS session_count FROM matching GROUP BY ALL),
day_counts AS (SELECT d, CAST(sum(session_count) AS BIGINT) AS day_count FROM hours GROUP BY d),
quota AS (
  SELECT d, hour, session_count, day_count, day_quota,
    least(CAST(floor(session_count / CAST(day_count AS DOUBLE) * day_quota) AS BIGINT),
          session_count) AS hour_quota
  FROM hours JOIN day_counts USING (d),
    (SELECT CAST(840 // nullif(count(*), 0) AS BIGINT) AS day_quota FROM day_counts)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY CAST(started AS DATE), hour(started)
                               ORDER BY md5(concat('0', session_id)), session_id) AS place
  FROM matching),
sample AS (SELECT ordered.* FROM ordered JOIN quota
           ON CAST(started AS DATE) = d AND hour(started) = hour AND place <= hour_quota)"""

_TRANSITIONS = """
transitions AS (
  SELECT session_id, page_id, lead(page_id) OVER (PARTITION BY session_id
    ORDER BY action_time, event_id) AS next_page_id FROM actions),
steps AS (SELECT i AS step_no, i AS a, i + 1 AS b FROM range(1, 7) r(i)),
made AS (SELECT step_no, concat(a, '_', b) AS step, (SELECT count(*) FROM transitions
           WHERE page_id = a AND next_page_id = b) AS transitions FROM steps),
funnel AS (SELECT step_no, step, transitions, coalesce(lag(transitions) OVER (ORDER BY step_no),
             (SELECT count(*) FROM actions WHERE page_id = 1)) AS base FROM made)"""

_AD_COUNTS = """
user_clicks AS (SELECT strftime(ts, '%Y%m%d') AS date, user_id, ad_id, count(*) AS click_count
                FROM clicks GROUP BY ALL),
city_clicks AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id,
                  count(*) AS click_count FROM clicks GROUP BY ALL),
province_clicks AS (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
                    FROM city_clicks GROUP BY ALL),
province_ranks AS (
  SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id)
    AS place FROM province_clicks)"""

# The log arrives in three parts; a user over the threshold is listed from the next part on.
_STREAM_CLICKS = """
all_clicks AS (
  SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2
    ELSE 3 END AS part
  FROM (SELECT event_id, ts, CAST(user_id % 10 AS VARCHAR) AS province,
          CAST(user_id % 20 AS VARCHAR) AS city, user_id,
          CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS ad_id
        FROM events WHERE event_type <> 'error')),
listed AS (
  SELECT user_id, min(part) AS listed_in FROM (
    SELECT user_id, part FROM all_clicks GROUP BY user_id, ad_id, CAST(ts AS DATE), part
    HAVING count(*) > 2) GROUP BY user_id),
clicks AS (SELECT all_clicks.* FROM all_clicks LEFT JOIN listed USING (user_id)
           WHERE listed_in IS NULL OR part <= listed_in)"""

_VISIT_BANDS = (("1s_3s", "BETWEEN 1 AND 3"), ("4s_6s", "BETWEEN 4 AND 6"),
                ("7s_9s", "BETWEEN 7 AND 9"), ("10s_30s", "BETWEEN 10 AND 30"),
                ("30s_60s", "BETWEEN 31 AND 60"), ("1m_3m", "BETWEEN 61 AND 180"),
                ("3m_10m", "BETWEEN 181 AND 600"), ("10m_30m", "BETWEEN 601 AND 1800"),
                ("30m", "> 1800"))
_STEP_BANDS = (("1_3", "BETWEEN 1 AND 3"), ("4_6", "BETWEEN 4 AND 6"), ("7_9", "BETWEEN 7 AND 9"),
               ("10_30", "BETWEEN 10 AND 30"), ("30_60", "BETWEEN 31 AND 60"), ("60", "> 60"))

_BANDS = [(f"{column}_{name}", f"{column} {test}")
          for column, bands in (("visit_length", _VISIT_BANDS), ("step_length", _STEP_BANDS))
          for name, test in bands]
_BAND_COUNTS = "band_counts AS (SELECT count(*) AS session_count, " + ", ".join(
    f"count(*) FILTER ({test}) AS {name}" for name, test in _BANDS) + " FROM matching)"
# Rounded half up to two places with whole numbers.
_RATIOS = ", ".join(
    f"coalesce((200 * {name} + session_count) // nullif(2 * session_count, 0), 0) / 100.0 "
    f"AS {name}_ratio"
    for name, _ in _BANDS)

_INFO = ("session_id, user_id, start_time, visit_length, step_length, keywords, categories, "
         "age, professional, city, sex")
_MATCH = "session_id, user_id, start_time, visit_length, step_length, age, professional, city, sex"
_ACTION = """event_id, date, user_id, session_id, page_id,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword, click_category_id,
  click_product_id, order_category_ids, order_product_ids, pay_category_ids, pay_product_ids,
  city_id"""
_EPOCH_MS = "epoch_us(ts) // 1000"


def _sql(select: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select if ctes else select


def _cases(column: str, bands: tuple) -> str:
    tests = " ".join(f"WHEN {column} {test} THEN '{name}'" for name, test in bands)
    return f"CASE {tests} END"


def _sessions(condition: str, columns: str = _INFO) -> str:
    return _sql(f"SELECT {columns} FROM info WHERE {condition}", _ACTIONS, _USERS, _SESSIONS)


def _matching(select: str, *ctes: str) -> str:
    return _sql(select, _ACTIONS, _USERS, _SESSIONS, *ctes)


def _categories(select: str) -> str:
    return _matching(select, _ITEMS, _CATEGORY)


def _areas(select: str) -> str:
    return _sql(select, _ACTIONS, _PRODUCTS, _CITIES, _AREA)


def _ads(select: str) -> str:
    return _sql(select, _AD_CLICKS, _AD_COUNTS)


def _stream(select: str) -> str:
    return _sql(select, _STREAM_CLICKS, _AD_COUNTS)


_TREND = """SELECT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour,
  strftime(ts, '%M') AS minute, ad_id, count(*) AS click_count FROM clicks"""
_TOP3 = "SELECT date, province, ad_id, click_count FROM province_ranks WHERE place <= 3"
_TOP10 = "SELECT category_id, click_count, order_count, pay_count FROM top_categories"
_LINE = f"concat_ws(' ', {_EPOCH_MS}, province, city, user_id)"


def oracle_sql() -> dict[str, str]:
    return {
        "actions_in_range": _sql(f"SELECT {_ACTION} FROM actions", _ACTIONS),
        "clicked_products": _sql("""SELECT city_id, click_product_id FROM actions
            WHERE click_product_id <> -1""", _ACTIONS),
        "user_dimension": _sql("SELECT * FROM users", _USERS),
        "product_dimension": _sql("SELECT * FROM products", _PRODUCTS),
        "action_items": _sql("SELECT * FROM items", _ACTIONS, _ITEMS),
        "fn_dates": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS parsed,
            strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d_%H') AS date_hour,
            strftime(ts, '%Y%m%d') AS day_key, strftime(ts, '%Y%m%d%H%M') AS minute_key,
            strftime(ts, '%Y-%m-%d') AS day_again,
            ts < CAST(ts AS DATE) + INTERVAL 12 HOUR AS before_noon,
            ts > CAST(ts AS DATE) + INTERVAL 12 HOUR AS after_noon,
            CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS second_of_day,
            10 AS today_length, 1 AS days_since_yesterday FROM events""",
        "fn_text": _sql("""SELECT event_id,
            array_to_string(list_sort(list_transform(string_split(order_category_ids, ','),
              lambda x: CAST(x AS BIGINT))), ',') AS order_ids,
            search_keyword AS trimmed, search_keyword IS NULL AS no_keyword,
            search_keyword IS NOT NULL AS has_keyword,
            CASE WHEN hour(action_time) < 10 THEN concat('0', hour(action_time))
              ELSE CAST(hour(action_time) AS VARCHAR) END AS padded_hour,
            concat(city_id, ':', date) AS city_date, search_keyword AS field_kw,
            CAST(hour(action_time) AS VARCHAR) AS field_hour,
            concat('sessionid=', session_id, '|kw=', coalesce(search_keyword, ''), '|hour=',
              strftime(action_time, '%H')) AS record_set FROM all_actions""", _ACTIONS),
        "fn_numbers": _sql("""SELECT event_id, ((200 * ad_id + user_id + 20)
            // (2 * (user_id + 20))) / 100.0 AS share FROM clicks""", _AD_CLICKS),
        "session_bands": _matching(f"""SELECT session_id,
            {_cases("visit_length", _VISIT_BANDS)} AS visit_band,
            {_cases("step_length", _STEP_BANDS)} AS step_band FROM info"""),
        "product_labels": """SELECT p_partkey AS product_id, CAST(p_size % 2 AS VARCHAR) AS status,
            CASE WHEN p_size % 2 = 0 THEN 'Self' ELSE 'Third Party' END AS product_status
            FROM part""",
        "area_levels": _sql(f"""SELECT area, {_AREA_LEVEL} AS area_level,
            count(*) AS click_count,
            string_agg(DISTINCT city_name, ',' ORDER BY city_name) AS city_names
            FROM actions JOIN cities USING (city_id) WHERE click_product_id <> -1
            GROUP BY area""", _ACTIONS, _CITIES),
        "click_cities": _areas("""SELECT city_id, city_name, area, click_product_id AS pid
            FROM actions JOIN cities USING (city_id) WHERE click_product_id <> -1"""),
        "area_product_clicks": _areas("SELECT * FROM area_clicks"),
        "area_product_info": _areas("SELECT * FROM area_products"),
        "regional_top3": _areas(_REGIONAL_TOP3),
        "regional_top3_sql": _areas(_REGIONAL_TOP3),
        "session_aggregate": _matching("""SELECT session_id, user_id,
            strftime(started, '%Y-%m-%d %H:%M:%S') AS start_time, visit_length, step_length,
            array_to_string(kws, ',') AS keywords, array_to_string(cats, ',') AS categories
            FROM sessions"""),
        "session_full_info": _sessions("true"),
        "sessions_by_age": _sessions("age BETWEEN 20 AND 50"),
        "sessions_by_professional": _sessions("""professional IN
            ('professional0', 'professional7', 'professional42', 'professional63')"""),
        "sessions_by_city": _sessions("city IN ('city3', 'city11', 'city20')"),
        "sessions_by_sex": _sessions("sex = 'male'"),
        "sessions_by_keyword": _sessions("list_has_any(kws, ['kw3', 'kw7'])"),
        "sessions_by_category": _sessions("list_has_any(cats, [5, 17, 44, 71])"),
        "sessions_one_age_bound": _sessions("true"),
        "session_filtered": _sessions("age BETWEEN 20 AND 50", _MATCH),
        "session_filtered_all": _sessions("""age BETWEEN 20 AND 50 AND sex = 'male'
            AND list_has_any(kws, ['kw3', 'kw7']) AND list_has_any(cats, range(0, 50))""", _MATCH),
        "session_band_counts": _matching("SELECT * FROM band_counts", _BAND_COUNTS),
        "session_ratios": _matching(f"SELECT session_count, {_RATIOS} FROM band_counts",
                                    _BAND_COUNTS),
        "filtered_actions": _matching(f"""SELECT {_ACTION} FROM actions
            WHERE session_id IN (SELECT session_id FROM matching)"""),
        "category_domain": _sql("SELECT DISTINCT category_id FROM items", _ACTIONS, _ITEMS),
        "category_counts": _categories("SELECT * FROM counts"),
        "top10_categories": _categories(_TOP10),
        "category_session_counts": _categories("SELECT * FROM session_counts"),
        "top10_sessions": _categories("""SELECT category_id, session_id, click_count FROM (
            SELECT *, row_number() OVER (PARTITION BY category_id
              ORDER BY click_count DESC, session_id) AS place FROM session_counts
            WHERE click_count > 0 AND category_id IN (SELECT category_id FROM top_categories))
            WHERE place <= 10"""),
        "session_hour_counts": _matching("""SELECT CAST(d AS VARCHAR) AS date, hour, session_count
            FROM hours""", _SAMPLE),
        "session_hour_quota": _matching("""SELECT CAST(d AS VARCHAR) AS date, hour, session_count,
            day_count, day_quota, hour_quota FROM quota""", _SAMPLE),
        "session_sample": _matching("""SELECT session_id, start_time, keywords AS search_keywords,
            categories AS click_category_ids FROM sample""", _SAMPLE),
        "session_detail": _matching("""SELECT user_id, session_id, page_id,
            strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword,
            click_category_id, click_product_id, order_category_ids, order_product_ids,
            pay_category_ids, pay_product_ids FROM actions
            WHERE session_id IN (SELECT session_id FROM sample)""", _SAMPLE),
        "page_transitions": _sql("SELECT * FROM transitions", _ACTIONS, _TRANSITIONS),
        "transition_counts": _sql("""SELECT CAST(step_no AS INTEGER) AS step_no, step, transitions,
            base FROM funnel""", _ACTIONS, _TRANSITIONS),
        "page_conversion": _sql("""SELECT CAST(step_no AS INTEGER) AS step_no, step, transitions,
            CAST(transitions AS DOUBLE) / nullif(base, 0) AS rate FROM funnel""",
                                _ACTIONS, _TRANSITIONS),
        "page_conversion_string": _sql("""SELECT string_agg(concat(step, '=', CASE WHEN base <> 0
            THEN printf('%.4f', CAST(transitions AS DOUBLE) / base) END), '|' ORDER BY step_no)
            AS convert_rate FROM funnel""", _ACTIONS, _TRANSITIONS),
        "ad_log_parsed": _sql(f"""SELECT event_id, strftime(ts, '%Y%m%d') AS date,
            strftime(ts, '%Y%m%d%H%M') AS minute, {_EPOCH_MS} AS epoch_ms, province, city,
            user_id, ad_id FROM clicks WHERE event_type <> 'error'""", _AD_CLICKS),
        "ad_log_rejects": _sql(f"""SELECT event_id, {_LINE} AS value FROM clicks
            WHERE event_type = 'error'""", _AD_CLICKS),
        "ad_user_clicks": _ads("SELECT * FROM user_clicks"),
        "ad_blacklist": _ads("SELECT DISTINCT user_id FROM user_clicks WHERE click_count > 2"),
        "ad_clicks_clean": _ads("""SELECT event_id, province, city, user_id, ad_id FROM clicks
            WHERE user_id NOT IN (SELECT user_id FROM user_clicks WHERE click_count > 2)"""),
        "ad_city_clicks": _ads("SELECT * FROM city_clicks"),
        "ad_province_clicks": _ads("SELECT * FROM province_clicks"),
        "ad_province_top3": _ads(_TOP3),
        "ad_minute_trend": _ads(f"{_TREND} GROUP BY ALL"),
        "ad_recent_hour": _ads(f"""{_TREND} WHERE date_trunc('minute', ts) >
            (SELECT date_trunc('minute', max(ts)) - INTERVAL 60 MINUTE FROM clicks) GROUP BY ALL"""),
        "stream_ad_blacklist": _stream("SELECT user_id FROM listed"),
        "stream_ad_user_clicks": _stream("SELECT * FROM user_clicks"),
        "stream_ad_clicks_clean": _stream(f"""SELECT {_EPOCH_MS} AS epoch_ms, province, city,
            user_id, ad_id FROM clicks"""),
        "stream_ad_rejects": _sql(f"SELECT {_LINE} AS value FROM clicks WHERE event_type = 'error'",
                                  _AD_CLICKS),
        "stream_ad_out_of_time": _sql(f"""SELECT {_EPOCH_MS} AS epoch_ms, province, city, user_id,
            ad_id, 'day_closed' AS reason FROM clicks
            WHERE event_type <> 'error' AND ts < TIMESTAMP '2024-01-11 00:00:00'""", _AD_CLICKS),
        "stream_ad_city_clicks": _stream("SELECT * FROM city_clicks"),
        "stream_ad_province_top3": _stream(_TOP3),
        "stream_ad_minute_trend": _stream(f"{_TREND} GROUP BY ALL"),
        "stream_ad_recent_hour": _stream(f"""{_TREND} WHERE date_trunc('minute', ts) >
            (SELECT date_trunc('minute', max(ts)) - INTERVAL 60 MINUTE FROM clicks) GROUP BY ALL"""),
        "sink_append": _categories(f"""SELECT * FROM ({_TOP10}),
            (VALUES ('task-1'), ('task-2')) t(taskid)"""),
        "sink_saved_table": _categories(_TOP10),
        "sink_upsert_latest": _ads("SELECT * FROM user_clicks"),
        "sink_upsert_add": _ads("""SELECT date, user_id, ad_id,
            CASE WHEN date < '20240116' THEN 2 ELSE 1 END * click_count AS click_count
            FROM user_clicks"""),
        "sink_compacted": _ads("SELECT * FROM user_clicks"),
        "sink_replace_groups": _ads("""SELECT date, province, ad_id, click_count
            FROM province_ranks WHERE place <= CASE WHEN date < '20240116' THEN 1 ELSE 3 END"""),
    }
