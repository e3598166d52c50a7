"""The same results in plain SQL, for checking every query against another engine.

The SQL starts from the benchmark tables, never from Spark's output, and follows
the row-by-row definition of each model (explode, pivot, join back) rather than
the plan the operators choose.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def rnd(expression: str, digits: int = 6) -> str:
    """Round half away from zero on the decimal digits of a double."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif({b}, 0)"


def total(x: str) -> str:
    return f"round(sum({x}), 6)"


def mean(x: str, where: str = "true") -> str:
    return f"round(sum({x}) FILTER (WHERE {where}), 6) / nullif(count({x}) FILTER (WHERE {where}), 0)"


def define(name: str, body: str, *parts: str) -> None:
    """Register a query as the CTEs it needs followed by its body."""
    seen: list[str] = []
    for part in parts:
        for cte in NEEDS.get(part, []) + [part]:
            if cte not in seen:
                seen.append(cte)
    ctes = ",\n".join(f"{cte} AS (\n{CTE[cte]}\n)" for cte in seen)
    ORACLE[name] = (f"WITH {ctes}\n" if ctes else "") + body.strip()


CTE: dict[str, str] = {}
NEEDS: dict[str, list[str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    full: list[str] = []
    for n in needs:
        for m in NEEDS.get(n, []) + [n]:
            if m not in full:
                full.append(m)
    CTE[name], NEEDS[name] = body.strip(), full


# --- inputs -----------------------------------------------------------------

cte("src", """
SELECT event_id AS n, ts, user_id, event_type, value,
       CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
       epoch_us(ts) AS micros
FROM events
""")

cte("order_lines", """
SELECT l_orderkey, (l_linenumber - 1) % 7 AS slot, l_partkey AS part, CAST(l_quantity AS BIGINT) AS qty
FROM lineitem
""")

cte("parts", """
SELECT l_orderkey, l_partkey AS part, min((l_linenumber - 1) % 7) AS slot, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM lineitem GROUP BY 1, 2
""")

cte("raw", """
SELECT n, k, value, user_id,
       sha256(CAST(user_id AS VARCHAR) || '|' || CAST(micros AS VARCHAR) || '|' || event_name) AS event_id,
       CAST(ts AS DATE) AS event_date, ts AS event_ts, strftime(ts, '%Y%m%d') AS day_text,
       CAST(user_id AS VARCHAR) AS user_pseudo_id, event_name,
       (['WEB', 'IOS', 'ANDROID'])[k % 3 + 1] AS platform,
       (['Windows', 'Macintosh', 'iOS', 'Android'])[k % 4 + 1] AS operating_system,
       (['Chrome', 'Safari', 'Edge'])[k % 3 + 1] AS browser,
       (['desktop', 'mobile'])[k % 2 + 1] AS device_category,
       (['Apple', 'Google', 'Samsung', 'Huawei', NULL])[k % 5 + 1] AS mobile_brand,
       (['google', '(direct)', 'newsletter', NULL])[k % 4 + 1] AS traffic_source,
       (['organic', 'cpc', '(none)'])[k % 3 + 1] AS traffic_medium,
       (['(organic)', 'spring', 'summer', 'autumn', 'winter', NULL])[k % 6 + 1] AS traffic_campaign,
       k NOT IN (49, 99) AS has_params,
       bucket,
       CAST(floor(user_id / 2) * 1000 + bucket AS BIGINT) AS sid
FROM (
  SELECT *,
         CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart'
              WHEN 'signup' THEN 'begin_checkout'
              WHEN 'error' THEN (['scroll', 'click', 'page_view', 'page_view'])[k % 4 + 1]
              ELSE event_type END AS event_name,
         CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / 3) AS BIGINT) + 1 AS bucket
  FROM src
)
""", "src")

cte("home", """
SELECT c_custkey, c_mktsegment AS city, n_name AS country, 'R' || CAST(n_nationkey AS VARCHAR) AS region,
       r_name AS continent, n_nationkey
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")

cte("ev", """
SELECT raw.*, home.city, home.country, home.region, home.continent
FROM raw LEFT JOIN home ON raw.user_id = home.c_custkey
""", "raw", "home")

cte("params", """
SELECT event_id, event_date, event_ts, user_pseudo_id, event_name, p.key AS param_key,
       p.s AS string_value, p.i AS int_value, p.f AS float_value, p.d AS double_value
FROM (
  SELECT raw.*, unnest([
    CASE WHEN k % 11 <> 0 THEN {'key': 'ga_session_id', 's': CAST(NULL AS VARCHAR), 'i': sid, 'f': CAST(NULL AS DOUBLE), 'd': CAST(NULL AS DOUBLE)} END,
    {'key': 'ga_session_number', 's': NULL, 'i': bucket, 'f': NULL, 'd': NULL},
    CASE WHEN k % 2 = 0 THEN {'key': 'page_location', 's': '/page/' || CAST(k AS VARCHAR), 'i': NULL, 'f': NULL, 'd': NULL} END,
    CASE WHEN k % 3 = 0 THEN {'key': 'page_referrer', 's': '/from/' || CAST(k % 7 AS VARCHAR), 'i': NULL, 'f': NULL, 'd': NULL} END,
    {'key': 'page_title', 's': 'Title ' || CAST(k % 10 AS VARCHAR), 'i': NULL, 'f': NULL, 'd': NULL},
    CASE WHEN event_name = 'purchase' AND k % 7 <> 0 THEN {'key': 'transaction_id', 's': 'T' || CAST(n AS VARCHAR), 'i': NULL, 'f': NULL, 'd': NULL} END,
    CASE WHEN event_name = 'purchase' THEN {'key': 'currency', 's': 'USD', 'i': NULL, 'f': NULL, 'd': NULL} END,
    CASE WHEN event_name = 'purchase' THEN {'key': 'value', 's': NULL,
      'i': CASE WHEN k % 13 = 0 THEN CAST(trunc(value) AS BIGINT) END,
      'f': CASE WHEN k % 13 <> 0 AND k % 5 = 0 THEN value END,
      'd': CASE WHEN k % 13 <> 0 AND k % 5 <> 0 THEN value END} END
  ]) AS p
  FROM raw WHERE has_params
)
WHERE p IS NOT NULL
""", "raw")


def picked(key: str, column: str) -> str:
    return f"max({column}) FILTER (WHERE param_key = '{key}')"


cte("piv", f"""
SELECT event_id, user_pseudo_id, event_name, event_date, event_ts,
       {picked('ga_session_id', 'int_value')} AS ga_session_id,
       {picked('ga_session_number', 'int_value')} AS ga_session_number,
       {picked('page_location', 'string_value')} AS page_location,
       {picked('page_referrer', 'string_value')} AS page_referrer,
       {picked('transaction_id', 'string_value')} AS transaction_id,
       {picked('value', 'coalesce(double_value, float_value)')} AS value,
       {picked('currency', 'string_value')} AS currency
FROM params GROUP BY ALL
""", "params")

cte("wide_piv", f"""
SELECT event_id, event_date, event_ts, user_pseudo_id,
       {picked('ga_session_id', 'int_value')} AS ga_session_id,
       {picked('ga_session_number', 'int_value')} AS ga_session_number,
       {picked('page_location', 'string_value')} AS page_location,
       {picked('page_referrer', 'string_value')} AS page_referrer,
       {picked('transaction_id', 'string_value')} AS transaction_id,
       {picked('page_title', 'string_value')} AS page_title,
       {picked('currency', 'string_value')} AS currency,
       {picked('value', 'double_value')} AS value_param
FROM params GROUP BY ALL
""", "params")

cte("items", """
SELECT event_id, event_date, event_ts, user_pseudo_id, event_name, k,
       CASE WHEN slot <> 6 THEN CAST(part AS VARCHAR) END AS item_id,
       CASE WHEN NOT (slot = 6 AND part % 5 = 0) THEN 'Part ' || CAST(part AS VARCHAR) END AS item_name,
       'Brand#' || CAST(part % 25 AS VARCHAR) AS item_brand,
       'V' || CAST(part % 3 AS VARCHAR) AS item_variant,
       'Category ' || CAST(part % 10 AS VARCHAR) AS item_category,
       'Sub ' || CAST(part % 4 AS VARCHAR) AS item_category2,
       CAST(NULL AS VARCHAR) AS item_category3, CAST(NULL AS VARCHAR) AS item_category4,
       CAST(NULL AS VARCHAR) AS item_category5,
       (90000 + part % 1000 * 10) / 100.0::DOUBLE AS price,
       qty AS quantity,
       CASE WHEN part % 3 <> 0 THEN (90000 + part % 1000 * 10) * qty * 90 / 10000.0::DOUBLE END AS own_revenue
FROM raw JOIN order_lines ON raw.n = l_orderkey
WHERE k % 10 <> 9
""", "raw", "order_lines")

cte("sessions", """
SELECT ev.user_pseudo_id, piv.ga_session_id,
       ev.user_pseudo_id || '-' || CAST(piv.ga_session_id AS VARCHAR) AS session_key,
       ev.event_date AS session_date,
       min(ev.event_ts) AS session_start_ts, max(ev.event_ts) AS session_end_ts,
       date_sub('second', min(ev.event_ts), max(ev.event_ts)) AS session_duration_seconds,
       max(ga_session_number) AS session_number,
       first(operating_system ORDER BY ev.event_ts, ev.event_id) AS operating_system,
       first(browser ORDER BY ev.event_ts, ev.event_id) AS browser,
       first(device_category ORDER BY ev.event_ts, ev.event_id) AS device_category,
       first(platform ORDER BY ev.event_ts, ev.event_id) AS platform,
       first(mobile_brand ORDER BY ev.event_ts, ev.event_id) AS mobile_brand,
       first(continent ORDER BY ev.event_ts, ev.event_id) AS continent,
       first(country ORDER BY ev.event_ts, ev.event_id) AS country,
       first(region ORDER BY ev.event_ts, ev.event_id) AS region,
       first(city ORDER BY ev.event_ts, ev.event_id) AS city,
       first(traffic_source ORDER BY ev.event_ts, ev.event_id) AS traffic_source,
       first(traffic_medium ORDER BY ev.event_ts, ev.event_id) AS traffic_medium,
       first(traffic_campaign ORDER BY ev.event_ts, ev.event_id) AS traffic_campaign,
       first(page_location ORDER BY ev.event_ts, ev.event_id) AS landing_page,
       first(page_location ORDER BY ev.event_ts DESC, ev.event_id DESC) AS exit_page,
       first(page_referrer ORDER BY ev.event_ts, ev.event_id) AS referrer,
       count(*) AS total_events,
       count(*) FILTER (WHERE ev.event_name = 'page_view') AS page_views,
       count(*) FILTER (WHERE ev.event_name = 'scroll') AS scrolls,
       count(*) FILTER (WHERE ev.event_name = 'click') AS clicks,
       count(*) FILTER (WHERE ev.event_name = 'view_item') AS product_views,
       count(*) FILTER (WHERE ev.event_name = 'add_to_cart') AS add_to_carts,
       count(*) FILTER (WHERE ev.event_name = 'begin_checkout') AS checkouts_started,
       count(*) FILTER (WHERE ev.event_name = 'purchase') AS purchases,
       round(sum(CASE WHEN ev.event_name = 'purchase' THEN piv.value ELSE 0 END), 6) AS session_revenue,
       max(currency) AS currency,
       CAST(nullif(count(DISTINCT transaction_id), 0) AS INTEGER) AS transaction_count
FROM ev JOIN piv ON ev.event_id = piv.event_id
WHERE piv.ga_session_id IS NOT NULL
GROUP BY 1, 2, 3, 4
""", "ev", "piv")

cte("flagged", """
SELECT *, purchases > 0 AS is_converted, session_number = 1 AS is_first_session, page_views = 1 AS is_bounce
FROM sessions
""", "sessions")

cte("listed", """
SELECT flagged.*, ids.transaction_ids
FROM flagged LEFT JOIN (
  SELECT ev.user_pseudo_id AS u, piv.ga_session_id AS s, ev.event_date AS d,
         string_agg(DISTINCT transaction_id, ',' ORDER BY transaction_id) AS transaction_ids
  FROM ev JOIN piv ON ev.event_id = piv.event_id
  WHERE piv.ga_session_id IS NOT NULL
  GROUP BY 1, 2, 3) ids
ON user_pseudo_id = u AND ga_session_id = s AND session_date IS NOT DISTINCT FROM d
""", "flagged", "ev", "piv")

cte("lines", """
SELECT coalesce(p.transaction_id, 'MISSING_' || e.event_id) AS transaction_id,
       e.user_pseudo_id, e.event_date, e.event_ts AS purchase_ts,
       p.value AS total_revenue, p.currency,
       coalesce(i.item_id, i.item_name) AS product_key, i.item_id, i.item_name, i.item_brand, i.item_category,
       coalesce(i.quantity, 0) AS quantity, i.price AS unit_price, coalesce(i.price * i.quantity, 0) AS item_revenue,
       p.transaction_id IS NOT NULL AS is_valid_transaction,
       coalesce(i.item_id, i.item_name) IS NOT NULL AS has_items,
       p.transaction_id IS NOT NULL AND coalesce(i.item_id, i.item_name) IS NOT NULL AS is_complete,
       e.event_id, p.ga_session_id
FROM raw e
LEFT JOIN piv p ON p.event_id = e.event_id
LEFT JOIN items i ON i.event_id = e.event_id
WHERE e.event_name = 'purchase'
""", "raw", "piv", "items")

cte("daily", f"""
SELECT session_date, platform, operating_system, browser, device_category,
       count(*) AS total_sessions,
       count(DISTINCT user_pseudo_id) AS unique_users,
       count(*) FILTER (WHERE is_first_session) AS new_user_sessions,
       count(*) FILTER (WHERE NOT is_first_session) AS returning_user_sessions,
       avg(session_duration_seconds) AS avg_session_duration_seconds,
       avg(page_views) AS avg_pages_per_session,
       {big('sum(page_views)')} AS total_page_views,
       count(*) FILTER (WHERE is_bounce) AS bounced_sessions,
       count(*) FILTER (WHERE product_views > 0) AS sessions_with_product_views,
       count(*) FILTER (WHERE add_to_carts > 0) AS sessions_with_add_to_cart,
       count(*) FILTER (WHERE checkouts_started > 0) AS sessions_with_checkout,
       count(*) FILTER (WHERE is_converted) AS converted_sessions,
       {total('session_revenue')} AS total_revenue,
       {mean('session_revenue', 'is_converted')} AS avg_order_value
FROM flagged GROUP BY 1, 2, 3, 4, 5
""", "flagged")

cte("long_sessions", """
SELECT user_pseudo_id, session_date AS event_date, session_start_ts AS session_start, session_end_ts AS session_end,
       session_duration_seconds AS session_length, session_number, ga_session_id AS session_id
FROM sessions WHERE session_duration_seconds > 0 AND session_number > 0
""", "sessions")

cte("bought", f"""
SELECT transaction_id, user_pseudo_id, event_date, purchase_ts, currency, total_revenue,
       count(*) AS items_count, {big('sum(quantity)')} AS total_quantity
FROM lines WHERE is_complete GROUP BY 1, 2, 3, 4, 5, 6
""", "lines")

cte("places", """
SELECT sid AS session_id,
       first(country ORDER BY event_ts, event_id) AS country,
       first(region ORDER BY event_ts, event_id) AS region,
       first(city ORDER BY event_ts, event_id) AS city
FROM ev WHERE has_params AND k % 11 <> 0 GROUP BY 1
""", "ev")

cte("user_places", """
SELECT sid AS session_id, user_pseudo_id,
       first(country ORDER BY event_ts, event_id) AS country,
       first(region ORDER BY event_ts, event_id) AS region,
       first(city ORDER BY event_ts, event_id) AS city
FROM ev WHERE has_params AND k % 11 <> 0 GROUP BY 1, 2
""", "ev")

# --- web: staging and intermediate --------------------------------------------

define("stg_events", """
SELECT event_id, event_date, event_ts, user_pseudo_id, event_name, platform, operating_system, browser,
       device_category, mobile_brand, continent, country, region, city,
       traffic_source, traffic_medium, traffic_campaign,
       CASE WHEN k = 99 THEN NULL WHEN k = 49 THEN 0 ELSE
         2 + CAST(k % 11 <> 0 AS INTEGER) + CAST(k % 2 = 0 AS INTEGER) + CAST(k % 3 = 0 AS INTEGER)
         + CASE WHEN event_name = 'purchase' THEN 2 + CAST(k % 7 <> 0 AS INTEGER) ELSE 0 END END AS param_count,
       CASE WHEN k % 10 = 9 AND c.item_count IS NOT NULL THEN 0 ELSE c.item_count END AS item_count
FROM ev LEFT JOIN (SELECT l_orderkey, CAST(count(*) AS INTEGER) AS item_count FROM order_lines GROUP BY 1) c
  ON c.l_orderkey = ev.n
""", "ev", "order_lines")

define("stg_event_params", f"""
SELECT event_id, event_date, event_ts, user_pseudo_id, event_name, param_key,
       string_value, int_value, {rnd('float_value')} AS float_value, {rnd('double_value')} AS double_value
FROM params
""", "params")

define("stg_items", f"""
SELECT event_id, event_date, event_ts, user_pseudo_id, event_name, item_id, item_name, item_brand, item_variant,
       item_category, item_category2, item_category3, item_category4, item_category5,
       {rnd('price')} AS price, quantity
FROM items
""", "items")

define("stg_event_param_pivot", f"SELECT * REPLACE ({rnd('value')} AS value) FROM piv", "piv")
define("int_event_param_pivot", f"SELECT * REPLACE ({rnd('value_param')} AS value_param) FROM wide_piv", "wide_piv")

for _name in ("int_geo", "dim_geo"):
    define(_name, "SELECT event_id, country, region, city FROM ev", "ev")
for _name in ("int_platform", "dim_platform"):
    define(_name, "SELECT event_id, platform, device_category, operating_system, browser FROM raw", "raw")
for _name in ("int_users", "dim_users"):
    define(_name, """
SELECT user_pseudo_id, min(event_date) AS first_seen_date, max(event_date) AS last_seen_date,
       count(DISTINCT event_date) AS days_active, count(*) AS total_events
FROM raw GROUP BY 1
""", "raw")

define("int_page_views", """
SELECT event_id, event_date, event_ts, user_pseudo_id, platform, device_category, country, traffic_source
FROM ev WHERE event_name = 'page_view' AND user_pseudo_id IS NOT NULL
""", "ev")

define("int_purchase", f"""
SELECT p.transaction_id, e.user_pseudo_id, p.ga_session_id, e.event_ts AS purchase_ts,
       {rnd('p.value')} AS revenue, p.currency
FROM raw e JOIN piv p ON e.event_id = p.event_id
WHERE e.event_name = 'purchase' AND p.transaction_id IS NOT NULL
""", "raw", "piv")

define("int_purchase_items", f"""
SELECT * EXCLUDE (event_id, ga_session_id)
  REPLACE ({rnd('total_revenue')} AS total_revenue, {rnd('unit_price')} AS unit_price, {rnd('item_revenue')} AS item_revenue)
FROM lines
""", "lines")

define("int_session_transactions", """
SELECT DISTINCT ev.user_pseudo_id, piv.ga_session_id, ev.user_pseudo_id || '-' || CAST(piv.ga_session_id AS VARCHAR) AS session_key,
       ev.event_date AS session_date, piv.transaction_id
FROM ev JOIN piv ON ev.event_id = piv.event_id WHERE piv.ga_session_id IS NOT NULL AND piv.transaction_id IS NOT NULL
""", "ev", "piv")

define("int_sessions", f"""
SELECT * REPLACE ({rnd('session_revenue')} AS session_revenue) FROM listed
""", "listed")

# --- web: marts -----------------------------------------------------------------

define("agg_daily_sessions", f"""
SELECT * REPLACE ({rnd('avg_session_duration_seconds')} AS avg_session_duration_seconds,
                  {rnd('avg_pages_per_session')} AS avg_pages_per_session,
                  {rnd('total_revenue')} AS total_revenue, {rnd('avg_order_value')} AS avg_order_value),
       {rnd(ratio('bounced_sessions', 'total_sessions'))} AS bounce_rate,
       {rnd(ratio('converted_sessions', 'total_sessions'))} AS session_conversion_rate,
       {rnd(ratio('sessions_with_add_to_cart', 'sessions_with_product_views'))} AS add_to_cart_rate,
       {rnd(ratio('converted_sessions', 'sessions_with_checkout'))} AS checkout_completion_rate,
       {rnd(ratio('total_revenue', 'total_sessions'))} AS revenue_per_session,
       {rnd(ratio('returning_user_sessions', 'new_user_sessions'))} AS returning_to_new_ratio
FROM daily
""", "daily")

define("agg_daily_funnel_long", """
SELECT session_date, s.stage_order, s.stage, s.sessions
FROM (SELECT session_date, unnest([
        {'stage_order': 1, 'stage': 'Product views', 'sessions': sessions_with_product_views},
        {'stage_order': 2, 'stage': 'Add to cart', 'sessions': sessions_with_add_to_cart},
        {'stage_order': 3, 'stage': 'Checkout', 'sessions': sessions_with_checkout},
        {'stage_order': 4, 'stage': 'Purchase', 'sessions': converted_sessions}]) AS s
      FROM daily)
""", "daily")

define("agg_weekly_dropoff_rates", f"""
SELECT week_start, v AS sessions_with_product_views, a AS sessions_with_add_to_cart, c AS sessions_with_checkout,
       p AS converted_sessions,
       {rnd('1 - ' + ratio('a', 'v'))} AS dropoff_view_to_cart,
       {rnd('1 - ' + ratio('c', 'a'))} AS dropoff_cart_to_checkout,
       {rnd('1 - ' + ratio('p', 'c'))} AS dropoff_checkout_to_purchase
FROM (
  SELECT CAST(date_trunc('week', session_date) AS DATE) AS week_start,
         {big('sum(sessions_with_product_views)')} AS v, {big('sum(sessions_with_add_to_cart)')} AS a,
         {big('sum(sessions_with_checkout)')} AS c, {big('sum(converted_sessions)')} AS p
  FROM daily GROUP BY 1
)
""", "daily")

define("agg_daily_geo", f"""
SELECT session_date, country, region, city, continent, continent AS sub_continent,
       count(*) AS total_sessions,
       count(*) FILTER (WHERE is_first_session) AS new_user_sessions,
       count(*) FILTER (WHERE is_converted) AS converted_sessions,
       count(*) FILTER (WHERE is_bounce) AS bounced_sessions,
       {rnd(ratio('count(*) FILTER (WHERE is_converted)', 'count(*)') + ' * 100', 2)} AS conversion_rate,
       {rnd(ratio('count(*) FILTER (WHERE is_bounce)', 'count(*)') + ' * 100', 2)} AS bounce_rate,
       {rnd('avg(session_duration_seconds)', 2)} AS avg_session_duration_seconds,
       {rnd('avg(page_views)', 2)} AS avg_pages_per_session,
       {big('sum(product_views)')} AS total_product_views, {big('sum(add_to_carts)')} AS total_add_to_carts,
       {big('sum(purchases)')} AS total_purchases, {rnd(total('session_revenue'))} AS total_revenue,
       {rnd(ratio(total('session_revenue'), 'count(*) FILTER (WHERE is_converted)'), 2)} AS avg_order_value
FROM flagged GROUP BY session_date, country, region, city, continent
""", "flagged")

define("agg_daily_product_revenue", f"""
SELECT event_date, product_key, item_name, item_brand, item_category,
       count(DISTINCT transaction_id) AS transactions, {big('sum(quantity)')} AS units_sold,
       {rnd('sum(item_revenue)')} AS total_revenue, {rnd(mean('unit_price'))} AS avg_unit_price
FROM lines WHERE is_complete GROUP BY 1, 2, 3, 4, 5
""", "lines")

define("analysis_incomplete_purchases", f"""
SELECT transaction_id, user_pseudo_id, lines.event_date, purchase_ts, {rnd('total_revenue')} AS total_revenue, currency,
       product_key, item_name, quantity, {rnd('item_revenue')} AS item_revenue,
       is_valid_transaction, has_items, is_complete,
       d.n AS daily_incomplete_count, {rnd('d.revenue')} AS daily_potential_revenue
FROM lines LEFT JOIN (
  SELECT event_date, count(*) AS n, sum(coalesce(total_revenue, 0)) AS revenue
  FROM lines WHERE NOT is_complete GROUP BY 1) d ON d.event_date = lines.event_date
WHERE NOT is_complete
""", "lines")

define("dim_items", f"""
SELECT transaction_id, item_id, item_name, item_brand, item_category, {rnd('unit_price')} AS price
FROM lines WHERE is_valid_transaction AND has_items
""", "lines")

define("dim_products", """
SELECT DISTINCT product_key, item_id, item_name, item_brand, item_category FROM lines WHERE product_key IS NOT NULL
""", "lines")

define("dim_views", """
SELECT event_date, count(*) AS total_page_views, count(DISTINCT user_pseudo_id) AS unique_users
FROM raw WHERE event_name = 'page_view' AND user_pseudo_id IS NOT NULL GROUP BY 1
""", "raw")

define("fct_events", f"""
SELECT e.event_id, e.event_date, e.event_ts, e.user_pseudo_id, e.event_name,
       p.ga_session_id, p.transaction_id, {rnd('p.value_param')} AS event_value, p.currency, p.page_location, p.page_title
FROM raw e LEFT JOIN wide_piv p ON e.event_id = p.event_id
""", "raw", "wide_piv")

define("fct_purchases", f"SELECT * REPLACE ({rnd('total_revenue')} AS total_revenue) FROM bought", "bought")
define("fct_sessions", "SELECT * FROM long_sessions", "long_sessions")

for _name, _session in (("fct_daily_web_metrics", "session_id"),
                        ("fct_daily_web_metrics_user_scoped", "(user_pseudo_id, session_id)")):
    define(_name, f"""
SELECT s.event_date, s.total_sessions, s.total_users, {rnd('s.length')} AS average_session_duration,
       coalesce(r.transactions, 0) AS total_transactions, {rnd('coalesce(r.revenue, 0)')} AS total_revenue,
       coalesce(r.quantity, 0) AS total_quantity,
       {rnd('coalesce(' + ratio('r.transactions', 's.total_sessions') + ', 0)')} AS conversion_rate
FROM (SELECT event_date, count(DISTINCT {_session}) AS total_sessions, count(DISTINCT user_pseudo_id) AS total_users,
             avg(session_length) AS length FROM long_sessions GROUP BY 1) s
LEFT JOIN (SELECT event_date, count(DISTINCT transaction_id) AS transactions, sum(total_revenue) AS revenue,
                  {big('sum(total_quantity)')} AS quantity FROM bought GROUP BY 1) r ON r.event_date = s.event_date
""", "long_sessions", "bought")

for _name, _id in (("dim_funnel_daily", "ga_session_id"),
                   ("dim_funnel_daily_user_scoped", "(ga_session_id, user_pseudo_id)")):
    define(_name, f"""
SELECT session_date, country, platform, device_category,
       count(DISTINCT {_id}) AS total_sessions,
       count(DISTINCT {_id}) FILTER (WHERE product_views > 0) AS sessions_view_item,
       count(DISTINCT {_id}) FILTER (WHERE add_to_carts > 0) AS sessions_add_to_cart,
       count(DISTINCT {_id}) FILTER (WHERE checkouts_started > 0) AS sessions_begin_checkout,
       count(DISTINCT {_id}) FILTER (WHERE purchases > 0) AS sessions_purchase,
       {rnd(total('session_revenue'))} AS total_revenue,
       {rnd(ratio(f'count(DISTINCT {_id}) FILTER (WHERE purchases > 0)', f'count(DISTINCT {_id})'))}
         AS session_conversion_rate
FROM sessions GROUP BY 1, 2, 3, 4
""", "sessions")

define("dim_product_daily", f"""
SELECT event_date, item_id, item_name, item_brand, item_category,
       count(*) FILTER (WHERE event_name = 'view_item') AS item_views,
       count(*) FILTER (WHERE event_name = 'add_to_cart') AS item_add_to_carts,
       count(*) FILTER (WHERE event_name = 'begin_checkout') AS item_checkouts,
       count(*) FILTER (WHERE event_name = 'purchase') AS item_purchases,
       {rnd("sum(CASE WHEN event_name = 'purchase' THEN coalesce(own_revenue, price * quantity, 0) ELSE 0 END)")}
         AS item_revenue
FROM items WHERE event_name IN ('view_item', 'add_to_cart', 'begin_checkout', 'purchase')
GROUP BY 1, 2, 3, 4, 5
""", "items")

define("rpt_funnel_sessions", f"""
SELECT user_pseudo_id, ga_session_id AS session_id, session_key, session_date, session_start_ts, session_end_ts,
       session_duration_seconds, session_number, is_first_session, is_bounce, is_converted,
       operating_system, browser, device_category, platform, mobile_brand, country, region, city,
       traffic_source, traffic_medium, traffic_campaign, landing_page, exit_page, referrer,
       product_views, add_to_carts, checkouts_started, purchases,
       product_views > 0 AS reached_product_view, add_to_carts > 0 AS reached_add_to_cart,
       checkouts_started > 0 AS reached_checkout, purchases > 0 AS reached_purchase,
       level AS furthest_funnel_stage,
       (['No Funnel Activity', 'Product View', 'Add to Cart', 'Checkout', 'Purchase'])[level + 1]
         AS furthest_funnel_stage_name,
       ([NULL, 'Product View', 'Add to Cart', 'Checkout', NULL])[level + 1] AS drop_off_stage,
       product_views > 0 AND add_to_carts = 0 AS dropped_at_product_view,
       add_to_carts > 0 AND checkouts_started = 0 AS dropped_at_add_to_cart,
       checkouts_started > 0 AND purchases = 0 AS dropped_at_checkout,
       {rnd('session_revenue')} AS session_revenue, currency, transaction_ids, transaction_count
FROM (SELECT *, greatest(CASE WHEN purchases > 0 THEN 4 ELSE 0 END, CASE WHEN checkouts_started > 0 THEN 3 ELSE 0 END,
                         CASE WHEN add_to_carts > 0 THEN 2 ELSE 0 END, CASE WHEN product_views > 0 THEN 1 ELSE 0 END)
             AS level FROM listed)
""", "listed")

for _name, _where, _keys in (("rpt_sessions_wide", "places", "(session_id)"),
                             ("rpt_sessions_wide_user_scoped", "user_places", "(session_id, user_pseudo_id)")):
    _by = _keys.strip("()").replace("session_id", "ga_session_id AS session_id")
    define(_name, f"""
SELECT session_id, s.user_pseudo_id, event_date, session_start, session_end, session_length, session_number,
       country, region, city, coalesce(transactions, 0) AS total_transactions,
       {rnd('coalesce(revenue, 0)')} AS total_revenue,
       CASE WHEN coalesce(transactions, 0) > 0 THEN 1 ELSE 0 END AS has_transaction
FROM long_sessions s LEFT JOIN {_where} USING {_keys}
LEFT JOIN (
  SELECT {_keys.strip('()')}, count(DISTINCT transaction_id) AS transactions, sum(total_revenue) AS revenue
  FROM (SELECT DISTINCT transaction_id, user_pseudo_id, event_date, purchase_ts, currency, total_revenue,
               ga_session_id AS session_id FROM lines WHERE is_complete)
  GROUP BY {_keys.strip('()')}) c USING {_keys}
""".replace("s.user_pseudo_id", "s.user_pseudo_id AS user_pseudo_id"), "long_sessions", _where, "lines")

define("rpt_product_sales", f"""
SELECT event_id, user_pseudo_id, event_date, purchase_ts, transaction_id, ga_session_id AS session_id,
       item_id, item_name, item_brand, item_category, {rnd('unit_price')} AS price, quantity,
       {rnd('item_revenue')} AS item_revenue, country, region, city
FROM lines LEFT JOIN (SELECT * FROM places WHERE session_id IN (SELECT session_id FROM long_sessions)) p
  ON p.session_id = lines.ga_session_id
""", "lines", "places", "long_sessions")

define("rpt_purchase_dq", f"""
SELECT transaction_id, user_pseudo_id, event_date, event_id,
       CASE WHEN is_valid_transaction THEN 'MISSING_ITEMS' WHEN has_items THEN 'MISSING_TRANSACTION_ID'
            ELSE 'MISSING_BOTH' END AS invalid_reason,
       item_name, {rnd('item_revenue')} AS estimated_revenue, quantity
FROM lines WHERE NOT is_complete
""", "lines")

define("source_profile", """
SELECT event_name, count(*) AS event_count, min(day_text) AS min_date, max(day_text) AS max_date
FROM raw GROUP BY 1 ORDER BY event_count DESC, event_name LIMIT 20
""", "raw")

define("filter_loss_audit", """
SELECT 1 AS position, 'Total Purchase Events (stg_events)' AS metric,
       (SELECT count(*) FROM raw WHERE event_name = 'purchase') AS count
UNION ALL SELECT 2, 'Purchase Events with Transaction ID',
       (SELECT count(DISTINCT event_id) FROM piv WHERE event_name = 'purchase' AND transaction_id IS NOT NULL)
UNION ALL SELECT 3, 'Purchase Events with Items',
       (SELECT count(DISTINCT event_id) FROM items WHERE event_name = 'purchase')
UNION ALL SELECT 4, 'Final Purchase Item Rows (int_purchase_items)', (SELECT count(*) FROM lines)
UNION ALL SELECT 5, '------- SESSION ANALYSIS -------', NULL
UNION ALL SELECT 6, 'Total Events (stg_events)', (SELECT count(*) FROM raw)
UNION ALL SELECT 7, 'Events Missing ga_session_id (filtered out)',
       (SELECT count(*) FROM raw LEFT JOIN piv ON raw.event_id = piv.event_id WHERE piv.ga_session_id IS NULL)
UNION ALL SELECT 8, 'Events with Session ID (included in int_sessions)',
       (SELECT count(*) FROM raw JOIN piv ON raw.event_id = piv.event_id WHERE piv.ga_session_id IS NOT NULL)
""", "raw", "piv", "items", "lines")

cte("purchase_state", """
SELECT e.event_id, e.user_pseudo_id, e.event_date, e.operating_system, p.transaction_id, p.value,
       i.event_id IS NOT NULL AS has_items, p.transaction_id IS NOT NULL AND i.event_id IS NOT NULL AS is_complete
FROM raw e LEFT JOIN piv p ON p.event_id = e.event_id
LEFT JOIN (SELECT DISTINCT event_id FROM items) i ON i.event_id = e.event_id
WHERE e.event_name = 'purchase'
""", "raw", "piv", "items")

define("incomplete_by_os", """
SELECT operating_system, count(*) AS incomplete_purchases FROM purchase_state WHERE NOT is_complete GROUP BY 1
""", "purchase_state")

define("incomplete_by_week", f"""
SELECT event_date - CAST(dayofweek(event_date) AS INTEGER) AS week_start, count(*) AS incomplete_purchases,
       {rnd('coalesce(sum(value), 0)')} AS revenue_lost
FROM purchase_state WHERE NOT is_complete GROUP BY 1
""", "purchase_state")

define("purchase_completeness", f"""
SELECT count(*) AS purchase_events, count(*) FILTER (WHERE is_complete) AS complete_events,
       count(*) FILTER (WHERE transaction_id IS NULL) AS missing_transaction_id,
       count(*) FILTER (WHERE NOT has_items) AS missing_items,
       {rnd('coalesce(sum(value) FILTER (WHERE NOT is_complete), 0)')} AS revenue_at_risk,
       count(DISTINCT user_pseudo_id) FILTER (WHERE NOT is_complete) AS users_affected,
       {rnd(ratio('count(*) FILTER (WHERE is_complete)', 'count(*)') + ' * 100', 2)} AS complete_pct
FROM purchase_state
""", "purchase_state")

# --- commerce -------------------------------------------------------------------

cte("order_sums", """
SELECT l_orderkey, CAST(sum((90000 + part % 1000 * 10) * qty) AS BIGINT) AS subtotal FROM parts GROUP BY 1
""", "parts")

cte("shop", """
SELECT *, CAST(floor((subtotal * rate + 50) / 100) AS BIGINT) AS tax, 500 + k * 10 AS shipping
FROM (
  SELECT src.*, home.country, coalesce(home.n_nationkey % 4, 0) + 5 AS rate, coalesce(subtotal, 0) AS subtotal,
         substr(c_name, 10) AS last_name, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp,
         CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'cart_add' WHEN 'signup' THEN 'checkout_start'
              WHEN 'purchase' THEN (['order_create', 'order_paid', 'order_paid', 'order_fulfilled', 'order_cancelled'])[k % 5 + 1]
              ELSE 'cart_abandon' END AS kind
  FROM src LEFT JOIN home ON user_id = c_custkey LEFT JOIN customer USING (c_custkey)
  LEFT JOIN order_sums ON l_orderkey = n
)
""", "src", "home", "order_sums")

# Which parts each event shows: a view only its first, an order with an empty list none.
cte("shop_items", """
SELECT l_orderkey, part, qty, row_number() OVER (PARTITION BY l_orderkey ORDER BY slot, part) AS place FROM parts
""", "parts")

# Of several rows with one key the smallest survives, column by column.
_SILVER_ORDER = ["event_type", "session_id", "event_timestamp", "event_date", "customer_id", "customer_first_name",
                 "customer_last_name", "customer_email", "customer_country", "customer_tax_rate", "channel", "device",
                 "cart_id", "abandon_stage", "order_subtotal", "order_tax", "order_tax_rate", "order_shipping",
                 "order_total_amount", "order_status", "order_created_at_raw", "order_paid_at_raw",
                 "order_fulfilled_at_raw", "order_cancelled_at_raw", "order_cancel_reason", "product_name",
                 "product_category", "product_price", "quantity"]

cte("silver", """
SELECT DISTINCT ON (event_id, product_id, order_id) *
FROM (
SELECT 'E' || CAST(n AS VARCHAR) AS event_id, kind AS event_type,
       'S' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
       CASE WHEN n % 50 = 0 THEN date_trunc('second', ts) ELSE ts END AS event_timestamp, CAST(ts AS DATE) AS event_date,
       CAST(user_id AS INTEGER) AS customer_id, 'Customer' AS customer_first_name, last_name AS customer_last_name,
       'c' || CAST(user_id AS VARCHAR) || '@example.com' AS customer_email, country AS customer_country,
       rate / 100.0::DOUBLE AS customer_tax_rate,
       (['Google', 'Facebook', 'Email', 'Direct'])[k % 4 + 1] AS channel,
       (['mobile', 'desktop', 'tablet'])[k % 3 + 1] AS device,
       CASE WHEN kind IN ('cart_add', 'checkout_start', 'cart_abandon') OR (event_type = 'purchase' AND k % 20 = 2)
            THEN 'C' || CAST(n AS VARCHAR) END AS cart_id,
       CASE WHEN kind = 'cart_abandon' THEN (['cart', 'checkout'])[k % 2 + 1] END AS abandon_stage,
       CASE WHEN event_type = 'purchase' THEN 'O' || CAST(n AS VARCHAR) END AS order_id,
       CASE WHEN event_type = 'purchase' THEN subtotal / 100.0::DOUBLE END AS order_subtotal,
       CASE WHEN event_type = 'purchase' THEN tax / 100.0::DOUBLE END AS order_tax,
       CASE WHEN event_type = 'purchase' THEN rate / 100.0::DOUBLE END AS order_tax_rate,
       CASE WHEN event_type = 'purchase' THEN shipping / 100.0::DOUBLE END AS order_shipping,
       CASE WHEN event_type = 'purchase'
            THEN (subtotal + tax + shipping + CASE WHEN k % 10 = 3 THEN 100 ELSE 0 END) / 100.0::DOUBLE END AS order_total_amount,
       CASE WHEN event_type = 'purchase' THEN 'fulfilled' END AS order_status,
       CASE WHEN event_type = 'purchase' THEN stamp END AS order_created_at_raw,
       CASE WHEN event_type = 'purchase' AND kind <> 'order_create' THEN stamp END AS order_paid_at_raw,
       CASE WHEN kind = 'order_fulfilled' THEN stamp END AS order_fulfilled_at_raw,
       CASE WHEN kind = 'order_cancelled' THEN stamp END AS order_cancelled_at_raw,
       CASE WHEN kind = 'order_cancelled' THEN 'changed mind' END AS order_cancel_reason,
       CAST(part AS INTEGER) AS product_id,
       'Part ' || CAST(part AS VARCHAR) AS product_name,
       'Category ' || CAST(part % 10 AS VARCHAR) AS product_category,
       (90000 + part % 1000 * 10) / 100.0::DOUBLE AS product_price,
       CASE WHEN kind = 'product_view' AND part IS NOT NULL THEN 1 ELSE CAST(qty AS INTEGER) END AS quantity
FROM shop LEFT JOIN shop_items
  ON l_orderkey = n
 AND CASE WHEN event_type = 'purchase' THEN k % 20 <> 2 WHEN kind = 'product_view' THEN place = 1 ELSE true END
WHERE n % 97 <> 0
)
ORDER BY event_id, product_id, order_id, """ + ", ".join(f"{c} NULLS FIRST" for c in _SILVER_ORDER), "shop", "shop_items")

_SILVER = f"""
SELECT * REPLACE ({rnd('customer_tax_rate')} AS customer_tax_rate, {rnd('order_subtotal')} AS order_subtotal,
                  {rnd('order_tax')} AS order_tax, {rnd('order_tax_rate')} AS order_tax_rate,
                  {rnd('order_shipping')} AS order_shipping, {rnd('order_total_amount')} AS order_total_amount,
                  {rnd('product_price')} AS product_price)
FROM silver
"""
define("commerce_silver", _SILVER, "silver")
define("commerce_landing_roundtrip", _SILVER, "silver")

cte("paid", """
SELECT customer_id, channel, customer_country, order_id, max(order_total_amount) AS total, sum(quantity) AS units
FROM silver WHERE event_type = 'order_paid' GROUP BY 1, 2, 3, 4
""", "silver")

define("orders_by_country", """
SELECT customer_country AS country, count(DISTINCT order_id) AS total_orders
FROM silver WHERE order_id IS NOT NULL GROUP BY 1
""", "silver")

define("hourly_category_revenue", f"""
SELECT date_trunc('hour', event_timestamp) AS hour, product_category,
       {rnd('sum(product_price * quantity)')} AS revenue, {big('sum(quantity)')} AS units
FROM silver WHERE event_type = 'order_paid' AND product_id IS NOT NULL GROUP BY 1, 2
""", "silver")

define("customer_ltv", f"""
SELECT customer_id, count(*) AS orders, {rnd('sum(total)')} AS lifetime_value, {big('sum(units)')} AS total_quantity
FROM paid GROUP BY 1
""", "paid")

define("event_funnel_counts", """
SELECT event_type, count(DISTINCT event_id) AS events FROM silver GROUP BY 1
""", "silver")

define("channel_performance", f"""
SELECT channel, count(*) AS orders, {rnd('sum(total)')} AS revenue FROM paid GROUP BY 1
""", "paid")

define("average_order_value", f"""
SELECT customer_country AS country, count(*) AS orders, {rnd(mean('total'))} AS avg_order_value FROM paid GROUP BY 1
""", "paid")

# --- stations -------------------------------------------------------------------

cte("readings", """
SELECT n, k, ts, CAST((CASE WHEN half = 0 THEN n ELSE n * 7 + 3 END)
                      % (SELECT max(s_suppkey) + 3 FROM supplier) AS VARCHAR) AS station_id,
       k + 100 AS num_bikes_available, k % 15 AS num_docks_available,
       CASE WHEN k % 9 <> 0 THEN k + half * 60 END AS electric, CASE WHEN k % 8 <> 0 THEN 100 - k END AS classic,
       make_timestamp(CAST(floor(micros / 1000000) - half * 60 AS BIGINT) * 1000000) AS "timestamp",
       CASE WHEN k = 97 THEN 'raw/status/undated/xx/yy/' ELSE strftime(ts, 'raw/status/%Y/%m/%d/') END
         || strftime(ts, '%H%M%S.json') AS source_file
FROM src, (VALUES (0), (1)) AS h(half)
WHERE k % 17 <> 0
""", "src")


def _curated(zero: bool, where: str = "true") -> str:
    kind = "coalesce({0}, 0)" if zero else "{0}"
    return f"""
SELECT station_id, {big('num_bikes_available')} AS num_bikes_available, {big('num_docks_available')} AS num_docks_available,
       {big(kind.format('electric'))} AS electric, {big(kind.format('classic'))} AS classic, "timestamp",
       s_name AS name, CAST(s_suppkey AS VARCHAR) || ' Main St' AS address,
       {rnd('40.0 + (s_suppkey % 100) / 100.0')} AS lat, {rnd('-111.0 - (s_suppkey % 100) / 100.0')} AS lon,
       CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
       CAST(day("timestamp") AS INTEGER) AS day
FROM readings JOIN supplier ON station_id = CAST(s_suppkey AS VARCHAR)
WHERE {where}
"""


define("station_curated", _curated(False), "readings")
define("station_curated_zero_filled", _curated(True), "readings")
define("station_incremental", _curated(
    False, "k = 97 OR date_trunc('minute', ts) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 72 HOURS"
), "readings")
define("station_latest_snapshot", f"""
SELECT source_file, station_id, {big('num_bikes_available')} AS num_bikes_available,
       {big('num_docks_available')} AS num_docks_available, {big('electric')} AS electric, {big('classic')} AS classic, "timestamp"
FROM readings WHERE source_file = (
  SELECT max(strftime(ts, 'raw/status/%Y/%m/%d/%H%M%S.json')) FROM src WHERE k <> 97)
""", "readings")

# --- trips ----------------------------------------------------------------------

cte("bronze", """
SELECT ts AS pickup_ts,
       CASE WHEN k <> 60 THEN ts + CASE WHEN k = 7 THEN INTERVAL 30 SECONDS ELSE to_minutes(3 * (k - 5)) END END AS dropoff_ts,
       CAST(k % 6 AS INTEGER) AS passenger_count,
       CASE WHEN k % 2 = 0 THEN value - 20 ELSE value END AS trip_distance,
       CAST(user_id % 27 AS INTEGER) AS pickup_location_id, CAST(n % 27 AS INTEGER) AS dropoff_location_id,
       value * 0.8::DOUBLE AS fare_amount, value * 0.1::DOUBLE AS tip_amount, value - 30 AS total_amount,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) + CASE WHEN k = 50 THEN 1 ELSE 0 END AS INTEGER) AS month
FROM src
""", "src")

cte("timed", """
SELECT *, CAST(pickup_ts AS DATE) AS pickup_date, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
       CAST(year(pickup_ts) AS INTEGER) AS pickup_year, CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
       date_diff('second', pickup_ts, dropoff_ts) / 60.0::DOUBLE AS trip_minutes
FROM bronze
""", "bronze")

cte("good", """
SELECT pickup_ts, dropoff_ts, pickup_date, pickup_hour, pickup_location_id, dropoff_location_id, passenger_count,
       trip_distance, fare_amount, tip_amount, total_amount, trip_minutes, year, month
FROM timed
WHERE trip_minutes >= 1 AND trip_minutes <= 240 AND trip_distance > 0 AND total_amount > 0
  AND pickup_year = year AND pickup_month = month
""", "timed")

cte("bad", """
SELECT * FROM (
  SELECT *, CASE WHEN pickup_ts IS NULL OR dropoff_ts IS NULL THEN 'NULL_TIMESTAMP'
                 WHEN trip_minutes <= 0 THEN 'NEGATIVE_OR_ZERO_DURATION'
                 WHEN trip_minutes > 240 THEN 'DURATION_TOO_LONG'
                 WHEN trip_distance <= 0 THEN 'NONPOSITIVE_DISTANCE'
                 WHEN total_amount <= 0 THEN 'NONPOSITIVE_TOTAL_AMOUNT'
                 WHEN pickup_year <> year OR pickup_month <> month THEN 'EVENT_TIME_OUTSIDE_SOURCE_PARTITION'
            END AS dq_reason
  FROM timed)
WHERE dq_reason IS NOT NULL
""", "timed")

cte("days", """
SELECT *, d AS date, CAST(dd - 10 AS DOUBLE) AS min_temp_c, CAST(dd + CASE WHEN dd = 13 THEN 100 ELSE 0 END AS DOUBLE) AS max_temp_c,
       CAST(dd % 5 * 2 AS DOUBLE) AS rain_mm, CASE WHEN dd % 10 = 0 THEN -1.0 ELSE CAST(dd % 3 AS DOUBLE) END AS snow
FROM (SELECT DISTINCT CAST(ts AS DATE) AS d, day(ts) AS dd FROM events WHERE day(ts) < 29)
""")

cte("weather", """
SELECT date, min_temp_c, max_temp_c, rain_mm, snow, rain_mm > 0 AS is_rain, snow > 0 AS is_snow, dd
FROM days WHERE min_temp_c BETWEEN -50 AND 50 AND max_temp_c BETWEEN -50 AND 60 AND rain_mm >= 0 AND snow >= 0
""", "days")

_MONEY = ", ".join(f"{rnd(c)} AS {c}" for c in ("trip_distance", "fare_amount", "tip_amount", "total_amount", "trip_minutes"))

define("weather_daily", """
SELECT date, CAST(dd - 10 AS VARCHAR) AS tmin_c, CAST(CAST(max_temp_c AS INTEGER) AS VARCHAR) AS tmax_c,
       CAST(CAST(rain_mm AS INTEGER) AS VARCHAR) AS prcp_mm, CAST(snow AS DOUBLE) AS snow_mm,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       min_temp_c, max_temp_c, rain_mm, is_rain, is_snow
FROM weather
""", "weather")

define("partition_counts", """
SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(*) AS trips FROM days GROUP BY 1, 2
""", "days")

define("dim_zone", """
SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
       (['Yellow Zone', 'Boro Zone', 'Airports'])[n_nationkey % 3 + 1] AS service_zone
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")

define("trips_silver", f"SELECT * REPLACE ({_MONEY}) FROM good", "good")

define("trips_quarantine", f"""
SELECT * EXCLUDE (pickup_hour, passenger_count) REPLACE ({_MONEY}) FROM bad
""", "bad")

define("quarantine_summary", """
SELECT dq_reason, count(*) AS "rows" FROM bad GROUP BY 1 ORDER BY 2 DESC, 1
""", "bad")

define("dq_split_counts", """
SELECT count(*) AS bronze_rows, (SELECT count(*) FROM good) AS silver_rows, (SELECT count(*) FROM bad) AS quarantine_rows,
       count(*) - (SELECT count(*) FROM good) - (SELECT count(*) FROM bad) AS unaccounted_rows
FROM timed
""", "good", "bad")

_KPI = f"""count(*) AS trips, {rnd('sum(total_amount)')} AS revenue, {rnd(mean('fare_amount'))} AS avg_fare,
       {rnd(mean('tip_amount'))} AS avg_tip, {rnd(mean('trip_distance'))} AS avg_distance,
       {rnd(mean('trip_minutes'))} AS avg_duration"""

define("city_daily_kpis", f"""
SELECT t.*, min_temp_c, max_temp_c, rain_mm, is_rain, is_snow
FROM (SELECT pickup_date AS date, year, month, {_KPI} FROM good GROUP BY 1, 2, 3) t LEFT JOIN weather USING (date)
""", "good", "weather")

define("zone_daily_kpis", f"""
SELECT t.*, min_temp_c, max_temp_c, rain_mm, is_rain, is_snow
FROM (SELECT pickup_date AS date, year, month, r_name AS borough, n_name AS zone,
             CASE WHEN n_nationkey IS NOT NULL THEN (['Yellow Zone', 'Boro Zone', 'Airports'])[n_nationkey % 3 + 1] END
               AS service_zone, {_KPI}
      FROM good LEFT JOIN nation ON n_nationkey = pickup_location_id LEFT JOIN region ON n_regionkey = r_regionkey
      GROUP BY 1, 2, 3, 4, 5, 6) t LEFT JOIN weather USING (date)
""", "good", "weather")

define("city_daily_simple", f"""
SELECT pickup_date, total_trips, total_revenue, avg_fare, avg_tip, avg_distance, avg_duration
FROM (SELECT pickup_date, {_KPI.replace('AS trips', 'AS total_trips').replace('AS revenue', 'AS total_revenue')}
      FROM good GROUP BY 1)
""", "good")

define("zone_daily_simple", f"""
SELECT pickup_date, pickup_location_id, count(*) AS trip_count, {rnd('sum(total_amount)')} AS revenue,
       {rnd(mean('trip_distance'))} AS avg_distance
FROM good GROUP BY 1, 2
""", "good")

# --- quality --------------------------------------------------------------------


def _nulls(table: str, source: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {source}"
        for c in columns
    )


_EVENT = ["event_date", "event_ts", "event_name", "user_pseudo_id"]
_FUNNEL_LONG = ORACLE["agg_daily_funnel_long"].rsplit("\n)\n", 1)[-1]
cte("views", ORACLE["dim_views"].rsplit("\n)\n", 1)[-1], "raw")
cte("funnel_long", _FUNNEL_LONG, "daily")
cte("products", ORACLE["dim_products"].rsplit("\n)\n", 1)[-1], "lines")

define("dq_not_null", "\nUNION ALL ".join([
    _nulls("stg_events", "raw", _EVENT),
    _nulls("stg_event_params", "params", _EVENT),
    _nulls("stg_items", "items", _EVENT),
    _nulls("stg_event_param_pivot", "piv", ["event_id", "event_date", "event_ts", "user_pseudo_id"]),
    _nulls("int_purchase_items", "lines", ["transaction_id", "purchase_ts"]),
    _nulls("int_sessions", "sessions", ["session_key"]),
    _nulls("dim_views", "views", ["event_date", "total_page_views", "unique_users"]),
    _nulls("fct_purchases", "bought", ["transaction_id", "user_pseudo_id", "purchase_ts"]),
    _nulls("dim_products", "products", ["product_key"]),
    _nulls("agg_daily_product_revenue", "(SELECT DISTINCT event_date, product_key, item_name FROM lines WHERE is_complete)",
           ["event_date", "product_key"]),
    _nulls("agg_daily_funnel_long", "funnel_long", ["session_date", "stage_order", "stage", "sessions"]),
    _nulls("agg_daily_sessions", "daily", ["session_date", "platform", "operating_system"]),
]), "raw", "params", "items", "piv", "lines", "sessions", "views", "bought", "products", "funnel_long", "daily")

define("dq_unique", """
SELECT 'stg_event_param_pivot' AS table_name, 'event_id' AS column_name, count(*) AS failures
FROM (SELECT event_id FROM piv WHERE event_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'dim_views', 'event_date', count(*)
FROM (SELECT event_date FROM views WHERE event_date IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
""", "piv", "views")

define("dq_commerce_silver", _nulls(
    "commerce_silver", "silver", ["event_id", "event_type", "session_id", "event_timestamp", "product_id"]
), "silver")

define("dq_order_arithmetic", f"""
SELECT 'E' || CAST(n AS VARCHAR) AS event_id, 'O' || CAST(n AS VARCHAR) AS order_id,
       {rnd('subtotal / 100.0')} AS subtotal, {rnd('tax / 100.0')} AS tax,
       {rnd('(subtotal + tax + shipping + CASE WHEN k % 10 = 3 THEN 100 ELSE 0 END) / 100.0')} AS total_amount,
       k % 20 = 2 AND subtotal <> 0 AS bad_subtotal, false AS bad_tax, k % 10 = 3 AS bad_total
FROM shop WHERE event_type = 'purchase' AND n % 97 <> 0 AND ((k % 20 = 2 AND subtotal <> 0) OR k % 10 = 3)
""", "shop")

# --- streaming ------------------------------------------------------------------

define("bronze_stream_counts", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS events FROM events GROUP BY 1, 2
""")

# --- whole jobs through files ------------------------------------------------------


def _by(layer: str, key: str, source: str) -> str:
    return f"SELECT '{layer}' AS layer, {key} AS key, count(*) AS \"rows\" FROM {source} GROUP BY 2"


# Trips of a flat folder: the month is the pickup's, and the third drop has distances that are no number.
cte("landed", """
SELECT *, date_diff('second', pickup_ts, dropoff_ts) / 60.0::DOUBLE AS trip_minutes,
       CAST(year(pickup_ts) AS VARCHAR) || '-' || CAST(month(pickup_ts) AS VARCHAR) AS part
FROM (
  SELECT ts AS pickup_ts,
         CASE WHEN k <> 60 THEN ts + CASE WHEN k = 7 THEN INTERVAL 30 SECONDS ELSE to_minutes(3 * (k - 5)) END END AS dropoff_ts,
         CASE WHEN n % 3 = 2 AND k % 4 = 3 THEN NULL WHEN k % 2 = 0 THEN value - 20 ELSE value END AS trip_distance,
         value - 30 AS total_amount, n % 3 = 2 AND k % 4 = 3 AS misfit,
         CASE WHEN n % 3 = 1 THEN '1.75' END AS airport_fee
  FROM src)
""", "src")

define("trip_ingestion", " UNION ALL ".join([
    _by("bronze", "part", "landed"),
    _by("traced", "'all'", "landed"),
    _by("airport_fee", "airport_fee", "landed"),
    _by("silver", "part", "(SELECT * FROM landed WHERE trip_minutes BETWEEN 1 AND 240 AND trip_distance > 0 AND total_amount > 0)"),
    _by("quarantine", "dq_reason", """(SELECT CASE WHEN dropoff_ts IS NULL THEN 'NULL_TIMESTAMP'
      WHEN trip_minutes <= 0 THEN 'NEGATIVE_OR_ZERO_DURATION' WHEN trip_minutes > 240 THEN 'DURATION_TOO_LONG'
      WHEN trip_distance <= 0 THEN 'NONPOSITIVE_DISTANCE' WHEN total_amount <= 0 THEN 'NONPOSITIVE_TOTAL_AMOUNT' END AS dq_reason
      FROM landed) WHERE dq_reason IS NOT NULL"""),
    _by("rescued", "'trip_distance'", "landed WHERE misfit"),
]), "landed")

# What of a line the first schema does not hold; the grown one holds all but customer ids and broken lines.
cte("json_lines", """
SELECT n % 3 AS drop_no, k,
       CASE WHEN k = 13 THEN 'no object' WHEN k % 10 = 3 THEN 'customer.customer_id' WHEN k % 10 = 1 THEN 'customer.loyalty'
            WHEN k % 10 = 2 THEN 'items[1].gift' WHEN k % 10 = 4 THEN 'customer.loyalty,items[1].gift' END AS misfit,
       k = 13 OR k % 10 = 3 AS never,
       CASE WHEN k % 10 IN (1, 4) THEN CAST(k % 4 AS VARCHAR) END AS tier,
       CASE WHEN k % 10 IN (2, 4) THEN CASE WHEN k % 20 = 2 THEN 'true' ELSE 'false' END END AS gift
FROM src
""", "src")


def _grown(state: str, source: str) -> list[str]:
    return [
        _by(f"{state}: typed", "CASE WHEN misfit IS NULL OR drop_no = 2 THEN 'streamed' ELSE 'replayed' END", f"{source} AND NOT never"),
        _by(f"{state}: rescued", "misfit", f"{source} AND never"),
        _by(f"{state}: tier", "tier", f"{source} AND NOT never"),
        _by(f"{state}: gift", "gift", f"{source} AND NOT never"),
    ]


define("json_rescue_replay", " UNION ALL ".join([
    _by("1 first: typed", "'streamed'", "json_lines WHERE drop_no < 2 AND misfit IS NULL"),
    _by("1 first: rescued", "misfit", "json_lines WHERE drop_no < 2 AND misfit IS NOT NULL"),
    *_grown("2 grown", "json_lines WHERE drop_no < 2"),
    *_grown("3 more", "json_lines WHERE drop_no < 3"),
]), "json_lines")

define("delivery_stream_recovery", """
SELECT state, event_type, count(*) AS "rows", count(DISTINCT event_id) AS events, max(ts) AS newest, CAST(6 AS BIGINT) AS batches
FROM events, (VALUES ('2 whole'), ('3 nothing new')) s(state) GROUP BY 1, 2
""")

define("export_suffix_range", """
SELECT day_text AS event_suffix, event_name, count(*) AS events, count(DISTINCT user_pseudo_id) AS users
FROM raw WHERE day_text BETWEEN '20240105' AND '20240120' GROUP BY 1, 2
""", "raw")

ORACLE["station_history_job"] = ORACLE["station_curated"]
ORACLE["weather_csv_job"] = ORACLE["weather_daily"]
ORACLE["zone_csv_job"] = ORACLE["dim_zone"]

define("trip_folders_job", """
SELECT year, month, count(*) AS trips, count(*) AS traced FROM bronze GROUP BY 1, 2
""", "bronze")

define("commerce_append_job", f"""
SELECT 'run ' || CAST(CASE WHEN n % 97 = 0 THEN 0 ELSE n % 3 END AS VARCHAR) AS layer, 'bronze' AS key, count(*) AS "rows" FROM src GROUP BY 1
UNION ALL
SELECT 'run ' || CAST(coalesce(CAST(substr(event_id, 2) AS BIGINT) % 3, 0) AS VARCHAR), 'silver', count(*) FROM silver GROUP BY 1
UNION ALL {_by("silver", "event_type", "silver")}
UNION ALL {_by("processed", "'true'", "silver")}
""", "src", "silver")

ORACLE["trip_lakehouse_job"] = " UNION ALL ".join(_by(layer, "'all'", f"({ORACLE[name]})") for layer, name in {
    "weather_daily": "weather_daily", "dim_zone": "dim_zone", "trips": "trips_silver", "trips_quarantine": "trips_quarantine",
    "city_daily_kpis": "city_daily_kpis", "zone_daily_kpis": "zone_daily_kpis", "kpi_city_daily": "city_daily_simple",
    "kpi_zone_daily": "zone_daily_simple"}.items()) + " UNION ALL " + _by(
        "weather_raw", "'all'", "(SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE day(ts) < 29)")

# --- weighted tables ------------------------------------------------------------------

for _bag in ("int_purchase_items", "dim_items", "analysis_incomplete_purchases", "rpt_purchase_dq", "rpt_product_sales"):
    ORACLE[f"{_bag}_weighted"] = f"SELECT *, count(*) AS copies FROM ({ORACLE[_bag]}) GROUP BY ALL"
