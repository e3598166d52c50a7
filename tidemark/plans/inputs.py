"""Pipeline inputs derived from the benchmark tables.

Each function reshapes ``events`` and the order tables into the layout one
pipeline expects. They are row-wise except for two keyed joins. As the export
formats do, an event nests the items of its order: web events one item per line,
commerce events one per part with the quantities of its lines added up. Queries
on items take them as rows instead (``web_item_rows``).

The vocabulary below is this module's own; it only has to be the same in
``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POSITIONS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(index: str, *values: str | None) -> str:
    """SQL for the list element at a zero-based, wrapping position."""
    listed = ", ".join("CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in values)
    return f"array({listed})[pmod({index}, {len(values)})]"


def numbered_events(spark: SparkSession, sf_dir: str, *texts: str) -> DataFrame:
    """Events with the number ``k`` from their properties and zone-free time parts.

    ``k`` and any further ``texts`` (SQL, aliased) come out of a generator, which
    evaluates them once per row; as plain columns they would be repeated in every
    expression that mentions them.
    """
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "CAST(ts AS TIMESTAMP_NTZ) AS ts", "user_id", "event_type", "value", "props"
    )
    settled = ", ".join([
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS micros",
        *texts,
    ])
    return events.selectExpr("event_id", "ts", "user_id", "event_type", "value", f"inline(array(struct({settled})))")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as (l_orderkey, i): its position, part and quantity."""
    return table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", f"""named_struct(
        'slot', CAST(pmod(l_linenumber - 1, {POSITIONS}) AS INT), 'part', l_partkey, 'qty', CAST(l_quantity AS BIGINT)) AS i""")


def line_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of each order in one array, as the nested export has them."""
    return order_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("i")).alias("basket"))


def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of each order as (l_orderkey, i): first position, part and total quantity."""
    per_part = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.expr(f"CAST(min(pmod(l_linenumber - 1, {POSITIONS})) AS INT) AS slot"),
        F.expr("CAST(sum(l_quantity) AS BIGINT) AS qty"))
    return per_part.selectExpr("l_orderkey", "named_struct('slot', slot, 'part', l_partkey, 'qty', qty) AS i")


def part_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of each order in one array, by their first position."""
    return order_parts(spark, sf_dir).groupBy("l_orderkey").agg(F.sort_array(F.collect_list("i")).alias("basket"))


CENTS = "(90000 + pmod(i.part, 1000) * 10)"

WEB_ITEM = f"""named_struct(
  'item_id', IF(i.slot <> 6, CAST(i.part AS STRING), NULL),
  'item_name', IF(i.slot = 6 AND i.part % 5 = 0, NULL, 'Part ' || i.part),
  'item_brand', 'Brand#' || i.part % 25,
  'item_variant', 'V' || i.part % 3,
  'item_category', 'Category ' || i.part % 10,
  'item_category2', 'Sub ' || i.part % 4,
  'item_category3', CAST(NULL AS STRING),
  'item_category4', CAST(NULL AS STRING),
  'item_category5', CAST(NULL AS STRING),
  'price', {CENTS} / 100D,
  'quantity', i.qty,
  'item_revenue', IF(i.part % 3 <> 0, {CENTS} * i.qty * 90 / 10000D, NULL))"""

EMPTY_BASKET = "array_repeat(named_struct('slot', 0, 'part', 0L, 'qty', 0L), 0)"


def _param(key: str, when: str, **typed: str) -> str:
    kinds = {"string_value": "STRING", "int_value": "BIGINT", "float_value": "DOUBLE", "double_value": "DOUBLE"}
    slots = ", ".join(f"'{slot}', CAST({typed.get(slot, 'NULL')} AS {kind})" for slot, kind in kinds.items())
    return f"IF({when}, named_struct('key', '{key}', 'value', named_struct({slots})), NULL)"


WEB_PARAMS = ", ".join([
    _param("ga_session_id", "k % 11 <> 0", int_value="sid"),
    _param("ga_session_number", "true", int_value="bucket"),
    _param("page_location", "k % 2 = 0", string_value="'/page/' || k"),
    _param("page_referrer", "k % 3 = 0", string_value="'/from/' || k % 7"),
    _param("page_title", "true", string_value="'Title ' || k % 10"),
    _param("transaction_id", "event_type = 'purchase' AND k % 7 <> 0", string_value="'T' || event_id"),
    _param("currency", "event_type = 'purchase'", string_value="'USD'"),
    _param("value", "event_type = 'purchase'",
           int_value="IF(k % 13 = 0, value, NULL)",
           float_value="IF(k % 13 <> 0 AND k % 5 = 0, value, NULL)",
           double_value="IF(k % 13 <> 0 AND k % 5 <> 0, value, NULL)"),
])


def homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return customer.join(places, customer.c_nationkey == places.n_nationkey, "left")


def web_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of the web events: an event beside one line of its order. Both sides of the join are exchanged by the
    order alone, so an order with many lines is split."""
    return web_events(spark, sf_dir, items="rows")


def web_events(spark: SparkSession, sf_dir: str, items: bool | str = False, geo: bool = False) -> DataFrame:
    """Nested web events. ``items`` and ``geo`` add the joins only their readers need.

    Items are an array (True), just counted ("count"), or rows ("rows": ``web_item_rows``).
    """
    name = f"""CASE event_type WHEN 'view' THEN 'view_item' WHEN 'click' THEN 'add_to_cart'
                 WHEN 'signup' THEN 'begin_checkout'
                 WHEN 'error' THEN {pick('k', 'scroll', 'click', 'page_view', 'page_view')}
                 ELSE event_type END"""
    e = numbered_events(
        spark, sf_dir,
        "date_format(ts, 'yyyyMMdd') AS day",
        "floor(datediff(CAST(ts AS DATE), DATE'2024-01-01') / 3) + 1 AS bucket",
    ).selectExpr("*", "floor(user_id / 2) * 1000 + bucket AS sid")
    if geo:
        home = homes(spark, sf_dir)
        e = e.join(home, e.user_id == home.c_custkey, "left")
    else:
        e = e.selectExpr("*", "CAST(NULL AS STRING) AS r_name", "CAST(NULL AS STRING) AS n_name",
                         "CAST(NULL AS INT) AS n_nationkey", "CAST(NULL AS STRING) AS c_mktsegment")
    items_column = f"transform(IF(k % 10 = 9, slice(basket, 1, 0), basket), i -> {WEB_ITEM}) AS items"
    if items == "rows":
        lines = order_lines(spark, sf_dir)
        e, items_column = e.filter("k % 10 <> 9").join(lines, e.event_id == lines.l_orderkey), f"{WEB_ITEM} AS item"
    elif items == "count":
        counts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"))
        e = e.join(counts, e.event_id == counts.l_orderkey, "left")
        items_column = "IF(k % 10 = 9, 0L, coalesce(n_lines, 0L)) AS item_count"
    elif items:
        folded = line_baskets(spark, sf_dir)
        e = e.join(folded, e.event_id == folded.l_orderkey, "left")
    else:
        e = e.selectExpr("*", f"{EMPTY_BASKET} AS basket")
    return e.selectExpr(
        "day AS event_suffix",
        "day AS event_date",
        "micros AS event_timestamp",
        f"{name} AS event_name",
        "CAST(user_id AS STRING) AS user_pseudo_id",
        f"{pick('k', 'WEB', 'IOS', 'ANDROID')} AS platform",
        f"""named_struct(
              'operating_system', {pick('k', 'Windows', 'Macintosh', 'iOS', 'Android')},
              'category', {pick('k', 'desktop', 'mobile')},
              'mobile_brand_name', {pick('k', 'Apple', 'Google', 'Samsung', 'Huawei', None)},
              'web_info', named_struct('browser', {pick('k', 'Chrome', 'Safari', 'Edge')})) AS device""",
        """named_struct('continent', r_name, 'sub_continent', r_name, 'country', n_name,
                        'region', 'R' || n_nationkey, 'city', c_mktsegment) AS geo""",
        f"""named_struct('source', {pick('k', 'google', '(direct)', 'newsletter', None)},
                         'medium', {pick('k', 'organic', 'cpc', '(none)')},
                         'name', {pick('k', '(organic)', 'spring', 'summer', 'autumn', 'winter', None)}) AS traffic_source""",
        f"""CASE WHEN k = 99 THEN NULL WHEN k = 49 THEN slice(array_compact(array({WEB_PARAMS})), 1, 0)
                 ELSE array_compact(array({WEB_PARAMS})) END AS event_params""",
        items_column,
    )


PRODUCT = f"""named_struct('id', CAST(i.part AS INT), 'name', 'Part ' || i.part,
                           'category', 'Category ' || i.part % 10, 'price', {CENTS} / 100D)"""
ITEM_OF_ORDER = f"named_struct('product', {PRODUCT}, 'quantity', CAST(i.qty AS INT))"


def _commerce_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered events with the customer's home, their kind and a time stamp."""
    home = homes(spark, sf_dir)
    e = numbered_events(
        spark, sf_dir,
        "date_format(ts, 'yyyyMMdd') AS day",
        """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss") AS stamp""",
    )
    return e.join(home, e.user_id == home.c_custkey, "left").selectExpr(
        "*",
        "event_type = 'purchase' AS bought",
        f"""CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'cart_add'
              WHEN 'signup' THEN 'checkout_start' WHEN 'purchase'
              THEN {pick('k', 'order_create', 'order_paid', 'order_paid', 'order_fulfilled', 'order_cancelled')}
              ELSE 'cart_abandon' END AS kind""",
        "coalesce(c_nationkey % 4, 0) + 5 AS rate",
        "500 + k * 10 AS shipping",
    )


def _commerce_columns(product: str, cart_items: str, order_items: str) -> list[str]:
    """The event layout over rows with a ``subtotal``; the arguments are SQL, empty for a list that is left out."""
    cart_list, order_list = (f"'items', {x}," if x else "" for x in (cart_items, order_items))
    tax = "floor((subtotal * rate + 50) / 100)"
    return [
        "IF(event_id % 97 <> 0, 'E' || event_id, NULL) AS event_id",
        "kind AS event_type",
        "'S' || user_id || '-' || day AS session_id",
        "IF(event_id % 50 = 0, stamp, stamp || '.' || lpad(CAST(pmod(micros, 1000000) AS STRING), 6, '0')) AS event_timestamp",
        """named_struct('customer_id', CAST(user_id AS INT), 'first_name', 'Customer', 'last_name', substring(c_name, 10),
                        'email', 'c' || user_id || '@example.com', 'country', n_name,
                        'created_at', '2025-12-01T00:00:00.000Z', 'tax_rate', rate / 100D) AS customer""",
        f"""named_struct('channel', {pick('k', 'Google', 'Facebook', 'Email', 'Direct')},
                         'device', {pick('k', 'mobile', 'desktop', 'tablet')}) AS session""",
        *([f"IF(event_type = 'view', {product}, NULL) AS product"] if product else []),
        f"""IF(event_type IN ('click', 'signup', 'error') OR (bought AND k % 20 = 2),
              named_struct('cart_id', 'C' || event_id, {cart_list} 'created_at', stamp), NULL) AS cart""",
        # Some orders state an empty list next to a filled cart; every tenth total is one unit too high.
        f"""IF(bought, named_struct(
             'order_id', 'O' || event_id, 'customer_id', CAST(user_id AS INT), {order_list}
             'subtotal', subtotal / 100D, 'tax', {tax} / 100D, 'tax_rate', rate / 100D, 'shipping', shipping / 100D,
             'total_amount', (subtotal + {tax} + shipping + IF(k % 10 = 3, 100, 0)) / 100D,
             'currency', 'USD', 'status', 'fulfilled', 'created_at', stamp,
             'paid_at', IF(kind <> 'order_create', stamp, NULL),
             'fulfilled_at', IF(kind = 'order_fulfilled', stamp, NULL),
             'cancelled_at', IF(kind = 'order_cancelled', stamp, NULL),
             'cancel_reason', IF(kind = 'order_cancelled', 'changed mind', NULL)), NULL) AS order""",
        f"IF(event_type = 'error', {pick('k', 'cart', 'checkout')}, NULL) AS abandon_stage",
    ]


def commerce_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested commerce events; order amounts are whole cents until the last step."""
    folded = part_baskets(spark, sf_dir)
    e = _commerce_base(spark, sf_dir)
    e = e.join(folded, e.event_id == folded.l_orderkey, "left").selectExpr(
        "*",
        f"transform(basket, i -> {ITEM_OF_ORDER}) AS lines",
        f"aggregate(coalesce(basket, {EMPTY_BASKET}), 0L, (total, i) -> total + {CENTS} * i.qty) AS subtotal",
    )
    return e.selectExpr(*_commerce_columns("get(lines, 0).product", "lines", "IF(k % 20 = 2, slice(lines, 1, 0), lines)"))


def commerce_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of the commerce events: an event beside one item of the list that counts, or beside none.

    Amounts come from sums per order and items from a join by the order, so no order's parts meet in an array.
    """
    parts = order_parts(spark, sf_dir)
    sums = parts.groupBy("l_orderkey").agg(F.expr(f"sum({CENTS} * i.qty) AS cents"), F.min("i").alias("first"))
    e = _commerce_base(spark, sf_dir)
    e = e.join(sums.withColumnRenamed("l_orderkey", "o"), e.event_id == F.col("o"), "left").selectExpr(
        "*", "coalesce(cents, 0L) AS subtotal",
        # Orders with an empty list have no item, views one, all others those of the order.
        "cents IS NOT NULL AND event_type <> 'view' AND NOT (bought AND k % 20 = 2) AS listed",
    )
    columns = _commerce_columns("", "", "")
    many = e.filter("listed").join(parts, F.col("event_id") == F.col("l_orderkey")).selectExpr(
        *columns, f"{ITEM_OF_ORDER} AS item")
    lone = e.filter("NOT listed").withColumn("i", F.expr("IF(event_type = 'view', first, NULL)")).selectExpr(
        *columns, f"IF(i IS NOT NULL, named_struct('product', {PRODUCT}, 'quantity', 1), NULL) AS item")
    return many.unionByName(lone)


def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status documents: one per event, holding two stations, or none when k is a multiple of 17."""
    e = numbered_events(
        spark, sf_dir,
        "date_format(ts, 'yyyy/MM/dd/') AS folder",
        "date_format(ts, 'HHmmss') || '.json' AS file",
    )
    stations = table(spark, sf_dir, "supplier").agg(F.max("s_suppkey") + 3).scalar()

    def reading(station: str, shift: int) -> str:
        return f"""named_struct(
          'station_id', CAST({station} % stations AS STRING),
          'num_bikes_available_types', named_struct('electric', IF(k % 9 <> 0, CAST(k + {shift} AS BIGINT), NULL),
                                                    'classic', IF(k % 8 <> 0, CAST(100 - k AS BIGINT), NULL)),
          'num_bikes_available', CAST(k + 100 AS BIGINT), 'num_docks_available', CAST(k % 15 AS BIGINT),
          'last_reported', CAST(floor(micros / 1000000 - {shift}) AS BIGINT))"""

    pair = f"array({reading('event_id', 0)}, {reading('(event_id * 7 + 3)', 60)})"
    return e.withColumn("stations", stations).selectExpr(
        "'raw/status/' || IF(k = 97, 'undated/xx/yy/', folder) || file AS source_file",
        f"named_struct('stations', IF(k % 17 = 0, slice({pair}, 1, 0), {pair})) AS data",
    )


def station_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata documents, one station each."""
    return table(spark, sf_dir, "supplier").selectExpr(
        """named_struct('stations', array(named_struct(
             'station_id', CAST(s_suppkey AS STRING), 'name', s_name, 'address', s_suppkey || ' Main St',
             'lat', 40D + (s_suppkey % 100) / 100D, 'lon', -111D - (s_suppkey % 100) / 100D))) AS data"""
    )


def trips_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips with text times; one k in a hundred each is undated, too short, or in the wrong folder."""
    minutes = "3 * (CAST(get_json_object(props, '$.k') AS INT) - 5)"
    e = numbered_events(
        spark, sf_dir,
        "CAST(ts AS STRING) AS pickup",
        f"CAST(ts + make_dt_interval(0, 0, {minutes}, 0) AS STRING) AS dropoff",
    )
    return e.selectExpr(
        "event_id % 2 + 1 AS VendorID",
        "pickup AS tpep_pickup_datetime",
        """CASE WHEN k = 60 THEN NULL WHEN k = 7 THEN CAST(ts + INTERVAL 30 SECONDS AS STRING)
                ELSE dropoff END AS tpep_dropoff_datetime""",
        "CAST(k % 6 AS DOUBLE) AS passenger_count",
        "IF(k % 2 = 0, value - 20, value) AS trip_distance",
        "1D AS RatecodeID",
        "'N' AS store_and_fwd_flag",
        "user_id % 27 AS PULocationID",
        "event_id % 27 AS DOLocationID",
        "CAST(k % 4 AS BIGINT) AS payment_type",
        "value * 0.8D AS fare_amount",
        "value * 0.1D AS tip_amount",
        "value - 30 AS total_amount",
        "year(ts) AS year",
        "month(ts) + IF(k = 50, 1, 0) AS month",
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").selectExpr(
        "CAST(n_nationkey AS STRING) AS LocationID", "r_name AS Borough", "n_name AS Zone",
        f"{pick('n_nationkey', 'Yellow Zone', 'Boro Zone', 'Airports')} AS service_zone",
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather row per day trips were taken on, except days 29 and later."""
    days = table(spark, sf_dir, "events").selectExpr("CAST(ts AS DATE) AS d", "day(ts) AS n").distinct()
    return days.filter("n < 29").selectExpr(
        "CAST(d AS STRING) AS date",
        "CAST(n - 10 AS STRING) AS tmin_c",
        "CAST(n + IF(n = 13, 100, 0) AS STRING) AS tmax_c",
        "CAST(n % 5 * 2 AS STRING) AS prcp_mm",
        "IF(n % 10 = 0, '-1', CAST(n % 3 AS STRING)) AS snow_mm",
        "CAST(year(d) AS STRING) AS year",
        "CAST(month(d) AS STRING) AS month",
    )
