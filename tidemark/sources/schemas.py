"""Input contracts, written as DDL so they read like the files they describe.

The field names and types below are fixed values: they must equal the layout of
the incoming files.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

WEB_EVENT_DDL = """
  event_date STRING, event_timestamp BIGINT, event_name STRING,
  user_pseudo_id STRING, platform STRING,
  device STRUCT<operating_system: STRING, category: STRING, mobile_brand_name: STRING,
                web_info: STRUCT<browser: STRING>>,
  geo STRUCT<continent: STRING, sub_continent: STRING, country: STRING, region: STRING, city: STRING>,
  traffic_source STRUCT<source: STRING, medium: STRING, name: STRING>,
  event_params ARRAY<STRUCT<key: STRING,
                            value: STRUCT<string_value: STRING, int_value: BIGINT,
                                          float_value: DOUBLE, double_value: DOUBLE>>>,
  items ARRAY<STRUCT<item_id: STRING, item_name: STRING, item_brand: STRING, item_variant: STRING,
                     item_category: STRING, item_category2: STRING, item_category3: STRING,
                     item_category4: STRING, item_category5: STRING,
                     price: DOUBLE, quantity: BIGINT, item_revenue: DOUBLE>>
"""

_PRODUCT = "STRUCT<id: INT, name: STRING, category: STRING, price: DOUBLE>"
_LINES = f"ARRAY<STRUCT<product: {_PRODUCT}, quantity: INT>>"

COMMERCE_EVENT_DDL = f"""
  event_id STRING, event_type STRING, session_id STRING, event_timestamp STRING,
  customer STRUCT<customer_id: INT, first_name: STRING, last_name: STRING, email: STRING,
                  country: STRING, created_at: STRING, tax_rate: DOUBLE>,
  session STRUCT<channel: STRING, device: STRING>,
  product {_PRODUCT},
  cart STRUCT<cart_id: STRING, items: {_LINES}, created_at: STRING>,
  order STRUCT<order_id: STRING, customer_id: INT, items: {_LINES},
               subtotal: DOUBLE, tax: DOUBLE, tax_rate: DOUBLE, shipping: DOUBLE, total_amount: DOUBLE,
               currency: STRING, status: STRING, created_at: STRING, paid_at: STRING,
               fulfilled_at: STRING, cancelled_at: STRING, cancel_reason: STRING>,
  abandon_stage STRING
"""

STATION_STATUS_DDL = """
  data STRUCT<stations: ARRAY<STRUCT<station_id: STRING,
                                     num_bikes_available_types: STRUCT<electric: BIGINT, classic: BIGINT>,
                                     num_bikes_available: BIGINT, num_docks_available: BIGINT,
                                     last_reported: BIGINT>>>
"""

STATION_INFO_DDL = """
  data STRUCT<stations: ARRAY<STRUCT<station_id: STRING, name: STRING, address: STRING,
                                     lat: DOUBLE, lon: DOUBLE>>>
"""

TRIP_DDL = """
  VendorID BIGINT, tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING,
  passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID DOUBLE, store_and_fwd_flag STRING,
  PULocationID BIGINT, DOLocationID BIGINT, payment_type BIGINT,
  fare_amount DOUBLE, tip_amount DOUBLE, total_amount DOUBLE
"""

WEATHER_DDL = "date STRING, tmin_c STRING, tmax_c STRING, prcp_mm STRING, snow_mm STRING"

ZONE_DDL = "LocationID STRING, Borough STRING, Zone STRING, service_zone STRING"


def parse(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)
