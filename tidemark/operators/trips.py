"""Trip lakehouse: bronze trips, weather and zones to silver, quarantine and daily KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import safe_divide, steady_avg, steady_sum

MIN_MINUTES, MAX_MINUTES = 1, 240

# A trip is plausible when its length, distance and amount are, and it started in the month of its folder.
PLAUSIBLE = f"""
  trip_minutes BETWEEN {MIN_MINUTES} AND {MAX_MINUTES} AND trip_distance > 0 AND total_amount > 0
  AND pickup_year = year AND pickup_month = month
"""

# Quarantine reasons in order of precedence; the first that holds is reported.
QUARANTINE_RULES = [
    ("NULL_TIMESTAMP", "pickup_ts IS NULL OR dropoff_ts IS NULL"),
    ("NEGATIVE_OR_ZERO_DURATION", "trip_minutes <= 0"),
    ("DURATION_TOO_LONG", f"trip_minutes > {MAX_MINUTES}"),
    ("NONPOSITIVE_DISTANCE", "trip_distance <= 0"),
    ("NONPOSITIVE_TOTAL_AMOUNT", "total_amount <= 0"),
    ("EVENT_TIME_OUTSIDE_SOURCE_PARTITION", "pickup_year <> year OR pickup_month <> month"),
]

# Published name -> (bronze name, type) of the measures both outputs carry.
MEASURES = {
    "pickup_location_id": ("PULocationID", "int"),
    "dropoff_location_id": ("DOLocationID", "int"),
    "passenger_count": ("passenger_count", "int"),
    "trip_distance": ("trip_distance", "double"),
    "fare_amount": ("fare_amount", "double"),
    "tip_amount": ("tip_amount", "double"),
    "total_amount": ("total_amount", "double"),
}
WEATHER_CONTEXT = ["min_temp_c", "max_temp_c", "rain_mm", "is_rain", "is_snow"]


def with_trip_times(bronze: DataFrame) -> DataFrame:
    """Parse both ends of a trip and derive its day, calendar parts and length in minutes."""
    ends = bronze.withColumns({
        "pickup_ts": F.try_to_timestamp("tpep_pickup_datetime"),
        "dropoff_ts": F.try_to_timestamp("tpep_dropoff_datetime"),
    })
    seconds = F.unix_timestamp("dropoff_ts") - F.unix_timestamp("pickup_ts")
    return ends.withColumns({
        "pickup_date": F.to_date("pickup_ts"),
        "pickup_hour": F.hour("pickup_ts"),
        "pickup_year": F.year("pickup_ts"),
        "pickup_month": F.month("pickup_ts"),
        "trip_minutes": seconds / F.lit(60.0),
    })


def _measures(*names: str) -> list[Column]:
    return [F.col(MEASURES[name][0]).cast(MEASURES[name][1]).alias(name) for name in names]


def trips_silver(bronze: DataFrame) -> DataFrame:
    """Plausible trips in the published 14-column layout."""
    return with_trip_times(bronze).filter(PLAUSIBLE).select(
        "pickup_ts", "dropoff_ts", "pickup_date", "pickup_hour", *_measures(*MEASURES), "trip_minutes", "year", "month"
    )


def quarantine_reason() -> Column:
    return F.coalesce(*[F.when(F.expr(condition), name) for name, condition in QUARANTINE_RULES])


def trips_quarantine(bronze: DataFrame, detected_at: bool = True) -> DataFrame:
    """Implausible trips with the first rule each one breaks."""
    broken = with_trip_times(bronze).withColumn("dq_reason", quarantine_reason()).filter("dq_reason IS NOT NULL")
    detected = [F.current_timestamp().alias("dq_detected_ts")] if detected_at else []
    return broken.select(
        "pickup_ts", "dropoff_ts", "pickup_date", "pickup_year", "pickup_month", "year", "month", "dq_reason",
        *detected,
        *_measures(*[name for name in MEASURES if name != "passenger_count"]),
        "trip_minutes",
    )


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Rows per quarantine reason, most frequent first."""
    return (
        quarantine.groupBy("dq_reason").agg(F.count("*").alias("rows"))
        .orderBy(F.col("rows").desc(), F.col("dq_reason"))
    )


def trip_reconciliation(bronze: DataFrame) -> DataFrame:
    """Where bronze rows end up. Very short trips and NULL measures end up in neither output."""
    kept, held = F.coalesce(F.expr(PLAUSIBLE), F.lit(False)), quarantine_reason().isNotNull()
    return with_trip_times(bronze).agg(
        F.count("*").alias("bronze_rows"),
        F.count_if(kept).alias("silver_rows"),
        F.count_if(held).alias("quarantine_rows"),
        F.count_if(~kept & ~held).alias("unaccounted_rows"),
    )


def weather_bronze(raw: DataFrame) -> DataFrame:
    """Raw weather rows with integer partitions and the time they were taken in."""
    return raw.withColumns({
        "year": F.col("year").cast("int"),
        "month": F.col("month").cast("int"),
        "ingest_ts": F.current_timestamp(),
    })


def partition_counts(table: DataFrame, rows: str = "trips") -> DataFrame:
    """Rows per (year, month), in calendar order."""
    return table.groupBy("year", "month").agg(F.count("*").alias(rows)).orderBy("year", "month")


def weather_daily(bronze: DataFrame) -> DataFrame:
    """Weather days with plausible readings; a missing or malformed reading drops the day."""
    def number(name: str) -> Column:
        return F.col(name).try_cast("double")

    typed = bronze.withColumns({
        "date": F.col("date").try_cast("date"),
        "min_temp_c": number("tmin_c"),
        "max_temp_c": number("tmax_c"),
        "rain_mm": number("prcp_mm"),
        "snow_mm": number("snow_mm"),
    })
    plausible = (
        "date IS NOT NULL AND min_temp_c BETWEEN -50 AND 50 AND max_temp_c BETWEEN -50 AND 60 "
        "AND rain_mm >= 0 AND snow_mm >= 0"
    )
    return typed.filter(plausible).withColumns({"is_rain": F.col("rain_mm") > 0, "is_snow": F.col("snow_mm") > 0})


def dim_zone(lookup: DataFrame) -> DataFrame:
    """Typed zone lookup."""
    return lookup.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").cast("string").alias("borough"),
        F.col("Zone").cast("string").alias("zone"),
        F.col("service_zone").cast("string").alias("service_zone"),
    )


AVERAGES = {
    "avg_fare": "fare_amount",
    "avg_tip": "tip_amount",
    "avg_distance": "trip_distance",
    "avg_duration": "trip_minutes",
}


def city_daily_kpis(silver: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips, revenue and averages per day with the day's weather."""
    daily = silver.groupBy("pickup_date", "year", "month").agg(
        F.count("*").alias("trips"),
        steady_sum("total_amount").alias("revenue"),
        *[steady_avg(measure).alias(name) for name, measure in AVERAGES.items()],
    )
    return daily.withColumnRenamed("pickup_date", "date").join(
        weather.select("date", *WEATHER_CONTEXT), "date", "left"
    ).select(
        "date", "min_temp_c", "max_temp_c", "trips", "revenue", *AVERAGES,
        "rain_mm", "is_rain", "is_snow", "year", "month",
    )


def zone_daily_kpis(silver: DataFrame, zones: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips, revenue and averages per day and pickup zone with the day's weather.

    Trips are reduced to sums and counts per location before the zone is looked
    up: only reduced rows take part in the join, whatever the size of the zone
    table and however popular one zone is. Unknown locations form a NULL zone.
    """
    totals = {name: (f"_sum_{name}", f"_n_{name}") for name in AVERAGES}
    per_location = silver.groupBy("pickup_date", "year", "month", "pickup_location_id").agg(
        F.count("*").alias("trips"),
        F.sum("total_amount").alias("revenue"),
        *[F.sum(AVERAGES[name]).alias(total) for name, (total, _) in totals.items()],
        *[F.count(AVERAGES[name]).alias(n) for name, (_, n) in totals.items()],
    )
    per_zone = (
        per_location.join(zones, F.col("pickup_location_id") == F.col("location_id"), "left")
        .groupBy("pickup_date", "year", "month", "borough", "zone", "service_zone")
        .agg(
            F.sum("trips").alias("trips"),
            steady_sum("revenue").alias("revenue"),
            *[safe_divide(steady_sum(total), F.sum(n)).alias(name) for name, (total, n) in totals.items()],
        )
    )
    return per_zone.withColumnRenamed("pickup_date", "date").join(
        weather.select("date", *WEATHER_CONTEXT), "date", "left"
    ).select(
        "date", "borough", "zone", "service_zone", "trips", "revenue", *AVERAGES, *WEATHER_CONTEXT, "year", "month"
    )


def city_daily_simple(silver: DataFrame) -> DataFrame:
    """Daily totals and averages without weather."""
    return silver.groupBy("pickup_date").agg(
        F.count("*").alias("total_trips"),
        steady_sum("total_amount").alias("total_revenue"),
        *[steady_avg(measure).alias(name) for name, measure in AVERAGES.items()],
    ).orderBy("pickup_date")


def zone_daily_simple(silver: DataFrame) -> DataFrame:
    """Daily demand per pickup location."""
    return silver.groupBy("pickup_date", "pickup_location_id").agg(
        F.count("*").alias("trip_count"),
        steady_sum("total_amount").alias("revenue"),
        steady_avg("trip_distance").alias("avg_distance"),
    )


def preview(table: DataFrame, rows: int = 10) -> DataFrame:
    """First few rows, for looking at a new table."""
    return table.limit(rows)
