"""Scalar and array expressions. Everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def event_key(user="user_pseudo_id", micros="event_timestamp", name="event_name") -> Column:
    """Hex SHA-256 of ``user|micros|name``; NULL as soon as one part is NULL."""
    text = F.concat(_col(user), F.lit("|"), _col(micros).cast("string"), F.lit("|"), _col(name))
    return F.sha2(text, 256)


def parse_day(text: Column | str) -> Column:
    """``yyyyMMdd`` to DATE; a malformed string fails the query."""
    return F.to_date(_col(text), "yyyyMMdd")


def try_parse_day(text: Column | str) -> Column:
    """``yyyyMMdd`` to DATE; a malformed string gives NULL."""
    return F.try_to_timestamp(_col(text), F.lit("yyyyMMdd")).cast("date")


def parse_iso_timestamp(text: Column | str) -> Column:
    """ISO timestamp with or without a six-digit fraction; NULL when malformed.

    Writers that print timestamps drop the fraction when it is exactly zero, so
    a pattern that insists on it would lose one event in a million.
    """
    return F.try_to_timestamp(_col(text), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that gives NULL for a zero denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def sunday_of(day: Column | str) -> Column:
    """The Sunday on or before ``day`` (Spark's own week truncation is Monday)."""
    day = _col(day)
    return F.date_sub(day, F.dayofweek(day) - 1)


def has_elements(array: Column | str) -> Column:
    """True for a non-empty array; NULL and empty arrays are both False."""
    return F.coalesce(F.size(_col(array)) > 0, F.lit(False))


def array_fields(array: str, *fields: str) -> Column:
    """The same array of structs with only ``fields``, for use in front of a generator.

    A generator hands on whole elements, so every field of them is read from the
    file; picking the fields first lets the scan skip the others.
    """
    return F.arrays_zip(*[F.col(f"{array}.{field}").alias(field) for field in fields])


def element_count(array: str, field: str) -> Column:
    """Number of elements, 0 for a NULL array, reading only ``field`` of them."""
    return F.coalesce(F.greatest(F.size(array_fields(array, field)), F.lit(0)), F.lit(0)).cast("bigint")


def item_count(events: DataFrame) -> Column:
    """Items of an event: as stated by a column of that name, or counted in its array."""
    return F.col("item_count") if "item_count" in events.columns else element_count("items", "item_id")


def param_max(key: str, *fields: str, params: Column | str = "event_params") -> Column:
    """Greatest value stored under ``key``, read inside the row.

    ``fields`` lists the typed slots to try in order for every entry. Doing this
    before any exchange means one row per event is shuffled, never one row per
    event and parameter.
    """
    # Other entries give NULL, which the maximum passes over; no array of the matching ones is built first.
    return F.array_max(F.transform(
        _col(params), lambda p: F.when(p["key"] == key, F.coalesce(*[p["value"][f] for f in fields]))))


def first_param(key: str, field: str, params: Column | str = "event_params") -> Column:
    """Value of the first entry stored under ``key`` (scalar lookup in an array)."""
    matching = F.filter(_col(params), lambda p: p["key"] == key)
    return F.get(matching, F.lit(0))["value"][field]


def steady_sum(value: Column | str) -> Column:
    """Sum of doubles to the millionth.

    The digits below depend on the order rows arrive in; settling them once per
    group keeps a re-run after a lost executor, and every ratio built on the
    sum, at the same value.
    """
    return F.round(F.sum(_col(value)), 6)


def steady_avg(value: Column | str) -> Column:
    """Mean of doubles on top of ``steady_sum``; NULL for a group without values."""
    return safe_divide(steady_sum(value), F.count(_col(value)))
