"""Results of agent tools as Column expressions: local time, weather texts, outcomes."""

from __future__ import annotations

import zoneinfo
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from turnmill import fixed


@lru_cache(maxsize=1)
def _zones() -> tuple[str, ...]:
    """Zone names known to the time-zone database and to the JVM (a few hundred)."""
    spark = SparkSession.active()
    known = set(spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds())
    return tuple(sorted(zoneinfo.available_timezones() & known))


def local_time(ts: Column, zone: Column) -> Column:
    """UTC time ``ts`` (without zone) as local date, time and weekday, or a failure text.

    The zone is checked first, because a zone the JVM does not know would fail the job.
    """
    known = zone.isin(*_zones())
    local = F.convert_timezone(F.lit("UTC"), F.when(known, zone).otherwise("UTC"), ts)
    # Casts of a time without zone do not depend on the zone of the session.
    weekday = F.element_at(F.array(*map(F.lit, fixed.WEEKDAYS)), F.weekday(local.cast("date")) + 1)
    shown = F.concat(F.substring(local.cast("string"), 1, 19), F.lit(" "), weekday)
    missing = F.concat(
        F.lit(fixed.TIME_FAILED + "'No time zone found with key "), F.coalesce(zone, F.lit("None")), F.lit("'")
    )
    return F.when(known, shown).otherwise(missing)


def outcome(text: Column) -> Column:
    """Class of a tool result by how it begins."""
    chain = F.when(text.isNull(), "ok")
    for prefix, name in fixed.OUTCOME_PREFIXES:
        chain = chain.when(text.startswith(prefix), name)
    return chain.otherwise("ok")


def status_outcome(status: Column) -> Column:
    return (
        F.when(status == 200, "ok")
        .when(status == 401, "bad_key")
        .when(status == 429, "rate_limited")
        .otherwise("failed")
    )


def status_text(status: Column, other: str) -> Column:
    """Text for a status other than 200."""
    return (
        F.when(status == 401, fixed.BAD_KEY)
        .when(status == 429, fixed.RATE_LIMITED)
        .otherwise(F.concat(F.lit(other), status.cast("string")))
    )


#: Reason given for a response that can't be read.
UNREADABLE = "unreadable response"

# Fields of the service responses. Numbers stay as they are written in the JSON.
_READING = (
    "main: struct<temp: string, feels_like: string, humidity: string>, "
    "weather: array<struct<description: string>>, dt_txt: string"
)
WEATHER = f"struct<{_READING}, list: array<struct<{_READING}>>>"
CITIES = "array<struct<name: string, country: string, local_names: map<string, string>>>"


def city_name(city: Column) -> Column:
    """The Chinese name if there is one, else the plain name."""
    return F.coalesce(F.try_element_at(city["local_names"], F.lit("zh")), city["name"])


def city_country(city: Column) -> Column:
    return F.coalesce(city["country"], F.lit(""))


def _readings(point: Column) -> list[Column]:
    main = point["main"]
    return [F.get(point["weather"], F.lit(0))["description"], main["temp"], main["feels_like"], main["humidity"]]


def readable(point: Column) -> Column:
    """Whether a reading has all its values."""
    held = F.lit(True)
    for value in _readings(point):
        held = held & value.isNotNull()
    return held


def forecast_point(points: Column, days: Column) -> Column:
    """The entry ``min(8 * days, last)`` of a forecast list."""
    return F.get(points, F.least(days * fixed.POINTS_PER_DAY, F.size(points) - 1))


def weather_text(
    location: Column,
    days: Column,
    geo_status: Column,
    cities: Column,
    city: Column,
    status: Column,
    now: Column,
    point: Column,
) -> Column:
    """What the weather tool answers for parsed geocoding and weather responses.

    A response that can't be read, or lacks what the text needs, is a failure.
    """
    failed = F.lit(fixed.WEATHER_FAILED + UNREADABLE)
    place = (city_name(city), city_country(city))
    current = F.format_string(fixed.CURRENT_TEXT, *place, *_readings(now))
    forecast = F.format_string(fixed.FORECAST_TEXT, *place, point["dt_txt"], *_readings(point))
    return (
        F.when(~days_ok(days), fixed.BAD_DAYS)
        .when(geo_status != 200, status_text(geo_status, fixed.GEO_STATUS))
        .when(cities.isNull(), failed)
        .when(city.isNull(), F.format_string(fixed.CITY_UNKNOWN, location))
        .when((days == 0) & (status == 200), F.when(readable(now), current).otherwise(failed))
        .when(days == 0, status_text(status, fixed.WEATHER_STATUS))
        .when(status == 200, F.when(readable(point) & point["dt_txt"].isNotNull(), forecast).otherwise(failed))
        .otherwise(status_text(status, fixed.FORECAST_STATUS))
    )


def days_ok(days: Column) -> Column:
    return days.between(0, fixed.MAX_FORECAST_DAYS)
