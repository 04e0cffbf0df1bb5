"""Holiday and weather records landed as JSON, and the plan of what to request."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field names of the two JSON payloads.
HOLIDAY_JSON = (
    "date string, localName string, name string, countryCode string, global boolean, "
    "counties array<string>, launchYear bigint, types array<string>"
)
WEATHER_JSON = (
    "lat double, lon double, tz string, date string, units string, "
    "cloud_cover struct<afternoon: double>, humidity struct<afternoon: double>, "
    "precipitation struct<total: double>, "
    "temperature struct<min: double, max: double, afternoon: double, night: double, "
    "evening: double, morning: double>, "
    "pressure struct<afternoon: double>, "
    "wind struct<max: struct<speed: double, direction: double>>"
)


@dataclass(frozen=True)
class WeatherLocation:
    """Configured location; fills in what a record leaves out."""

    location_key: str
    latitude: float
    longitude: float
    timezone: str | None = None
    units: str = "metric"


def country_code(value: str) -> str:
    """Two-letter country code in upper case."""
    code = value.strip().upper()
    if not re.fullmatch(r"[A-Z]{2}", code):
        raise ValueError(f"holiday country {value!r}: expected two letters, such as BR")
    return code


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def json_text(items: Column) -> Column:
    """Text array as a JSON list with a blank after each comma; NULL stays NULL."""
    quoted = F.transform(
        items, lambda item: F.regexp_replace(F.to_json(F.array(item)), r"^\[|\]$", "")
    )
    return F.when(
        items.isNotNull(), F.concat(F.lit("["), F.array_join(quoted, ", ", "null"), F.lit("]"))
    )


def normalize_holidays(records: DataFrame, first: date, last: date) -> DataFrame:
    """Holiday records of a window in raw shape. A malformed date is an error."""
    day = F.col("date").cast("date")
    return records.select(
        day.alias("holiday_date"),
        F.col("localName").alias("local_name"),
        F.col("name").alias("holiday_name"),
        F.col("countryCode").alias("country_code"),
        F.col("global").alias("is_global"),
        json_text(F.col("counties")).alias("counties_json"),
        json_text(F.col("types")).alias("holiday_types_json"),
        F.col("launchYear").alias("launch_year"),
    ).filter(F.col("holiday_date").between(first, last))


def normalize_weather(records: DataFrame, location: WeatherLocation) -> DataFrame:
    """Weather records in raw shape, one column per measure."""

    def given(column: str, default: object) -> Column:
        return F.coalesce(F.col(column), F.lit(default))

    return records.select(
        F.col("date").cast("date").alias("weather_date"),
        F.lit(location.location_key).alias("location_key"),
        given("lat", location.latitude).alias("latitude"),
        given("lon", location.longitude).alias("longitude"),
        given("tz", location.timezone).alias("timezone"),
        given("units", location.units).alias("units"),
        F.col("cloud_cover.afternoon").alias("cloud_cover_afternoon"),
        F.col("humidity.afternoon").alias("humidity_afternoon"),
        F.col("precipitation.total").alias("precipitation_total"),
        *[
            F.col(f"temperature.{part}").alias(f"temperature_{part}")
            for part in ("min", "max", "afternoon", "night", "evening", "morning")
        ],
        F.col("pressure.afternoon").alias("pressure_afternoon"),
        F.col("wind.max.speed").alias("wind_max_speed"),
        F.col("wind.max.direction").alias("wind_max_direction"),
    )


def request_plan(
    windows: DataFrame, locations: Sequence[str], landed: DataFrame | None = None
) -> DataFrame:
    """Day and location pairs still to be requested.

    ``windows`` has ``weather_window_start_date`` and ``..._end_date``; overlapping
    windows ask for a day once, and days already landed are left out.
    """
    start, end = F.col("weather_window_start_date"), F.col("weather_window_end_date")
    places = F.array(*[F.lit(place) for place in locations])
    days = (
        windows.filter(start.isNotNull() & end.isNotNull())
        .select(F.explode(F.sequence(start, end)).alias("weather_date"))
        .distinct()
    )
    wanted = days.select("weather_date", F.explode(places).alias("location_key"))
    if landed is not None:
        wanted = wanted.join(
            landed.select("weather_date", "location_key"), ["weather_date", "location_key"], "left_anti"
        )
    return wanted


def call_count(first: date, last: date, locations: int = 1) -> int:
    """Requests for an inclusive range of days."""
    if last < first:
        raise ValueError("the range ends before it starts")
    if locations < 1:
        raise ValueError("at least one location is needed")
    return ((last - first).days + 1) * locations


def require_budget(first: date, last: date, budget: int, locations: int = 1) -> int:
    calls = call_count(first, last, locations)
    if calls > budget:
        raise ValueError(f"{calls} weather calls exceed the budget of {budget}")
    return calls
