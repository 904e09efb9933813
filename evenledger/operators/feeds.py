"""Observation feeds: JSON bodies to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Units appended to the readings.
TEMPERATURE_UNIT = "°C"
WIND_UNIT = "km/h"
SHOWN_AS = "EEEE hh:mm a"


def string_list(c: Column) -> Column:
    """Comma-separated names, trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")


def observation_columns(df: DataFrame, body: str, city: str, zone: str = "+08:00") -> DataFrame:
    """(city, datetime, weather, temperature, wind) from the first result of each body.

    ``datetime`` is the update time shifted to ``zone`` and written as weekday and 12-hour time.
    """
    field = lambda path: F.get_json_object(body, f"$.results[0].{path}")
    instant = field("last_update").try_cast("timestamp")
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    # An NTZ value is formatted as it stands, whatever the session zone.
    local = F.from_utc_timestamp(utc, F.lit(zone)).cast("timestamp_ntz")
    return df.select(
        F.col(city).alias("city"),
        F.date_format(local, SHOWN_AS).alias("datetime"),
        field("now.text").alias("weather"),
        F.concat(field("now.temperature"), F.lit(TEMPERATURE_UNIT)).alias("temperature"),
        F.concat(field("now.wind_speed"), F.lit(WIND_UNIT)).alias("wind"),
    )
