"""The layered models, one function each: staging, then marts. Catalyst sees one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aerolith import fixed
from aerolith.functions import columns as C
from aerolith.operators.daily import (
    CITY_DAY, air_daily, pollutants_wide, weather_daily_latest, weather_daily_merged,
)

_PLACE = ["city_id", "city_name", "latitude", "longitude", "elevation_m"]


def stage_weather(
    hist: DataFrame, daily: DataFrame, stream: DataFrame | None = None
) -> DataFrame:
    """One feed of hourly rows from the backfill, the daily pull and, if given, the live stream."""
    staged = _stage_feed(hist, "historical").unionByName(_stage_feed(daily, "daily"))
    if stream is not None:
        staged = staged.unionByName(_stage_stream(stream))
    return staged


def _stage_feed(raw: DataFrame, kind: str) -> DataFrame:
    measures = [F.col(r).try_cast("double").alias(s) for r, s in fixed.HOURLY_MEASURES.items()]
    return raw.select(
        *_PLACE, "observation_ts", *measures, F.lit(kind).alias("source_kind"), "ingested_at"
    )


def _stage_stream(events: DataFrame) -> DataFrame:
    """Landed stream events; the measures a live sensor does not send are NULL."""
    events = events.withColumn("pressure_msl_hpa", F.col("pressure_hpa"))
    measures = [
        F.col(s) if s in events.columns else F.lit(None).cast("double").alias(s)
        for s in fixed.HOURLY_MEASURES.values()
    ]
    return events.select(
        *[c if c in events.columns else F.lit(None).cast("bigint").alias(c) for c in _PLACE],
        F.try_to_timestamp("observed_ts").alias("observation_ts"),
        *measures,
        F.lit("streaming").alias("source_kind"),
        F.col("consumed_at").alias("ingested_at"),
    )


def stage_air(raw: DataFrame) -> DataFrame:
    """Typed readings without the impossible ones, and with the unit-normalised value."""
    numbers = ["value", "min_value", "max_value", "avg_value"]
    typed = raw.select(
        "city_id", "city_name", "location_id", "location_name", "sensor_id",
        "parameter_name", "parameter_units",
        F.col("observation_date").try_cast("date").alias("observation_date"),
        *[F.col(c).try_cast("double").alias(c) for c in numbers],
        F.col("measurement_count").try_cast("bigint").alias("measurement_count"),
        "ingested_at",
    )
    return typed.filter(F.col("value") >= 0).withColumn(
        "normalised_value", C.normalised_value("parameter_name", "parameter_units", "value")
    )


def dim_cities(seed: DataFrame) -> DataFrame:
    return seed.select(
        "city_id", F.col("name").alias("city_name"), "department", "latitude", "longitude",
        "elevation_m", "population", "timezone",
        C.climate_zone("elevation_m").alias("climate_zone"),
        C.population_tier("population").alias("population_tier"),
    )


def fct_weather(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per city and day with the city's attributes and event flags.

    No broadcast is forced: Spark broadcasts the dimension while its size allows it.
    """
    place = dim.select("city_id", "department", "climate_zone", "elevation_m", "population")
    day = F.col("observation_date")
    return daily.join(place, "city_id", "left").select(
        C.surrogate_key("city_id", "observation_date").alias("weather_sk"),
        "city_id", "city_name", "department", "climate_zone", "elevation_m", "population",
        "observation_date",
        F.year(day).alias("observation_year"),
        F.month(day).alias("observation_month"),
        F.quarter(day).alias("observation_quarter"),
        F.dayofweek(day).alias("observation_day_of_week"),
        "avg_temperature_c", "min_temperature_c", "max_temperature_c",
        (F.col("max_temperature_c") - F.col("min_temperature_c")).alias("temperature_range_c"),
        "avg_apparent_temperature_c", "max_apparent_temperature_c",
        "avg_humidity_pct", "total_precipitation_mm", "total_rain_mm", "avg_pressure_hpa",
        "avg_cloud_cover_pct", "avg_wind_speed_kmh", "max_wind_gusts_kmh",
        "total_shortwave_radiation_w_m2",
        (F.col("total_precipitation_mm") > fixed.HEAVY_RAIN_ABOVE_MM).alias("is_heavy_rain_day"),
        (F.col("max_temperature_c") >= fixed.HOT_FROM_C).alias("is_hot_day"),
        (F.col("min_temperature_c") <= fixed.COLD_UP_TO_C).alias("is_cold_day"),
        (F.col("max_wind_gusts_kmh") >= fixed.WINDY_FROM_KMH).alias("is_windy_day"),
        "hour_count",
        (F.col("hour_count") == fixed.HOURS_PER_COMPLETE_DAY).alias("is_complete_day"),
        "last_ingested_at",
    )


def fct_air(daily: DataFrame, dim: DataFrame) -> DataFrame:
    """One row per city, pollutant and day, compared with the health guideline.

    `parameter_units` is the unit reported; `normalised_units` the one the figures are in.
    """
    place = dim.select("city_id", "department", "climate_zone", "population")
    day = F.col("observation_date")
    return daily.join(place, "city_id", "left").select(
        C.surrogate_key("city_id", "observation_date", "parameter_name").alias("air_quality_sk"),
        "city_id", "city_name", "department", "climate_zone", "population",
        "observation_date",
        F.year(day).alias("observation_year"),
        F.month(day).alias("observation_month"),
        F.quarter(day).alias("observation_quarter"),
        "parameter_name", "parameter_units",
        C.normalised_units("parameter_name", "parameter_units").alias("normalised_units"),
        "median_value", "mean_value", "min_value", "max_value", "sensor_count",
        "total_measurements",
        C.exceeds_guideline("parameter_name", "median_value").alias("exceeds_who_guideline"),
    )


def fct_stress(weather: DataFrame, air: DataFrame) -> DataFrame:
    """Weather days with the day's pollutants beside them, and the combined score.

    Weather days are local, air days UTC; the two meet on the calendar date all the same.
    """
    score = C.stress_score(
        "max_apparent_temperature_c", {name: name for name in fixed.POLLUTANTS}
    )
    return weather.join(
        pollutants_wide(air), CITY_DAY, "left"
    ).select(
        C.surrogate_key("city_id", "observation_date").alias("stress_sk"),
        "city_id", "city_name", "department", "climate_zone",
        "observation_date", "observation_year", "observation_month",
        "avg_temperature_c", "max_temperature_c", "max_apparent_temperature_c",
        "avg_humidity_pct", "total_precipitation_mm",
        *fixed.POLLUTANTS, "pollutants_measured",
        score.alias("environmental_stress_score"),
        "last_ingested_at",
    )


def weather_days(staged: DataFrame, live: bool = False) -> DataFrame:
    """Staged hours to days.

    The two pulled feeds are versions of each other, so an hour's latest row stands. With `live`
    events among them, hours are merged by measure instead: an event is no full version of an hour.
    """
    return weather_daily_merged(staged) if live else weather_daily_latest(staged)


def weather_mart(
    hist: DataFrame, daily: DataFrame, dim: DataFrame, stream: DataFrame | None = None
) -> DataFrame:
    """Raw feeds to fct_weather in one plan."""
    return fct_weather(weather_days(stage_weather(hist, daily, stream), stream is not None), dim)


def air_mart(raw: DataFrame, dim: DataFrame, dedupe: bool = False) -> DataFrame:
    """Raw readings to fct_air in one plan."""
    return fct_air(air_daily(stage_air(raw), dedupe), dim)
