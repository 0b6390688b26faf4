"""Roll-ups from readings to one row per city and day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from aerolith.fixed import POLLUTANTS
from aerolith.operators.dedupe import dedupe_latest
from aerolith.operators.merge import merge_hours
from aerolith.operators.percentile import rank_percentile

CITY_DAY = ["city_id", "observation_date"]

# Output name, aggregate, staged input.
_WEATHER = [
    ("avg_temperature_c", F.avg, "temperature_c"),
    ("min_temperature_c", F.min, "temperature_c"),
    ("max_temperature_c", F.max, "temperature_c"),
    ("avg_apparent_temperature_c", F.avg, "apparent_temperature_c"),
    ("max_apparent_temperature_c", F.max, "apparent_temperature_c"),
    ("avg_humidity_pct", F.avg, "relative_humidity_pct"),
    ("total_precipitation_mm", F.sum, "precipitation_mm"),
    ("total_rain_mm", F.sum, "rain_mm"),
    ("avg_pressure_hpa", F.avg, "pressure_msl_hpa"),
    ("avg_cloud_cover_pct", F.avg, "cloud_cover_pct"),
    ("avg_wind_speed_kmh", F.avg, "wind_speed_kmh"),
    ("max_wind_gusts_kmh", F.max, "wind_gusts_kmh"),
    ("total_shortwave_radiation_w_m2", F.sum, "shortwave_radiation_w_m2"),
]
# The batch roll-up reads the raw layout and keeps fewer columns.
_BATCH = [
    ("avg_temperature_c", F.avg, "temperature_2m"),
    ("min_temperature_c", F.min, "temperature_2m"),
    ("max_temperature_c", F.max, "temperature_2m"),
    ("avg_humidity_pct", F.avg, "relative_humidity_2m"),
    ("total_precipitation_mm", F.sum, "precipitation"),
    ("avg_pressure_hpa", F.avg, "pressure_msl"),
    ("avg_wind_speed_kmh", F.avg, "wind_speed_10m"),
    ("max_wind_gusts_kmh", F.max, "wind_gusts_10m"),
]

# Staged measures the daily roll-up reads.
DAILY_INPUTS = list(dict.fromkeys(source for _, _, source in _WEATHER))


def weather_latest(staged: DataFrame) -> DataFrame:
    """One row per city and hour, the latest ingested.

    Ties go by feed, then by the measures the daily roll-up reads: those come first, so a caller
    that reads fewer columns still gets the same values in them.
    """
    order = [c for c in ["source_kind", *DAILY_INPUTS] if c in staged.columns]
    return dedupe_latest(staged, ["city_id", "observation_ts"], "ingested_at", order)


def weather_daily(hourly: DataFrame) -> DataFrame:
    """Deduplicated hours to days: the staged measures' means, extremes and sums."""
    return _by_day(hourly, _WEATHER, F.max("ingested_at").alias("last_ingested_at"))


def weather_daily_latest(staged: DataFrame) -> DataFrame:
    """weather_latest and weather_daily: one plan, the same for days of any size.

    Deduplication goes by hour and drops copies before its exchange; the roll-up's exchange carries
    partial aggregates of days only.
    """
    # Deduplication should shuffle no column that the roll-up does not read.
    rows = staged.select(
        "city_id", "city_name", "observation_ts", *DAILY_INPUTS, "source_kind", "ingested_at"
    )
    order = ["source_kind", *DAILY_INPUTS]
    return weather_daily(dedupe_latest(rows, ["city_id", "observation_ts"], "ingested_at", order))


def weather_daily_merged(staged: DataFrame) -> DataFrame:
    """merge_hours and the roll-up, for feeds of unequal rank: live events beside pulled hours."""
    rows = staged.select(
        "city_id", "city_name", "observation_ts", *DAILY_INPUTS, "source_kind", "ingested_at"
    )
    return weather_daily(merge_hours(rows))


def batch_daily(raw: DataFrame) -> DataFrame:
    """Raw hours to days, as the batch job needs them: no deduplication, eight measures."""
    return _by_day(raw, _BATCH)


def _by_day(df: DataFrame, measures: list, *more: Column) -> DataFrame:
    aggs = [aggregate(source).alias(name) for name, aggregate, source in measures]
    if "observation_date" not in df.columns:
        df = df.withColumn("observation_date", F.to_date("observation_ts"))
    return df.groupBy("city_id", "city_name", "observation_date").agg(
        *aggs, F.count(F.lit(1)).alias("hour_count"), *more
    )


def air_daily(staged: DataFrame, dedupe: bool = False) -> DataFrame:
    """Sensor readings to one row per city, day and pollutant, with the exact median.

    Statistics are taken over (city, day, pollutant); a second city name or unit for the same
    group repeats them in a row of its own. `dedupe` first keeps only the latest landing of each
    sensor's day: overlapping landings otherwise count more than once.

    The other figures are partially aggregated where the readings are scanned, and the medians read
    keys and values alone, so neither carries what it does not need through an exchange.
    """
    keys = [*CITY_DAY, "parameter_name"]
    rows = staged
    if dedupe:
        rows = dedupe_latest(
            staged, [*CITY_DAY, "sensor_id", "parameter_name"], "ingested_at",
            ["normalised_value", "measurement_count"],
        )
    rows = rows.filter(F.col("normalised_value").isNotNull())
    v = F.col("normalised_value")
    by_sensor = rows.groupBy(*keys, "sensor_id", "city_name", "parameter_units").agg(
        F.sum(v).alias("sum"), F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.sum("measurement_count").alias("m"),
    )
    figures = by_sensor.groupBy(*keys).agg(
        (F.sum("sum") / F.sum("n")).alias("mean_value"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        F.count_distinct("sensor_id").alias("sensor_count"),
        F.sum("m").alias("total_measurements"),
        # A usable reading's unit follows from its pollutant, so these are the names one city goes
        # by within one day.
        F.collect_set(F.struct("city_name", "parameter_units")).alias("labels"),
    )
    medians = rank_percentile(rows, keys, "normalised_value", 0.5, "median_value")
    same = reduce(
        lambda a, b: a & b, [F.col(f"f.{k}").eqNullSafe(F.col(f"m.{k}")) for k in keys]
    )
    return (
        figures.alias("f").join(medians.alias("m"), same)
        .withColumn("label", F.explode("f.labels"))
        .select(
            "f.city_id", "label.city_name", "f.observation_date", "f.parameter_name",
            "label.parameter_units", "m.median_value", "f.mean_value", "f.min_value",
            "f.max_value", "f.sensor_count", "f.total_measurements",
        )
    )


def pollutants_wide(air: DataFrame) -> DataFrame:
    """Long to wide: one column of medians per pollutant, one row per city and day."""
    name = F.col("parameter_name")
    medians = [
        F.max(F.when(name == pollutant, F.col("median_value"))).alias(pollutant)
        for pollutant in POLLUTANTS
    ]
    return air.groupBy(*CITY_DAY).agg(
        *medians, F.count_distinct("parameter_name").alias("pollutants_measured")
    )
